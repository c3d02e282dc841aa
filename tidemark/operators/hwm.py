"""High-water marks: the largest value of the incremental field that a load has published.

A point is stored as text and always compared in the type of its field, so '9' is below '10'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.functions.text import TIMESTAMP_FORMAT
from tidemark.spec import Source, SpecError, Target, split_name

KEY = ["job_name", "src_db_name", "src_schema_name", "src_table_name", "src_rawsql", "dst_schema_name", "dst_table_name"]

# Default points, and the parts of field names that mean a time.
TIME_DEFAULT = "1970-01-01 00:00:00.000"
OTHER_DEFAULT = "1"
TIME_WORDS = ("date", "time", "cdt", "udt", "create", "update", "modified")

_TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)


def point_text(c: Column, dtype: T.DataType) -> Column:
    """Text that gives the same value back in any session."""
    if isinstance(dtype, T.TimestampType):
        return F.date_format(c, TIMESTAMP_FORMAT + "XXX")
    if isinstance(dtype, T.TimestampNTZType):
        return F.date_format(c, TIMESTAMP_FORMAT)
    return c.cast("string")


def typed_point(point: str | None, dtype: T.DataType) -> Column:
    """The point as a literal of its type; blank text is NULL."""
    return F.lit(point if (point or "").strip() else None).cast(dtype)


def default_point_by_name(field: Column) -> Column:
    """Default point guessed from the field's name."""
    return F.when(F.lower(field).rlike("|".join(TIME_WORDS)), F.lit(TIME_DEFAULT)).otherwise(F.lit(OTHER_DEFAULT))


def default_point(dtype: T.DataType, field: str) -> str:
    """Default point by type; text fields fall back to the name."""
    named = any(word in field.lower() for word in TIME_WORDS)
    is_time = isinstance(dtype, _TEMPORAL) or (named and isinstance(dtype, T.StringType))
    return TIME_DEFAULT if is_time else OTHER_DEFAULT


def identity(job: str, database: str, source: Source, target: Target) -> dict[str, str]:
    """Key of a mark. A three-part source name overrides the connection's database; SQL text is its own name."""
    key = dict.fromkeys(KEY, "") | {"job_name": job.strip(), "src_db_name": (source.database or database).strip()}
    if source.table.strip():
        name = split_name(source.table)
        key |= {"src_schema_name": name.schema, "src_table_name": name.table}
        if name.database:
            key["src_db_name"] = name.database
    elif source.sql.strip():
        key["src_rawsql"] = source.sql.strip()
    else:
        raise SpecError("a high-water mark needs a source table or sql")
    name = split_name(target.table)
    if name.database:
        raise SpecError("target table must be table or schema.table")
    return key | {"dst_schema_name": name.schema, "dst_table_name": name.table}


def compute(staged: DataFrame, column: str) -> DataFrame:
    """One row: the largest value as text, empty when there is none. ``column`` is the target name."""
    top = staged.agg(F.max(quoted(column)).alias("top"))
    return top.select(F.coalesce(point_text(F.col("top"), staged.schema[column].dataType), F.lit("")).alias("incr_point"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({k: F.coalesce(F.trim(F.col(k)), F.lit("")) for k in KEY if k in df.columns})


def _point(c: str, dtype: T.DataType) -> Column:
    return F.when(F.trim(F.col(c)) != "", F.trim(F.col(c))).cast(dtype)


def lookup(loads: DataFrame, control: DataFrame, target_max: DataFrame, dtype: T.DataType) -> DataFrame:
    """Where each load starts: the larger of configured and stored point, else the target's maximum, else the default.

    ``loads`` holds the key, ``incr_point`` and ``src_incr_field``; ``control`` the key and ``incr_point``;
    ``target_max`` the target's two name columns and a typed ``target_point``. Adds ``point`` and ``origin``.
    """
    stored = _keyed(control).groupBy(*KEY).agg(F.max(_point("incr_point", dtype)).alias("__stored"))
    reached = _keyed(target_max).groupBy("dst_schema_name", "dst_table_name").agg(F.max("target_point").alias("__reached"))
    joined = (
        _keyed(loads)
        .withColumn("__given", _point("incr_point", dtype))
        .join(stored, KEY, "left")
        .join(reached, ["dst_schema_name", "dst_table_name"], "left")
    )
    known = F.greatest("__given", "__stored")
    fallback = F.lit(default_point(dtype, "")).cast(dtype) if not isinstance(dtype, T.StringType) else (
        default_point_by_name(F.col("src_incr_field"))
    )
    return joined.select(
        *loads.columns,
        F.coalesce(known, "__reached", fallback).alias("point"),
        F.when(known.isNotNull(), "stored").when(F.col("__reached").isNotNull(), "target").otherwise("default").alias("origin"),
    )


def upsert(control: DataFrame, updates: DataFrame, dtype: T.DataType, now: Column) -> DataFrame:
    """Control rows after a run. A mark never falls, and a run without one leaves it as it was.

    ``updates`` holds the key, incr_point, sync_mode, src_incr_field and dst_pk; ``control`` also cdt and udt.
    """
    facts = ["sync_mode", "src_incr_field", "dst_pk"]
    new = (
        _keyed(updates)
        .groupBy(*KEY)
        .agg(
            F.max(_point("incr_point", dtype)).alias("__new"),
            *[F.max_by(f, F.struct(_point("incr_point", dtype), f)).alias(f"__{f}") for f in facts],
            F.lit(True).alias("__run"),
        )
    )
    old = _keyed(control).withColumn("__old", _point("incr_point", dtype))
    joined = old.join(new, KEY, "full_outer")
    top = F.greatest("__old", "__new")
    return joined.select(
        *KEY,
        F.coalesce(point_text(top, dtype), "incr_point").alias("incr_point"),
        *[F.coalesce(f"__{f}", f).alias(f) for f in facts],
        F.coalesce("cdt", now).alias("cdt"),
        F.when(F.col("__run"), now).otherwise(F.col("udt")).alias("udt"),
    )
