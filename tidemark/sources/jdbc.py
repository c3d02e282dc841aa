"""Parallel JDBC read. The SELECT runs in the database; Spark splits it by ranges of one column."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.functions.text import guid_text
from tidemark.sources.connections import Connection
from tidemark.sources.naming import alias_sql
from tidemark.spec import Source

log = logging.getLogger(__name__)

SPLITTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
DEFAULT_PARTS = 32
OWN_OPTIONS = ("partitionColumn", "numPartitions", "rowsPerPartition", "splitBy")
TEXT_TYPE = {"mssql": "NVARCHAR(4000)"}  # else TEXT


def read_options(connection: Connection, source: Source, sql: str, bounds: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options for one extraction statement."""
    settings = {k: v for k, v in connection.options.items() if k not in OWN_OPTIONS}
    return {"preferTimestampNTZ": "true"} | settings | {"dbtable": f"({sql}) t", "fetchsize": str(source.batch_size)} | (bounds or {})


def _asked(spark: SparkSession, connection: Connection, source: Source, sql: str) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(connection, source, sql)).load()


def parts(spark: SparkSession, connection: Connection, source: Source, sql: str) -> int:
    """Number of splits: ``numPartitions``, or as many as ``rowsPerPartition`` asks for the counted rows, else 32."""
    options = connection.options
    if "numPartitions" not in options and "rowsPerPartition" in options:
        rows = _asked(spark, connection, source, f"SELECT COUNT(*) AS n FROM ({sql}) c").first()[0]
        return max(1, -(-int(rows) // int(options["rowsPerPartition"])))
    return int(options.get("numPartitions", DEFAULT_PARTS))


def split_column(connection: Connection, source: Source) -> str:
    """The connection's ``partitionColumn``, else the incremental field: a column of the statement's result."""
    return (connection.options.get("partitionColumn") or source.target_incr_field or "").strip().strip('[]"')


def split_bounds(spark: SparkSession, connection: Connection, source: Source, sql: str) -> dict[str, str] | list[str] | None:
    """How the statement is split: reader options of even ranges, or one predicate for each split.

    Numbers, dates and times are cut evenly between the lowest and the highest value, read as one row. Text and GUIDs, and
    everything where the connection's ``splitBy`` is ``depth``, are cut where the database finds as many rows on either
    side. Without a split column the whole extract would pass through one task, so that is worth a warning.
    """
    column = split_column(connection, source)
    if not column:
        log.warning("%s: no partitionColumn and no incremental field to split by; reading through one task", connection.name)
        return None
    name = alias_sql(column, connection.kind)
    ends = _asked(spark, connection, source, f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM ({sql}) b")
    ranged = isinstance(ends.schema["lo"].dataType, SPLITTABLE)
    if not ranged or connection.options.get("splitBy") == "depth":
        count = parts(spark, connection, source, sql)
        highs = _asked(spark, connection, source, depth_sql(connection, sql, name, count, as_text=not ranged))
        return depth_predicates(connection, name, [(r["lo"], r["hi"]) for r in highs.collect()], as_text=not ranged)
    low, high = ends.selectExpr("CAST(lo AS STRING)", "CAST(hi AS STRING)").first()
    if not low:
        return None
    return {"partitionColumn": column, "lowerBound": low, "upperBound": high, "numPartitions": str(parts(spark, connection, source, sql))}


def _compared(connection: Connection, name: str, as_text: bool) -> str:
    """Text and GUIDs are ordered and compared by the database as text, so bounds and predicates agree on the order."""
    return f"CAST({name} AS {TEXT_TYPE.get(connection.kind, 'TEXT')})" if as_text else name


def depth_sql(connection: Connection, sql: str, name: str, count: int, *, as_text: bool) -> str:
    """A statement that gives the number of each of ``count`` equally deep ranges as ``lo``, and its highest value as ``hi``."""
    value = _compared(connection, name, as_text)
    ranked = f"SELECT {value} AS v, NTILE({count}) OVER (ORDER BY {value}) AS lo FROM ({sql}) r WHERE {name} IS NOT NULL"
    return f"SELECT lo, MAX(v) AS hi FROM ({ranked}) d GROUP BY lo"


def depth_predicates(connection: Connection, name: str, highs: Sequence[tuple], *, as_text: bool) -> list[str] | None:
    """One predicate for each range; together they hold of every row once, nulls included. Equal values share a range."""
    value = _compared(connection, name, as_text)
    bounds = list(dict.fromkeys(str(high) for _, high in sorted(highs)))[:-1]
    if not bounds:
        return None
    quote = "N'" if connection.kind == "mssql" and as_text else "'"
    points = [quote + b.replace("'", "''") + "'" for b in bounds]
    between = [f"{value} > {low} AND {value} <= {high}" for low, high in zip(points, points[1:])]
    return [f"{value} <= {points[0]}", *between, f"{value} > {points[-1]} OR {name} IS NULL"]


def read(spark: SparkSession, connection: Connection, source: Source, sql: str, *, split: bool = True) -> DataFrame:
    """Rows of the statement."""
    bounds = split_bounds(spark, connection, source, sql) if split else None
    if isinstance(bounds, list):
        options = read_options(connection, source, sql)
        return spark.read.jdbc(options.pop("url"), options.pop("dbtable"), predicates=bounds, properties=options)
    return spark.read.format("jdbc").options(**read_options(connection, source, sql, bounds)).load()


def guid_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn binary GUID columns into UUID text, and text ones into upper case."""
    forms = {
        name: guid_text(F.col(quoted(name))) if isinstance(df.schema[name].dataType, T.BinaryType) else F.upper(F.col(quoted(name)))
        for name in names
    }
    return df.withColumns(forms) if forms else df
