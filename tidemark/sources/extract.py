"""Extraction: one SELECT over the source, with the mapping, the filter and the high-water mark in it.

Spark plays the part of the source database, so pushdown and column pruning come from Catalyst. For a JDBC
source the same SELECT is written in the database's own dialect and runs there.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.hwm import default_point
from tidemark.sources import jdbc
from tidemark.sources.connections import Connection
from tidemark.sources.naming import alias_sql, field_sql
from tidemark.spec import INCREMENTAL_MODES, Mapping, Source, SpecError

FIELD = "${SRC_INCR_FIELD}"
POINT = "${INCR_POINT}"
EMPTY = "1=0"

# What databases call a point in time.
TIME_NAMES = {"postgres": "timestamp", "postgresql": "timestamp", "greenplum": "timestamp", "mssql": "datetime2"}


def projection_sql(source: Source, dialect: str = "spark") -> str:
    """``source AS target`` per mapping entry, or ``*``."""
    if not source.mapping.items:
        return "*"
    if any(not src or not tgt for src, tgt in source.mapping.items):
        raise SpecError("mapping holds an empty key or value")
    return ", ".join(f"{field_sql(src, dialect)} AS {alias_sql(tgt, dialect)}" for src, tgt in source.mapping.items)


def where_sql(source: Source, empty: bool = False) -> str:
    return EMPTY if empty else source.where.strip() or "1=1"


def fill_field(text: str, field: str, dialect: str = "spark") -> str:
    """Put the quoted incremental field in, also where the author quoted the placeholder."""
    if FIELD not in text:
        return text
    if not field:
        raise SpecError(f"{FIELD} is used but incr_field is empty")
    name = field_sql(field, dialect)
    for written in (f'"{FIELD}"', f"[{FIELD}]", f"`{FIELD}`", FIELD):
        text = text.replace(written, name)
    return text


def fill_point(text: str, value: str, point: str | None) -> str:
    """Put ``value`` (SQL) in place of the point; inside a longer string literal, the point's own text."""
    if POINT not in text:
        return text
    if not point:
        raise SpecError(f"{POINT} is used but there is no incr_point")
    text = text.replace(f"'{POINT}'", POINT)
    done, *rest = text.split(POINT)
    for piece in rest:
        inside_literal = done.count("'") % 2 == 1
        done += (point.replace("'", "''") if inside_literal else value) + piece
    return done


def order_sql(source: Source, mode: str, chunked: bool = False) -> str:
    """Order by clause of incremental modes; NULLs last where the order is our own default."""
    if mode not in INCREMENTAL_MODES:
        return ""
    if source.order_by.strip():
        return f" ORDER BY {source.order_by}"
    return f" ORDER BY {FIELD} ASC NULLS LAST" if chunked and source.incr_field else ""


def uses_point(source: Source) -> bool:
    return any(POINT in text for text in (source.sql, source.where, source.order_by))


def auto_predicate(source: Source, mode: str, point: str | None, field: str, value: str) -> str:
    """``incr_field > point`` for incremental modes, unless the author placed the point."""
    if mode not in INCREMENTAL_MODES or not source.incr_field or not point or not source.auto_incr or uses_point(source):
        return ""
    back = f" - {source.lookback}" if source.lookback else ""
    return f" AND {field} > {value}{back}"


def incr_type(spark: SparkSession, connection: Connection, source: Source, point: str | None = None) -> T.DataType:
    """Type of the incremental field in the source, from analysis alone."""
    probe = Source(
        table=source.table,
        sql=source.sql,
        connection=source.connection,
        mapping=Mapping.of({source.incr_field: "f"}),
        incr_field=source.incr_field,
    )
    point = point or default_point(T.StringType(), source.incr_field)
    if connection.is_jdbc:
        frame = jdbc.read(spark, connection, probe, remote_sql(connection, probe, point=point, empty=True), split=False)
    else:
        inner, args, relations = _relation(spark, connection, probe, ":incr_point", point)
        frame = spark.sql(f"SELECT {projection_sql(probe)} FROM {inner} WHERE {EMPTY}", args=args, **relations)
    return frame.schema.fields[0].dataType


def _relation(spark: SparkSession, connection: Connection, source: Source, value: str, point: str | None):
    """FROM item of the SELECT, its bound arguments and its DataFrames."""
    if source.sql.strip():
        connection.expose(spark, source.sql)
        inner = fill_point(fill_field(source.sql, source.incr_field), value, point)
        return f"({inner}) AS t", {"incr_point": point} if ":incr_point" in inner else {}, {}
    name = source.table.strip().split(".")[-1]
    return f"{{src}} AS {alias_sql(name)}", {}, {"src": connection.relation(spark, source.table.strip())}


def extract(
    spark: SparkSession,
    connection: Connection,
    source: Source,
    mode: str = "initial",
    point: str | None = None,
    *,
    ordered: bool = False,
    empty: bool = False,
) -> DataFrame:
    """The rows a run has to load, lazily.

    ``point`` is the high-water mark; None on a first load, which then reads everything. ``ordered`` adds the
    extraction order, which writing does not need.
    """
    source.validate()
    dtype = incr_type(spark, connection, source, point) if source.incr_field else T.StringType()
    if point is None and uses_point(source):
        point = source.incr_point or default_point(dtype, source.incr_field)
    if connection.is_jdbc:
        return jdbc.read(spark, connection, source, remote_sql(connection, source, mode, point, empty=empty, dtype=dtype))

    value = f"CAST(:incr_point AS {dtype.simpleString()})"
    inner, args, relations = _relation(spark, connection, source, value, point)
    field = field_sql(source.incr_field) if source.incr_field else ""
    outer = f"({where_sql(source, empty)})" + auto_predicate(source, mode, point, field, value)
    if ordered:
        outer += order_sql(source, mode, chunked=True)
    outer = fill_point(fill_field(outer, source.incr_field), value, point)
    if ":incr_point" in outer:
        args = {"incr_point": point}
    projection = projection_sql(source)
    if relations:
        # The DataFrame argument makes the text a format string.
        projection, outer = (text.replace("{", "{{").replace("}", "}}") for text in (projection, outer))
    return spark.sql(f"SELECT {projection} FROM {inner} WHERE {outer}", args=args, **relations)


def remote_literal(point: str, dtype: T.DataType | None, dialect: str) -> str:
    """A point for a database: times without trailing zeros of the fraction and cast, so that arithmetic may follow."""
    text = "'" + point.replace("'", "''") + "'"
    if not isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)) or dialect not in TIME_NAMES:
        return text
    short = re.sub(r"\.(\d*?)0*(?=$|[+-]\d\d:?\d\d$|Z$)", lambda m: f".{m[1]}" if m[1] else "", point)
    kind = "date" if isinstance(dtype, T.DateType) else TIME_NAMES[dialect]
    return f"CAST('{short}' AS {kind})"


def remote_sql(
    connection: Connection,
    source: Source,
    mode: str = "initial",
    point: str | None = None,
    *,
    empty: bool = False,
    dtype: T.DataType | None = None,
) -> str:
    """The SELECT in the dialect of a database source, the point as a literal of its type where that is known."""
    if source.table.strip():
        connection.check_table(source.table)
    dialect = connection.kind
    literal = remote_literal(point or "", dtype, dialect)
    field = field_sql(source.incr_field, dialect) if source.incr_field else ""
    relation = f"({source.sql}) t" if source.sql.strip() else source.table.strip()
    where = where_sql(source, empty) if empty else f"({where_sql(source)})"
    text = f"SELECT {projection_sql(source, dialect)} FROM {relation} WHERE {where}"
    if not empty:
        text += auto_predicate(source, mode, point, field, literal)
    return fill_point(fill_field(text, source.incr_field, dialect), literal, point)


def schema_probe(spark: SparkSession, connection: Connection, source: Source) -> T.StructType:
    """Names and types of the extract; analysis only, no rows read."""
    return extract(spark, connection, source, empty=True).schema

