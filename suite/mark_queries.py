"""High-water marks. Every user of events stands for one load with a mark of its own."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.registry import query, rows_of, tables
from tidemark.operators import hwm
from tidemark.sources.extract import extract
from tidemark.spec import Mapping, Source

NTZ = T.TimestampNTZType()
TEXT = "%Y-%m-%d %H:%M:%S.%f"


@query("hwm_compute", f"SELECT coalesce(strftime(max(o_orderdate), '{TEXT}'), '') AS incr_point FROM orders")
def hwm_compute(spark, sf_dir):
    return hwm.compute(rows_of(spark, sf_dir, "SELECT * FROM orders"), "o_orderdate")


@query("hwm_compute_mapped", "SELECT CAST(max(event_id) AS VARCHAR) AS incr_point FROM events")
def hwm_compute_mapped(spark, sf_dir):
    source = Source(table="events", mapping=Mapping.of({"event_id": "id", "ts": "event_time"}), incr_field="event_id")
    return hwm.compute(extract(spark, tables(sf_dir), source), source.target_incr_field)


KEY_SQL = """'nightly' AS job_name, 'given' AS src_db_name, 'raw' AS src_schema_name, concat('user_', CAST(user_id AS VARCHAR(20)))
 AS src_table_name, '' AS src_rawsql, 'ods' AS dst_schema_name, concat('t_', CAST(user_id AS VARCHAR(20))) AS dst_table_name"""
GIVEN = "2024-01-29 12:00:00.000000"
LOADS = f"SELECT {KEY_SQL}, '{GIVEN}' AS incr_point, 'ts' AS src_incr_field FROM events GROUP BY user_id"
LOADS_BLANK = f"SELECT {KEY_SQL}, ' ' AS incr_point, 'ts' AS src_incr_field FROM events GROUP BY user_id"
# The stored marks: what each load published, as text.
STORED = "SELECT user_id, max(ts) AS top FROM events WHERE event_type = 'view' GROUP BY user_id"
REACHED = "SELECT user_id, max(ts) AS top FROM events WHERE event_type = 'purchase' GROUP BY user_id"
UNREACHED = "SELECT user_id, max(ts) AS top FROM events WHERE event_type = 'refund' GROUP BY user_id"


def control(spark, sf_dir, sql):
    """Stored marks as control rows."""
    found = rows_of(spark, sf_dir, f"SELECT {KEY_SQL}, top FROM ({sql}) m")
    return found.withColumn("incr_point", hwm.point_text(F.col("top"), NTZ)).drop("top")


def blank_control(spark, sf_dir):
    return rows_of(spark, sf_dir, f"SELECT {KEY_SQL}, '' AS incr_point FROM events GROUP BY user_id")


def target_max(spark, sf_dir, sql):
    found = rows_of(spark, sf_dir, f"SELECT {KEY_SQL}, top AS target_point FROM ({sql}) m")
    return found.select("dst_schema_name", "dst_table_name", "target_point")


def looked_up(loads, control_rows, reached):
    return hwm.lookup(loads, control_rows, reached, NTZ).select("src_table_name", "point", "origin")


@query(
    "hwm_lookup_stored",
    f"""SELECT concat('user_', u.user_id) AS src_table_name, greatest(TIMESTAMP '{GIVEN}', s.top) AS point, 'stored' AS origin
        FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN ({STORED}) s USING (user_id)""",
)
def hwm_lookup_stored(spark, sf_dir):
    return looked_up(rows_of(spark, sf_dir, LOADS), control(spark, sf_dir, STORED), target_max(spark, sf_dir, REACHED))


@query(
    "hwm_lookup_target_max",
    f"""SELECT concat('user_', u.user_id) AS src_table_name, coalesce(r.top, TIMESTAMP '1970-01-01 00:00:00') AS point,
               CASE WHEN r.top IS NULL THEN 'default' ELSE 'target' END AS origin
        FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN ({REACHED}) r USING (user_id)""",
)
def hwm_lookup_target_max(spark, sf_dir):
    return looked_up(rows_of(spark, sf_dir, LOADS_BLANK), blank_control(spark, sf_dir), target_max(spark, sf_dir, REACHED))


@query(
    "hwm_lookup_default",
    """SELECT DISTINCT concat('user_', user_id) AS src_table_name, TIMESTAMP '1970-01-01 00:00:00' AS point, 'default' AS origin
       FROM events""",
)
def hwm_lookup_default(spark, sf_dir):
    return looked_up(rows_of(spark, sf_dir, LOADS_BLANK), blank_control(spark, sf_dir), target_max(spark, sf_dir, UNREACHED))


FIELDS = """
SELECT p_partkey, concat(p_brand, CASE WHEN p_size < 10 THEN 'CreateDate' WHEN p_size < 20 THEN '_UDT' WHEN p_size < 30 THEN '_id'
       WHEN p_size < 40 THEN 'modified' ELSE '_ts' END) AS field FROM part
"""


@query(
    "hwm_default",
    f"""SELECT p_partkey, field,
               CASE WHEN regexp_matches(lower(field), 'date|time|cdt|udt|create|update|modified')
                    THEN '1970-01-01 00:00:00.000' ELSE '1' END AS by_name,
               '1970-01-01 00:00:00.000' AS by_time_type, '1' AS by_number_type FROM ({FIELDS}) f""",
)
def hwm_default(spark, sf_dir):
    return rows_of(spark, sf_dir, FIELDS).select(
        "p_partkey",
        "field",
        hwm.default_point_by_name(F.col("field")).alias("by_name"),
        F.lit(hwm.default_point(NTZ, "ts")).alias("by_time_type"),
        F.lit(hwm.default_point(T.LongType(), "created")).alias("by_number_type"),
    )


# Marks before a run, and what the run reports: some larger, some smaller, some new, some without a value.
BEFORE = "SELECT user_id, max(ts) AS top FROM events WHERE event_type <> 'view' AND value > 20 GROUP BY user_id"
REPORT = """
SELECT user_id, CASE WHEN max(value) > 30 THEN max(ts) END AS top, 'merge' AS sync_mode FROM events
WHERE event_type = 'view' GROUP BY user_id
"""
OLD_TIME, RUN_TIME = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


@query(
    "hwm_upsert",
    f"""SELECT concat('user_', coalesce(o.user_id, n.user_id)) AS src_table_name,
               coalesce(strftime(greatest(o.top, n.top), '{TEXT}'), CASE WHEN o.user_id IS NOT NULL THEN '' END) AS incr_point,
               coalesce(n.sync_mode, 'append') AS sync_mode,
               CASE WHEN o.user_id IS NULL THEN TIMESTAMP '{RUN_TIME}' ELSE TIMESTAMP '{OLD_TIME}' END AS cdt,
               CASE WHEN n.user_id IS NULL THEN TIMESTAMP '{OLD_TIME}' ELSE TIMESTAMP '{RUN_TIME}' END AS udt
        FROM ({BEFORE}) o FULL JOIN ({REPORT}) n ON o.user_id = n.user_id""",
)
def hwm_upsert(spark, sf_dir):
    old = control(spark, sf_dir, BEFORE).selectExpr(
        "*", "'append' AS sync_mode", "'ts' AS src_incr_field", "'event_id' AS dst_pk",
        f"TIMESTAMP_NTZ '{OLD_TIME}' AS cdt", f"TIMESTAMP_NTZ '{OLD_TIME}' AS udt",
    )
    new = control(spark, sf_dir, REPORT).selectExpr("*", "'merge' AS sync_mode", "'ts' AS src_incr_field", "'event_id' AS dst_pk")
    after = hwm.upsert(old, new, NTZ, F.lit(RUN_TIME).cast(NTZ))
    return after.select("src_table_name", "incr_point", "sync_mode", "cdt", "udt")
