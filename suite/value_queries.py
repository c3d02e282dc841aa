"""Value cleaning and text forms."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.registry import query, rows_of
from tidemark.functions import text
from tidemark.functions.clean import CONTROL_CHARS, WHITE_SPACE, blank_to_empty, clean, strip_control
from tidemark.functions.transforms import field_transforms
from tidemark.sinks.export import csv_lines

# The same text in both engines: every kind of blank, NULL and control characters around whole documents.
WIDE_BLANK = "\N{IDEOGRAPHIC SPACE}\N{NO-BREAK SPACE}\t\N{EM SPACE}"
DIRTY = f"""
SELECT doc_id, lang, n_chars, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN '{WIDE_BLANK}'
       WHEN 4 THEN concat('\x01', text, '\x7f') ELSE concat('{WIDE_BLANK}', text) END AS text
FROM documents
"""
CONTROLS = "SELECT doc_id, concat('\x02', replace(text, ' ', '\x0b \x1f'), '\x7f') AS text FROM documents"

BLANK_SQL = f"regexp_full_match(text, '{WHITE_SPACE}*')"
STRIP_SQL = f"regexp_replace(text, '{CONTROL_CHARS}', '', 'g')"
CLEAN_SQL = f"CASE WHEN {BLANK_SQL} THEN '' ELSE {STRIP_SQL} END"
CSV_SQL = f"""CASE WHEN text IS NULL THEN '{text.NULL_TEXT}' WHEN {BLANK_SQL} THEN ''
    WHEN regexp_matches({STRIP_SQL}, '[,"\\n\\r]') OR {STRIP_SQL} = '{text.NULL_TEXT}'
    THEN '"' || replace({STRIP_SQL}, '"', '""') || '"' ELSE {STRIP_SQL} END"""


@query("clean_blank", f"SELECT doc_id, CASE WHEN {BLANK_SQL} THEN '' ELSE text END AS text FROM ({DIRTY}) d")
def clean_blank(spark, sf_dir):
    return rows_of(spark, sf_dir, DIRTY).select("doc_id", blank_to_empty(F.col("text")).alias("text"))


@query("clean_control", f"SELECT doc_id, {STRIP_SQL} AS text FROM ({CONTROLS}) d")
def clean_control(spark, sf_dir):
    return rows_of(spark, sf_dir, CONTROLS).select("doc_id", strip_control(F.col("text")).alias("text"))


@query(
    "clean_null_vs_empty",
    f"""SELECT lang, count(*) FILTER (WHERE text IS NULL) AS nulls, count(*) FILTER (WHERE text = '') AS empties,
               count(*) FILTER (WHERE text <> '') AS filled, CAST(sum(length(text)) AS BIGINT) AS chars
        FROM (SELECT lang, {CLEAN_SQL} AS text FROM ({DIRTY}) d) c GROUP BY lang""",
)
def clean_null_vs_empty(spark, sf_dir):
    cleaned = clean(rows_of(spark, sf_dir, DIRTY))
    return cleaned.groupBy("lang").agg(
        F.count_if(F.col("text").isNull()).alias("nulls"),
        F.count_if(F.col("text") == "").alias("empties"),
        F.count_if(F.col("text") != "").alias("filled"),
        F.sum(F.length("text")).alias("chars"),
    )


@query(
    "text_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
              strftime(CAST(ts AS DATE), '%Y-%m-%d 00:00:00.000000') AS day_text FROM events""",
)
def text_timestamp(spark, sf_dir):
    events = rows_of(spark, sf_dir, "SELECT event_id, ts, CAST(ts AS DATE) AS day FROM events")
    return events.select(
        "event_id", text.timestamp_text(F.col("ts")).alias("ts_text"), text.timestamp_text(F.col("day")).alias("day_text")
    )


@query("zoned_timestamp", "SELECT event_id, epoch_us(ts AT TIME ZONE 'America/Mexico_City') AS micros FROM events")
def zoned_timestamp(spark, sf_dir):
    events = rows_of(spark, sf_dir, "SELECT event_id, ts FROM events")
    return events.select("event_id", F.unix_micros(text.to_instant(F.col("ts"), "America/Mexico_City")).alias("micros"))


HASHES = "SELECT event_id, md5(concat(event_type, CAST(event_id AS VARCHAR(20)))) AS h FROM events"


def _guid_sql(h: str) -> str:
    order = [[4, 3, 2, 1], [6, 5], [8, 7], [9, 10], [11, 12, 13, 14, 15, 16]]
    return " || '-' || ".join(" || ".join(f"substr({h}, {2 * b - 1}, 2)" for b in group) for group in order)


@query(
    "text_guid",
    f"""SELECT event_id, upper({_guid_sql('h')}) AS guid, '' AS short, upper(h) AS from_text FROM ({HASHES}) x""",
)
def text_guid(spark, sf_dir):
    hashed = rows_of(spark, sf_dir, HASHES)
    return hashed.select(
        "event_id",
        text.guid_text(F.unhex("h")).alias("guid"),
        text.guid_text(F.unhex(F.expr("left(h, 30)"))).alias("short"),
        text.guid_from_text(F.col("h")).alias("from_text"),
    )


@query("text_binary", f"SELECT event_id, '\\x' || h AS bytes, '\\x' AS nothing FROM ({HASHES}) x")
def text_binary(spark, sf_dir):
    hashed = rows_of(spark, sf_dir, HASHES)
    return hashed.select(
        "event_id", text.binary_text(F.unhex("h")).alias("bytes"), text.binary_text(F.unhex(F.lit(""))).alias("nothing")
    )


def _array_item_sql(x: str) -> str:
    escaped = f"""'"' || regexp_replace({x}, '(["\\\\])', '\\\\\\1', 'g') || '"'"""
    return f"""CASE WHEN {x} IS NULL THEN 'NULL' WHEN regexp_matches({x}, '[,"{{}}\\\\\\s]') OR {x} = '' OR upper({x}) = 'NULL'
               THEN {escaped} ELSE {x} END"""


ARRAY_SOURCE = "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS supp FROM lineitem"


@query(
    "text_array",
    f"""SELECT l_orderkey, l_linenumber,
               '{{' || CAST(l_partkey AS VARCHAR) || ',' || coalesce(CAST(supp AS VARCHAR), 'NULL') || '}}' AS ids
        FROM ({ARRAY_SOURCE}) x""",
)
def text_array(spark, sf_dir):
    lines = rows_of(spark, sf_dir, ARRAY_SOURCE)
    return lines.select("l_orderkey", "l_linenumber", text.array_text(F.array("l_partkey", "supp")).alias("ids"))


@query(
    "text_array_strings",
    f"SELECT doc_id, '{{' || {_array_item_sql('lang')} || ',' || {_array_item_sql('text')} || '}}' AS items FROM ({DIRTY}) d",
)
def text_array_strings(spark, sf_dir):
    docs = rows_of(spark, sf_dir, DIRTY)
    return docs.select("doc_id", text.array_text(F.array("lang", "text"), T.StringType()).alias("items"))


@query("csv_field", f"SELECT doc_id, {CSV_SQL} AS field FROM ({DIRTY}) d")
def csv_field(spark, sf_dir):
    return rows_of(spark, sf_dir, DIRTY).select("doc_id", text.csv_field(F.col("text")).alias("field"))


@query(
    "text_scalar",
    """SELECT CAST(l_orderkey AS VARCHAR) AS k, CAST(l_linenumber AS VARCHAR) AS n,
              CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END AS large FROM lineitem""",
)
def text_scalar(spark, sf_dir):
    lines = rows_of(spark, sf_dir, "SELECT l_orderkey, l_linenumber, l_quantity > 25 AS large FROM lineitem")
    return lines.select(
        text.scalar_text(F.col("l_orderkey")).alias("k"),
        text.scalar_text(F.col("l_linenumber")).alias("n"),
        text.scalar_text(F.col("large")).alias("large"),
    )


TRANSFORM_SOURCE = """
SELECT c_custkey, concat('  ', c_name, ' ') AS trimmed, c_mktsegment AS uppered, c_mktsegment AS lowered, c_name AS replaced,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN ' ' ELSE c_mktsegment END AS defaulted,
       c_name AS prefixed, c_name AS suffixed
FROM customer
"""


@query(
    "field_transforms",
    f"""SELECT c_custkey, trim(trimmed) AS trimmed, upper(uppered) AS uppered, lower(lowered) AS lowered,
               replace(replaced, 'Customer#', 'C-') AS replaced,
               CASE WHEN defaulted IS NULL OR trim(defaulted) = '' THEN 'NONE' ELSE defaulted END AS defaulted,
               'x:' || prefixed AS prefixed, suffixed || '!' AS suffixed FROM ({TRANSFORM_SOURCE}) c""",
)
def transforms(spark, sf_dir):
    rules = [
        ("trimmed", "trim"),
        ("uppered", "upper"),
        ("lowered", "lower"),
        ("replaced", "replace", "Customer#", "C-"),
        ("defaulted", "default", "NONE"),
        ("prefixed", "prefix", "x:"),
        ("suffixed", "suffix", "!"),
    ]
    return field_transforms(rows_of(spark, sf_dir, TRANSFORM_SOURCE), rules)


@query(
    "csv_export_lines",
    f"SELECT CAST(doc_id AS VARCHAR) || ',' || lang || ',' || CAST(n_chars AS VARCHAR) || ',' || {CSV_SQL} AS line FROM ({DIRTY}) d",
)
def csv_export_lines(spark, sf_dir):
    return csv_lines(rows_of(spark, sf_dir, DIRTY))
