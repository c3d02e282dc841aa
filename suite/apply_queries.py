"""The write modes on orders and lineitem: T is what a target holds, S what a run extracted."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from suite.registry import query, rows_of
from tidemark.operators import modes
from tidemark.operators.align import align, align_marked, good_rows, rejected
from tidemark.operators.chunks import chunk_index
from tidemark.operators.matching import hot_keys, hot_on_either, plan_match

CUT = "TIMESTAMP '1998-01-01 00:00:00'"

# Orders up to the cut are in the target; the run brings later orders and re-priced urgent ones.
OLD_ORDERS = f"SELECT * FROM orders WHERE o_orderdate < {CUT}"
REPRICED_ORDERS = f"""
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate < {CUT} THEN o_totalprice + 100 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority
FROM orders"""
NEW_ORDERS = f"{REPRICED_ORDERS} WHERE o_orderdate >= {CUT} OR o_orderpriority = '1-URGENT'"
OLD_LINES = f"SELECT * FROM lineitem WHERE l_shipdate < {CUT}"
NEW_LINES = f"SELECT * FROM lineitem WHERE l_shipdate >= {CUT}"
LINE_KEY = ["l_orderkey", "l_linenumber"]


def keyed(sql: str, key: str) -> str:
    """The same orders under another key."""
    columns = "o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
    return f"SELECT {key} AS o_orderkey, {columns} FROM ({sql}) k"


NULL_FOR_A_THIRD = "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END"
ONE_FOR_A_THIRD = "CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_orderkey END"


def merged_sql(old: str, new: str, pk: list[str]) -> str:
    same = " AND ".join(f"s.{k} = t.{k}" for k in pk)
    return f"SELECT t.* FROM ({old}) t WHERE NOT EXISTS (SELECT 1 FROM ({new}) s WHERE {same}) UNION ALL SELECT * FROM ({new}) n"


def merged(spark, sf_dir, old, new, pk):
    target, source = rows_of(spark, sf_dir, old), rows_of(spark, sf_dir, new)
    return modes.merge(target, source, pk, **plan_match(target, source, pk))


@query("mode_initial", f"{OLD_LINES} UNION ALL {NEW_LINES}")
def mode_initial(spark, sf_dir):
    return modes.initial(rows_of(spark, sf_dir, OLD_LINES), rows_of(spark, sf_dir, NEW_LINES))


@query("mode_full", REPRICED_ORDERS)
def mode_full(spark, sf_dir):
    return modes.full(rows_of(spark, sf_dir, OLD_ORDERS), rows_of(spark, sf_dir, REPRICED_ORDERS))


@query("mode_full_empty", OLD_ORDERS)
def mode_full_empty(spark, sf_dir):
    nothing = "SELECT * FROM orders WHERE o_totalprice < 0"
    return modes.full(rows_of(spark, sf_dir, OLD_ORDERS), rows_of(spark, sf_dir, nothing))


@query("mode_append", f"{OLD_ORDERS} UNION ALL {NEW_ORDERS}")
def mode_append(spark, sf_dir):
    return modes.append(rows_of(spark, sf_dir, OLD_ORDERS), rows_of(spark, sf_dir, NEW_ORDERS))


@query("mode_merge", merged_sql(OLD_ORDERS, NEW_ORDERS, ["o_orderkey"]))
def mode_merge(spark, sf_dir):
    return merged(spark, sf_dir, OLD_ORDERS, NEW_ORDERS, ["o_orderkey"])


OLD_TURNS = "SELECT * FROM conversations WHERE role <> 'system'"
NEW_TURNS = "SELECT conv_id, turn, role, concat(text, ' (edited)') AS text FROM conversations WHERE role <> 'assistant'"


@query("mode_merge_composite_pk", merged_sql(OLD_TURNS, NEW_TURNS, ["conv_id", "turn"]))
def mode_merge_composite_pk(spark, sf_dir):
    return merged(spark, sf_dir, OLD_TURNS, NEW_TURNS, ["conv_id", "turn"])


OLD_NULL_KEYS, NEW_NULL_KEYS = keyed(OLD_ORDERS, NULL_FOR_A_THIRD), keyed(NEW_ORDERS, NULL_FOR_A_THIRD)


@query("mode_merge_null_pk", merged_sql(OLD_NULL_KEYS, NEW_NULL_KEYS, ["o_orderkey"]))
def mode_merge_null_pk(spark, sf_dir):
    return merged(spark, sf_dir, OLD_NULL_KEYS, NEW_NULL_KEYS, ["o_orderkey"])


@query("mode_merge_dup_source", merged_sql(OLD_LINES, NEW_LINES, LINE_KEY))
def mode_merge_dup_source(spark, sf_dir):
    return merged(spark, sf_dir, OLD_LINES, NEW_LINES, LINE_KEY)


OLD_HOT, NEW_HOT = keyed(OLD_ORDERS, ONE_FOR_A_THIRD), keyed(NEW_ORDERS, ONE_FOR_A_THIRD)


@query("mode_merge_hot_key", merged_sql(OLD_HOT, NEW_HOT, ["o_orderkey"]))
def mode_merge_hot_key(spark, sf_dir):
    """One key owns a third of both sides, on the path for keys that are too many to broadcast."""
    target, source = rows_of(spark, sf_dir, OLD_HOT), rows_of(spark, sf_dir, NEW_HOT)
    return modes.merge(target, source, ["o_orderkey"], hot=hot_keys(target, ["o_orderkey"]))


@query(
    "merge_counts",
    f"""SELECT (SELECT count(*) FROM ({OLD_LINES}) t WHERE EXISTS (SELECT 1 FROM ({NEW_LINES}) s
                WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)) AS deleted,
               (SELECT count(*) FROM ({NEW_LINES}) n) AS inserted""",
)
def merge_counts(spark, sf_dir):
    return modes.merge_counts(rows_of(spark, sf_dir, OLD_LINES), rows_of(spark, sf_dir, NEW_LINES), LINE_KEY)


@query(
    "merge_dedupe_source",
    """SELECT * EXCLUDE (nth) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_orderkey DESC,
           l_partkey DESC, l_suppkey DESC, l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
           l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS nth FROM lineitem) x WHERE nth = 1""",
)
def merge_dedupe_source(spark, sf_dir):
    """Of the lines of a key the latest stays whole; ties go by the other columns, in their order."""
    return modes.latest_per_key(rows_of(spark, sf_dir, "SELECT * FROM lineitem"), LINE_KEY, "l_shipdate")


YEAR_ENDS = ["1998-12-31 00:00:00", "1999-12-31 00:00:00", "2000-12-31 00:00:00"]
CHUNK_CASES = " ".join(f"WHEN l_shipdate <= TIMESTAMP '{b}' THEN {i}" for i, b in enumerate(YEAR_ENDS))
CHUNK_SQL = f"CASE {CHUNK_CASES} ELSE {len(YEAR_ENDS)} END"


@query("chunk_assignment", f"SELECT l_orderkey, l_linenumber, l_shipdate, {CHUNK_SQL} AS chunk FROM lineitem")
def chunk_assignment(spark, sf_dir):
    lines = rows_of(spark, sf_dir, "SELECT * FROM lineitem")
    chunk = chunk_index(F.col("l_shipdate"), YEAR_ENDS, lines.schema["l_shipdate"].dataType)
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate", chunk.alias("chunk"))


LAST_CHUNKS = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate
FROM (SELECT *, max(chunk) OVER (PARTITION BY l_orderkey, l_linenumber) AS last_chunk
      FROM (SELECT *, {CHUNK_SQL} AS chunk FROM ({NEW_LINES}) n) c) w
WHERE chunk = last_chunk
"""
LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, "
    "l_linestatus, l_shipdate"
)
CHUNKED_MERGE = f"SELECT {LINE_COLUMNS} FROM ({merged_sql(OLD_LINES, LAST_CHUNKS, LINE_KEY)}) m"


@query("mode_chunked_merge", CHUNKED_MERGE)
def mode_chunked_merge(spark, sf_dir):
    target, source = rows_of(spark, sf_dir, OLD_LINES), rows_of(spark, sf_dir, NEW_LINES)
    how = plan_match(target, source, LINE_KEY) | {"hot": hot_on_either(target, source, LINE_KEY)}
    return modes.chunked_merge(target, source, LINE_KEY, "l_shipdate", YEAR_ENDS, **how)


ALIGN_SOURCE = "SELECT c_nationkey, c_name AS C_NAME, CAST(c_acctbal AS VARCHAR(30)) AS C_AcctBal, c_custkey FROM customer"


@query(
    "align_columns",
    """SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey,
              'NONE' AS c_segment, CAST(NULL AS VARCHAR) AS c_note FROM customer""",
)
def align_columns(spark, sf_dir):
    target = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_nationkey", T.LongType()),
            T.StructField("c_segment", T.StringType()),
            T.StructField("c_note", T.StringType()),
        ]
    )
    return align(rows_of(spark, sf_dir, ALIGN_SOURCE), target, {"C_SEGMENT": "NONE"})


# Nations as text that is a number for most customers; balances that must be whole.
MIXED = """
SELECT c_custkey, c_name,
       CASE c_custkey % 7 WHEN 0 THEN concat('n/a ', CAST(c_custkey AS VARCHAR(9))) WHEN 1 THEN '007' WHEN 2 THEN ''
            ELSE CAST(c_nationkey AS VARCHAR(9)) END AS nation,
       CASE WHEN c_custkey % 5 = 0 THEN c_acctbal ELSE floor(c_acctbal) END AS balance FROM customer"""
MIXED_TARGET = (
    T.StructType()
    .add("c_custkey", T.LongType())
    .add("nation", T.IntegerType())
    .add("balance", T.LongType())
    .add("c_name", T.StringType())
    .add("note", T.StringType())
)
BAD_NATION = "(nation IS NOT NULL AND TRY_CAST(nation AS INTEGER) IS NULL)"
BAD_BALANCE = "(balance IS NOT NULL AND CAST(balance AS BIGINT) <> balance)"


@query(
    "align_good_rows",
    f"""SELECT c_custkey, TRY_CAST(nation AS INTEGER) AS nation, CAST(balance AS BIGINT) AS balance, c_name, 'none' AS note
        FROM ({MIXED}) m WHERE NOT {BAD_NATION} AND NOT {BAD_BALANCE}""",
)
def align_good_rows(spark, sf_dir):
    return good_rows(align_marked(rows_of(spark, sf_dir, MIXED), MIXED_TARGET, {"note": "none"}))


@query(
    "align_rejects",
    f"""SELECT 'nation' AS field, nation AS text, 'not a int' AS reason FROM ({MIXED}) m WHERE {BAD_NATION}
        UNION ALL SELECT 'balance', CAST(balance AS VARCHAR), 'not a bigint' FROM ({MIXED}) n WHERE {BAD_BALANCE}""",
)
def align_rejects(spark, sf_dir):
    return rejected(align_marked(rows_of(spark, sf_dir, MIXED), MIXED_TARGET, {"note": "none"})).drop("row")
