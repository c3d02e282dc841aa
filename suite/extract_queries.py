"""Sources, projections, filters and order."""

from __future__ import annotations

from suite.registry import query, rows_of, tables
from tidemark.functions.clean import clean
from tidemark.functions.text import encode
from tidemark.plans.load import union_sources
from tidemark.sources.connections import Connection
from tidemark.sources.extract import extract, schema_probe
from tidemark.spec import Mapping, Source


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, sf_dir):
    return extract(spark, tables(sf_dir), Source(table="orders"))


JOIN_AGG = """
SELECT n_name, o_orderstatus, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderstatus
"""


@query("query_source_join_agg", JOIN_AGG)
def query_source_join_agg(spark, sf_dir):
    return rows_of(spark, sf_dir, JOIN_AGG)


TOP_ORDERS = """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS BIGINT) AS place FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) ranked
WHERE rn <= 3
"""


@query("query_source_window_topk", TOP_ORDERS)
def query_source_window_topk(spark, sf_dir):
    return rows_of(spark, sf_dir, TOP_ORDERS)


PARTIES = """
SELECT c_nationkey AS nationkey, c_name AS party FROM customer
UNION ALL SELECT s_nationkey, s_name FROM supplier
UNION SELECT n_nationkey, n_name FROM nation
"""


@query("query_source_union", PARTIES)
def query_source_union(spark, sf_dir):
    return rows_of(spark, sf_dir, PARTIES)


SEMI_ANTI = """
SELECT c_custkey, 'buyer' AS kind FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
UNION ALL
SELECT c_custkey, 'idle' AS kind FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
"""


@query("query_source_semi_anti", SEMI_ANTI)
def query_source_semi_anti(spark, sf_dir):
    return rows_of(spark, sf_dir, SEMI_ANTI)


ROLLUP = """
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
"""


@query("query_source_rollup", ROLLUP)
def query_source_rollup(spark, sf_dir):
    return rows_of(spark, sf_dir, ROLLUP)


@query(
    "multi_source_append",
    """SELECT c_custkey AS party_id, c_name AS party_name, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier""",
)
def multi_source_append(spark, sf_dir):
    customers = Mapping.of({"c_custkey": "party_id", "c_name": "party_name", "c_acctbal": "balance"})
    suppliers = Mapping.of({"s_suppkey": "party_id", "s_name": "party_name", "s_acctbal": "balance"})
    sources = [Source(table="customer", mapping=customers), Source(table="supplier", mapping=suppliers)]
    return union_sources([extract(spark, tables(sf_dir), s) for s in sources])


@query("project_mapped", "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS amount FROM orders")
def project_mapped(spark, sf_dir):
    mapping = Mapping.parse('{"o_orderkey": "order_id", " o_custkey ": "customer_id", "o_totalprice": "amount"}')
    return extract(spark, tables(sf_dir), Source(table="orders", mapping=mapping))


@query("project_star", "SELECT * FROM lineitem")
def project_star(spark, sf_dir):
    return extract(spark, tables(sf_dir), Source(table="lineitem"))


@query(
    "project_expr",
    """SELECT floor(o_totalprice * 0.9) AS net, CAST(o_orderkey AS VARCHAR) AS order_text, 1 AS one,
              orders.o_custkey AS customer_id, upper(o_orderpriority) AS priority FROM orders""",
)
def project_expr(spark, sf_dir):
    mapping = Mapping.of(
        {
            "CAST(floor(o_totalprice * 0.9) AS DOUBLE)": "net",
            "cast(o_orderkey as string)": "order_text",
            "1": "one",
            "orders.o_custkey": "customer_id",
            "upper(o_orderpriority)": "priority",
        }
    )
    return extract(spark, tables(sf_dir), Source(table="orders", mapping=mapping))


@query(
    "project_quoted",
    "SELECT o_orderkey AS order_key, o_custkey AS customer, o_totalprice AS total, o_orderdate AS order_date FROM orders",
)
def project_quoted(spark, sf_dir):
    odd_names = spark.read.parquet(tables(sf_dir).path_of("orders")).selectExpr(
        "o_orderkey AS `Order Key`", "o_custkey AS `客户/号`", "o_totalprice AS `Total (USD)`", "o_orderdate AS `a + b`"
    )
    odd_names.createOrReplaceTempView("orders_odd_names")
    mapping = Mapping.of({"Order Key": "order_key", "客户/号": "customer", "[Total (USD)]": "total", "a + b": "order_date"})
    return extract(spark, Connection("session"), Source(table="orders_odd_names", mapping=mapping))


@query("filter_where", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O'")
def filter_where(spark, sf_dir):
    return extract(spark, tables(sf_dir), Source(table="orders", where="  o_totalprice > 100000 AND o_orderstatus = 'O' "))


BUSY_CUSTOMERS = "SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey"


@query("filter_outer", f"SELECT * FROM ({BUSY_CUSTOMERS}) t WHERE t.n_orders >= 10")
def filter_outer(spark, sf_dir):
    return extract(spark, tables(sf_dir), Source(sql=BUSY_CUSTOMERS, where="t.n_orders >= 10"))


@query("incr_filter", "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def incr_filter(spark, sf_dir):
    return extract(spark, tables(sf_dir), Source(table="events", incr_field="ts"), "append", "2024-01-15 12:00:00")


@query(
    "incr_template",
    """SELECT event_id, ts AS event_time, event_type FROM events
       WHERE ts > TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'error'""",
)
def incr_template(spark, sf_dir):
    source = Source(
        table="events",
        mapping=Mapping.of({"event_id": "event_id", "ts": "event_time", "event_type": "event_type"}),
        where="\"${SRC_INCR_FIELD}\" > '${INCR_POINT}' AND event_type <> 'error'",
        incr_field="ts",
    )
    return extract(spark, tables(sf_dir), source, "merge", "2024-01-20 00:00:00")


@query(
    "incr_template_query",
    """SELECT user_id, count(*) AS n_events, max(ts) AS last_ts FROM events
       WHERE ts > TIMESTAMP '2024-01-10 00:00:00' GROUP BY user_id""",
)
def incr_template_query(spark, sf_dir):
    sql = "SELECT user_id, count(*) AS n_events, max(ts) AS last_ts FROM events WHERE ts > '${INCR_POINT}' GROUP BY user_id"
    return extract(spark, tables(sf_dir), Source(sql=sql, incr_field="last_ts"), "merge", "2024-01-10 00:00:00")


@query("ordered_extract", "SELECT event_id, ts, value FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00'")
def ordered_extract(spark, sf_dir):
    source = Source(table="events", incr_field="ts", mapping=Mapping.of({"event_id": "event_id", "ts": "ts", "value": "value"}))
    return extract(spark, tables(sf_dir), source, "append", "2024-01-05 00:00:00", ordered=True)


@query(
    "schema_probe",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS ordered,
              '\\x' || md5(o_orderpriority) AS bytes FROM orders""",
)
def probed_text(spark, sf_dir):
    """The probe gives the types without reading rows; they choose the text form of every column of the whole table."""
    names = {"o_orderkey": "id", "o_orderstatus": "status", "o_orderdate": "ordered", "unhex(md5(o_orderpriority))": "bytes"}
    source = Source(table="orders", mapping=Mapping.of(names))
    types = schema_probe(spark, tables(sf_dir), source)
    rows = extract(spark, tables(sf_dir), source)
    return rows.select(*[encode(rows[f.name], f.dataType).alias(f.name) for f in types.fields])


@query("transform_hook", "SELECT doc_id, upper(lang) AS lang, source, n_chars * 2 AS twice FROM documents")
def transform_hook(spark, sf_dir):
    def hook(df):
        return df.selectExpr("doc_id", "upper(lang) AS lang", "source", "n_chars * 2 AS twice")

    return clean(extract(spark, tables(sf_dir), Source(table="documents"))).transform(hook)
