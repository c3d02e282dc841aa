import duckdb
import pytest
from pyspark.sql import types as T

from conftest import SMALL, rows
from suite.registry import tables
from tidemark.sources.connections import Connection
from tidemark.sources.extract import extract, fill_field, fill_point, order_sql, projection_sql, remote_literal, remote_sql, schema_probe, where_sql
from tidemark.sources.jdbc import depth_predicates, depth_sql, guid_columns, read, read_options
from tidemark.sources.naming import field_sql
from tidemark.spec import Mapping, Source, SpecError


@pytest.mark.parametrize(
    ("field", "spark_sql", "mssql", "postgres"),
    [
        ("CamelCase", "`CamelCase`", "[CamelCase]", '"CamelCase"'),
        ("GETDATE()", "GETDATE()", "GETDATE()", "GETDATE()"),
        ("dbo.sourceId", "dbo.sourceId", "dbo.sourceId", "dbo.sourceId"),
        ("Cost Saving", "`Cost Saving`", "[Cost Saving]", '"Cost Saving"'),
        ("故障DC/LC", "`故障DC/LC`", "[故障DC/LC]", '"故障DC/LC"'),
        ("[Price(USD)]", "`Price(USD)`", "[Price(USD)]", "[Price(USD)]"),
        ('"OrderID"', "`OrderID`", '"OrderID"', '"OrderID"'),
        ("a + b", "`a + b`", "[a + b]", '"a + b"'),
        ("-1", "-1", "-1", "-1"),
        ("od`d", "`od``d`", "[od`d]", '"od`d"'),
    ],
)
def test_field_quoting(field, spark_sql, mssql, postgres):
    assert field_sql(field) == spark_sql
    assert field_sql(field, "mssql") == mssql
    assert field_sql(field, "postgres") == postgres


def test_projection_text():
    mapping = Mapping.of({"now()": "cdt", "CamelCase": "TargetName"})
    assert projection_sql(Source(table="a", mapping=mapping), "postgres") == '"CamelCase" AS "TargetName", now() AS "cdt"'
    assert projection_sql(Source(table="a")) == "*"


def test_where_text():
    assert where_sql(Source(where=" a > 1 ")) == "a > 1"
    assert where_sql(Source(where="  ")) == "1=1"
    assert where_sql(Source(where="a > ${INCR_POINT}"), empty=True) == "1=0"


def test_placeholders():
    assert fill_field('"${SRC_INCR_FIELD}" [${SRC_INCR_FIELD}] ${SRC_INCR_FIELD}', "a b") == "`a b` `a b` `a b`"
    assert fill_point("x > '${INCR_POINT}'", ":p", "5") == "x > :p"
    assert fill_point("x > ${INCR_POINT} AND y = 'it''s'", ":p", "5") == "x > :p AND y = 'it''s'"
    assert fill_point("x = 'at ${INCR_POINT}' OR x > ${INCR_POINT}", ":p", "5'") == "x = 'at 5''' OR x > :p"
    for fill in (lambda: fill_field("${SRC_INCR_FIELD} > 1", ""), lambda: fill_point("a > ${INCR_POINT}", ":p", "")):
        with pytest.raises(SpecError):
            fill()


def test_order_text():
    source = Source(table="a", incr_field="ts", order_by="id DESC")
    assert order_sql(source, "full") == ""
    assert order_sql(source, "append") == " ORDER BY id DESC"
    assert order_sql(Source(table="a", incr_field="ts"), "merge") == ""
    assert order_sql(Source(table="a", incr_field="ts"), "merge", chunked=True) == " ORDER BY ${SRC_INCR_FIELD} ASC NULLS LAST"


def test_order_of_extract(spark):
    source = Source(table="events", incr_field="ts")
    times = [r.ts for r in extract(spark, tables(SMALL), source, "append", "2024-01-20 00:00:00", ordered=True).collect()]
    assert times == sorted(times) and times
    by_hidden = Source(table="orders", incr_field="o_orderdate", order_by="o_totalprice DESC", mapping=Mapping.of({"o_orderkey": "k"}))
    keys = [r.k for r in extract(spark, tables(SMALL), by_hidden, "merge", "2000-01-01 00:00:00", ordered=True).collect()]
    prices = {r.o_orderkey: r.o_totalprice for r in extract(spark, tables(SMALL), Source(table="orders")).collect()}
    assert [prices[k] for k in keys] == sorted((prices[k] for k in keys), reverse=True)


def test_automatic_predicate(spark):
    def count(mode, point, **changes):
        return extract(spark, tables(SMALL), Source(table="events", incr_field="event_id", **changes), mode, point).count()

    total = count("initial", None)
    assert count("append", None) == total
    assert count("append", "9") == total - 10
    assert count("full", "9") == total
    assert count("append", "9", auto_incr=False) == total
    assert count("append", "9", lookback="5") == total - 5
    assert count("append", "9", where="event_id > ${INCR_POINT} - 3") == total - 7
    assert count("append", "9", where="event_id < 100 OR event_id < 50") == 90


def test_first_load_with_template_uses_the_typed_default(spark):
    source = Source(table="events", incr_field="ts", where="${SRC_INCR_FIELD} > '${INCR_POINT}'")
    assert extract(spark, tables(SMALL), source, "append").count() == extract(spark, tables(SMALL), Source(table="events")).count()


def test_user_text_with_braces_and_colons(spark):
    source = Source(table="events", where="props <> '{x}' AND props LIKE '{\"k\": %'", incr_field="event_id")
    assert extract(spark, tables(SMALL), source, "append", "9").count() > 0


def test_schema_probe_reads_no_rows(spark):
    source = Source(table="orders", mapping=Mapping.of({"o_orderkey": "id", "CAST(o_totalprice AS DECIMAL(12, 2))": "price"}))
    schema = schema_probe(spark, tables(SMALL), source)
    assert {f.name: f.dataType for f in schema.fields} == {"id": T.LongType(), "price": T.DecimalType(12, 2)}
    probe = extract(spark, tables(SMALL), source, empty=True)
    assert probe.count() == 0
    assert "LocalTableScan" in plan(probe)


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_filter_and_columns_reach_the_scan(spark):
    source = Source(table="events", incr_field="ts", mapping=Mapping.of({"event_id": "id", "ts": "t"}))
    text = plan(extract(spark, tables(SMALL), source, "append", "2024-01-15 00:00:00"))
    assert "GreaterThan(ts,2024-01-15" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


PG = Connection("pg", "postgres", options={"url": "jdbc:postgresql://db/x", "partitionColumn": "id", "numPartitions": "4"})


def test_remote_statement():
    source = Source(
        table="public.orders", incr_field="updated at", where="a = 1 OR b = 2", mapping=Mapping.of({"OrderID": "id", "now()": "cdt"})
    )
    assert remote_sql(PG, source, "merge", "it's") == (
        'SELECT "OrderID" AS "id", now() AS "cdt" FROM public.orders WHERE (a = 1 OR b = 2) AND "updated at" > \'it\'\'s\''
    )
    assert remote_sql(PG, source, "merge", "x", empty=True).endswith("WHERE 1=0")
    query = Source(sql="SELECT * FROM a WHERE [${SRC_INCR_FIELD}] > '${INCR_POINT}'", incr_field="ts")
    mssql = Connection("m", "mssql")
    assert remote_sql(mssql, query, "merge", "5") == "SELECT * FROM (SELECT * FROM a WHERE [ts] > '5') t WHERE (1=1)"
    with pytest.raises(SpecError):
        remote_sql(PG, Source(table="db.public.orders"))


def test_jdbc_reader_options():
    bounds = {"partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "4"}
    options = read_options(PG, Source(table="a", batch_size=500), "SELECT 1", bounds)
    assert options == {"url": "jdbc:postgresql://db/x", "dbtable": "(SELECT 1) t", "fetchsize": "500", "preferTimestampNTZ": "true"} | bounds


class FakeReader:
    """Stands in for ``spark.read`` where there is no database: records options, answers with a frame."""

    def __init__(self, answer):
        self.answer, self.asked = answer, []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        return self.answer

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"url": url, "dbtable": table, "predicates": predicates} | properties)
        return self.answer


def test_jdbc_read_is_split(spark):
    mssql = Connection("m", "mssql", options={"url": "u", "partitionColumn": "[Order Id]"})
    reader = FakeReader(spark.sql("SELECT 1L AS lo, 90L AS hi"))
    read(reader, mssql, Source(table="a"), "SELECT 1")
    assert reader.asked[0]["dbtable"] == "(SELECT MIN([Order Id]) AS lo, MAX([Order Id]) AS hi FROM (SELECT 1) b) t"
    split = {k: reader.asked[1][k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    assert split == {"partitionColumn": "Order Id", "lowerBound": "1", "upperBound": "90", "numPartitions": "32"}


def test_jdbc_read_splits_by_the_incremental_field(spark):
    pg = Connection("p", "pg", options={"url": "u", "numPartitions": "8"})
    source = Source(table="a", incr_field="updated at", mapping=Mapping.of({"updated at": "seen"}))
    reader = FakeReader(spark.sql("SELECT timestamp_ntz'2024-01-01' AS lo, timestamp_ntz'2024-02-01' AS hi"))
    read(reader, pg, source, "SELECT 1")
    assert reader.asked[1]["partitionColumn"] == "seen" and reader.asked[1]["lowerBound"] == "2024-01-01 00:00:00"
    for answer in ("SELECT CAST(NULL AS long) AS lo, CAST(NULL AS long) AS hi",):
        reader = FakeReader(spark.sql(answer))
        read(reader, pg, source, "SELECT 1")
        assert "partitionColumn" not in reader.asked[1]


@pytest.mark.parametrize(("kind", "quote"), [("mssql", "N'"), ("postgres", "'")])
def test_text_and_guid_keys_are_split_by_equal_depth(spark, kind, quote):
    connection = Connection("c", kind, options={"url": "u", "partitionColumn": "code", "numPartitions": "3"})
    reader = FakeReader(spark.createDataFrame([("2", "m"), ("1", "it's"), ("3", "z")], "lo string, hi string"))
    read(reader, connection, Source(table="a"), "SELECT 1")
    name = "[code]" if kind == "mssql" else '"code"'
    value = f"CAST({name} AS {'NVARCHAR(4000)' if kind == 'mssql' else 'TEXT'})"
    assert "NTILE(3) OVER (ORDER BY " + value in reader.asked[1]["dbtable"]
    assert reader.asked[2]["predicates"] == [
        f"{value} <= {quote}it''s'",
        f"{value} > {quote}it''s' AND {value} <= {quote}m'",
        f"{value} > {quote}m' OR {name} IS NULL",
    ]
    assert reader.asked[2]["dbtable"] == "(SELECT 1) t" and "numPartitions" not in reader.asked[2]


@pytest.mark.parametrize("column", ["code", "guid", "skewed", "one", "none"])
def test_predicates_hold_of_every_row_once(column):
    """The statements run in DuckDB, which has the window function they use."""
    db = duckdb.connect()
    db.execute("""CREATE TABLE t AS SELECT i, CASE WHEN i % 50 <> 0 THEN 'it''s ' || (i * 7919 % 1000) END AS code, uuid() AS guid,
                  CASE WHEN i % 3 = 0 THEN 5 ELSE i * i END AS skewed, 'x' AS one, NULL::VARCHAR AS none FROM range(1000) r(i)""")
    sql, name, as_text = "SELECT * FROM t", f'"{column}"', column != "skewed"
    highs = db.execute(depth_sql(PG, sql, name, 8, as_text=as_text)).fetchall()
    predicates = depth_predicates(PG, name, highs, as_text=as_text)
    if column in ("one", "none"):
        assert predicates is None
        return
    counts = [db.execute(f"SELECT count(*) FROM ({sql}) q WHERE {p}").fetchone()[0] for p in predicates]
    assert sum(counts) == 1000 and all(counts)
    assert max(counts) <= (1000 // 3 + 130 if column == "skewed" else 160)


def test_the_number_of_splits_follows_the_counted_rows(spark):
    connection = Connection("c", "postgres", options={"url": "u", "partitionColumn": "id", "rowsPerPartition": "1000"})
    reader = FakeReader(spark.sql("SELECT 12345L AS lo, 20000L AS hi"))
    read(reader, connection, Source(table="a"), "SELECT 1")
    assert reader.asked[1]["dbtable"] == "(SELECT COUNT(*) AS n FROM (SELECT 1) c) t" and reader.asked[2]["numPartitions"] == "13"
    assert "rowsPerPartition" not in reader.asked[2]


def test_guid_columns(spark):
    known = bytes.fromhex("33221100554477668899aabbccddeeff")
    df = spark.createDataFrame([(known, "ab"), (None, None), (known[:15], "c")], "g binary, t string")
    assert rows(guid_columns(df, ["g", "t"])) == sorted(
        [("00112233-4455-6677-8899-AABBCCDDEEFF", "AB"), (None, None), ("", "C")], key=repr
    )


def test_remote_points_are_literals_of_their_type():
    stamp = T.TimestampNTZType()
    assert remote_literal("2024-01-02 03:04:05.120000", stamp, "postgres") == "CAST('2024-01-02 03:04:05.12' AS timestamp)"
    assert remote_literal("2024-01-02 03:04:05.000000", stamp, "mssql") == "CAST('2024-01-02 03:04:05' AS datetime2)"
    assert remote_literal("2024-01-02 03:04:05.500000+02:00", T.TimestampType(), "greenplum").startswith("CAST('2024-01-02 03:04:05.5+02:00'")
    assert remote_literal("10", T.LongType(), "mssql") == "'10'"
    assert remote_literal("it's", T.StringType(), "postgres") == "'it''s'"


def test_lookback_follows_a_typed_point():
    source = Source(table="public.t", incr_field="at", lookback="INTERVAL '1' DAY")
    sql = remote_sql(PG, source, "append", "2024-01-02 00:00:00.000000", dtype=T.TimestampNTZType())
    assert sql.endswith("> CAST('2024-01-02 00:00:00' AS timestamp) - INTERVAL '1' DAY")


@pytest.mark.parametrize("mode", ["initial", "full", "append", "merge"])
@pytest.mark.parametrize(("given", "point"), [("", "1"), ("7", "7")])
def test_a_template_on_a_database_has_a_point_in_every_mode(spark, monkeypatch, mode, given, point):
    seen = []
    monkeypatch.setattr("tidemark.sources.extract.incr_type", lambda *a: T.LongType())
    monkeypatch.setattr("tidemark.sources.jdbc.read", lambda spark, connection, source, sql, **k: seen.append(sql))
    source = Source(sql="SELECT id FROM t WHERE id > ${INCR_POINT}", incr_field="id", incr_point=given)
    extract(spark, PG, source, mode)
    assert seen == [f"SELECT * FROM (SELECT id FROM t WHERE id > '{point}') t WHERE (1=1)"]
