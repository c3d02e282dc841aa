"""Whole loads: marks between runs, several sources, error policy, jobs, streams, the database target."""

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark.operators import hwm
from tidemark.operators.jobs import mapping_violations, tasks_of
from tidemark.plans.load import run_log, run_task, run_tasks
from tidemark.sinks.database import DatabaseTable, apply_staging, check_sink, write_options
from tidemark.sinks.store import TableStore
from tidemark.sources.connections import Connection
from tidemark.spec import Mapping, Source, SpecError, Target, Task
from tidemark.streaming.arrivals import load_arrivals

SESSION = [Connection("session", "catalog", id="7", database="db")]
SCHEMA = "id long, v string, at timestamp_ntz"


def view(spark, name, *data):
    df = spark.createDataFrame(list(data), "id long, v string, at string")
    df.withColumn("at", F.col("at").cast("timestamp_ntz")).createOrReplaceTempView(name)


def task(mode, *sources, **target):
    return Task("nightly", sources, Target("ods.t", mode, **target), error_policy=target.pop("policy", "abort"))


def source(table="src", **changes):
    return Source(**{"table": table, "connection": "session", "incr_field": "at"} | changes)


def test_runs_go_on_from_the_mark(spark, store):
    table = store(SCHEMA)
    view(spark, "src", (1, " ", "2024-01-01"), (2, "b\x00", "2024-01-02"))
    first = run_task(spark, task("append", source()), SESSION, table)
    assert (first[0].status, first[0].rows_read, first[0].rows_written) == ("success", 2, 2)
    view(spark, "src", (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-03"))
    assert run_task(spark, task("append", source()), SESSION, table)[0].rows_written == 1
    assert run_task(spark, task("append", source()), SESSION, table)[0].rows_written == 0
    assert [(r[0], r[1]) for r in rows(table.read())] == [(1, ""), (2, "b"), (3, "c")]


def test_id_one_is_loaded_on_a_first_run(spark, store):
    table = store(SCHEMA)
    view(spark, "src", (0, "a", "2024-01-01"), (1, "b", "2024-01-01"), (2, "c", None))
    run_task(spark, task("append", source(incr_field="id")), SESSION, table)
    assert table.read().count() == 3


def test_configured_point_is_only_a_start(spark, store):
    table = store(SCHEMA)
    view(spark, "src", *[(i, "x", f"2024-01-0{i}") for i in range(1, 8)])
    late = source(incr_field="id", incr_point="3")
    assert run_task(spark, task("append", late), SESSION, table)[0].rows_written == 4
    assert run_task(spark, task("append", late), SESSION, table)[0].rows_written == 0


def test_without_a_mark_the_target_maximum_counts(spark, store):
    table = store("k long, v string, seen timestamp_ntz")
    view(spark, "src", (1, "a", "2024-01-01"), (2, "b", "2024-01-02"))
    mapping = Mapping.of({"id": "k", "v": "v", "at": "seen"})
    run_task(spark, task("initial", source(mapping=mapping)), SESSION, table)
    view(spark, "src", (2, "b", "2024-01-02"), (3, "c", "2024-01-03"))
    done = run_task(spark, task("merge", source(mapping=mapping), pk="k"), SESSION, table)
    assert (done[0].rows_written, done[0].rows_deleted) == (1, 0)
    assert table.marks().first().src_incr_field == "at"


def test_coded_behaviour_reads_everything_again(spark, store):
    table = store(SCHEMA)
    view(spark, "src", (1, "a", "2024-01-01"))
    for _ in range(2):
        run_task(spark, task("append", source(auto_incr=False)), SESSION, table)
    assert table.read().count() == 2


def test_full_takes_all_sources_at_once(spark, store):
    table = store(SCHEMA)
    view(spark, "one", (1, "a", "2024-01-01"))
    view(spark, "two", (2, "b", "2024-01-01"))
    full = task("full", source("one"), source("two"))
    for _ in range(2):
        run_task(spark, full, SESSION, table)
    assert [r[0] for r in rows(table.read())] == [1, 2]


def test_error_policy(spark, store):
    view(spark, "good", (1, "a", "2024-01-01"))
    broken, good = source("missing_table"), source("good")
    table = store(SCHEMA)
    log = run_task(spark, Task("n", (broken, good), Target("ods.t", "append"), "continue"), SESSION, table)
    assert [r.status for r in log] == ["failed", "success"] and "missing_table" in log[0].error
    assert run_log(spark, log).where("status = 'failed'").count() == 1
    with pytest.raises(Exception, match="missing_table"):
        run_task(spark, Task("n", (broken, good), Target("ods.t", "append")), SESSION, store(SCHEMA))


@pytest.mark.parametrize("as_query", [False, True])
@pytest.mark.parametrize("mode", ["append", "merge"])
def test_chunked_run_is_the_run(spark, store, mode, as_query):
    ids = spark.range(200).selectExpr("id % 50 AS id", "'x' AS v", "timestamp_ntz'2024-01-01' + make_dt_interval(cast(id DIV 10 as int)) AS at")
    ids.createOrReplaceTempView("many")
    what = {"table": "", "sql": "SELECT * FROM many"} if as_query else {"table": "many"}
    chunked, whole = store(SCHEMA), store(SCHEMA)
    run_task(spark, task(mode, source(batch_size=10, **what), pk="id", commit_batch_size=6), SESSION, chunked)
    run_task(spark, task(mode, source(**what), pk="id"), SESSION, whole)
    assert chunked.snapshot().version == 4
    if mode == "append":
        assert rows(chunked.read()) == rows(whole.read())
    else:
        ids_left = [r.id for r in chunked.read().select("id").distinct().collect()]
        assert sorted(ids_left) == list(range(50)) and chunked.read().count() == chunked.snapshot().rows
    assert chunked.marks().first().incr_point == whole.marks().first().incr_point


def test_hook_runs_between_clean_and_align(spark, store):
    table = store("id long, v string")
    view(spark, "src", (1, "a\x00", "2024-01-01"))
    hook = lambda df: df.selectExpr("id", "concat(v, '!') AS v")
    run_task(spark, task("initial", source()), SESSION, table, hook)
    assert rows(table.read()) == [(1, "a!")]


def test_guids_and_transforms_of_a_source(spark, store):
    table = store("g string, v string")
    known = bytes.fromhex("33221100554477668899aabbccddeeff")
    spark.createDataFrame([(known, "\x00a")], "g binary, v string").createOrReplaceTempView("src")
    what = Source(table="src", connection="session", guids=("g",), transforms=(("v", "upper"), ("v", "suffix", "!")))
    run_task(spark, task("initial", what), SESSION, table)
    assert rows(table.read()) == [("00112233-4455-6677-8899-AABBCCDDEEFF", "A!")]


# Marks as a control table


def test_identity():
    three = Source(table="sales.dbo.orders")
    key = hwm.identity(" nightly ", "db", three, Target("ods.t", "append"))
    assert (key["job_name"], key["src_db_name"], key["src_schema_name"], key["src_table_name"]) == ("nightly", "sales", "dbo", "orders")
    by_sql = hwm.identity("n", "db", Source(sql=" SELECT 1 "), Target("t", "append"))
    assert (by_sql["src_rawsql"], by_sql["src_table_name"], by_sql["dst_schema_name"]) == ("SELECT 1", "", "")
    for bad in (lambda: hwm.identity("n", "d", Source(), Target("t", "append")), lambda: hwm.identity("n", "d", three, Target("a.b.c", "append"))):
        with pytest.raises(SpecError):
            bad()


def test_default_points(spark):
    names = ["ts", "UpdatedAt", "order_date", "CDT", "created", "lastmodified", "id", "runtime"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", hwm.default_point_by_name(F.col("n")).alias("d"))
    assert [r.n for r in df.where("d = '1'").collect()] == ["ts", "id"]
    assert hwm.default_point(T.TimestampNTZType(), "ts") == "1970-01-01 00:00:00.000"
    assert hwm.default_point(T.LongType(), "created") == "1"
    assert hwm.default_point(T.StringType(), "created") == "1970-01-01 00:00:00.000"


def test_points_compare_in_their_type(spark):
    key = {k: "x" for k in hwm.KEY}
    control = spark.createDataFrame([tuple(key.values()) + ("9", "append", "id", "", None, None)], ", ".join(f"{k} string" for k in hwm.KEY) + ", incr_point string, sync_mode string, src_incr_field string, dst_pk string, cdt timestamp_ntz, udt timestamp_ntz")
    update = control.withColumn("incr_point", F.lit("10")).drop("cdt", "udt")
    now = F.lit("2024-01-01").cast("timestamp_ntz")
    assert hwm.upsert(control, update, T.LongType(), now).first().incr_point == "10"
    assert hwm.upsert(control, update.withColumn("incr_point", F.lit("8")), T.LongType(), now).first().incr_point == "9"
    assert hwm.upsert(control, update.withColumn("incr_point", F.lit(" ")), T.LongType(), now).first().incr_point == "9"


# Jobs

JOB_COLUMNS = (
    "job_id long, job_name string, src_conn_id string, src_db_name string, src_schema_name string, src_table_name string, "
    "src_rawsql string, src_where_statement string, fields_mapping string, src_incr_field string, incr_point string, "
    "sync_mode string, dst_schema_name string, dst_table_name string, dst_pk string, inuse boolean"
)


def job(number, **changes):
    row = dict(
        job_id=number, job_name="n", src_conn_id="7", src_db_name="db", src_schema_name="", src_table_name="", src_rawsql="SELECT * FROM src",
        src_where_statement=" id > 0 ", fields_mapping="*", src_incr_field="at", incr_point=None, sync_mode="merge", dst_schema_name="ods",
        dst_table_name=f"t{number}", dst_pk="id", inuse=True,
    ) | changes
    return tuple(row[c.split()[0]] for c in JOB_COLUMNS.split(", "))


def test_jobs_become_tasks_and_run(spark, store):
    view(spark, "src", (1, "a", "2024-01-01"), (-1, "b", "2024-01-01"))
    mapped = job(1, fields_mapping='{"id": "id", "v": "v"}', sync_mode="full", src_incr_field=None)
    jobs = spark.createDataFrame([job(2), mapped, job(3, inuse=False), job(4, sync_mode="delta"), job(5, job_name="other")], JOB_COLUMNS)
    tasks = tasks_of(jobs, "n", SESSION)
    assert [t.target.table for t in tasks] == ["ods.t1", "ods.t2"]
    stores = {"ods.t1": store("id long, v string"), "ods.t2": store(SCHEMA)}
    log = run_tasks(spark, tasks, SESSION, lambda target: stores[target.table])
    assert [r.rows_written for r in log] == [1, 1]
    assert stores["ods.t2"].marks().first().src_rawsql == "SELECT * FROM src"


@pytest.mark.parametrize(
    "bad",
    [
        dict(src_conn_id=None),
        dict(dst_schema_name=""),
        dict(dst_table_name=None),
        dict(src_db_name=" "),
        dict(fields_mapping='{"a": 1}'),
        dict(src_rawsql=" "),
        dict(dst_pk=""),
        dict(job_name="elsewhere"),
    ],
)
def test_bad_jobs(spark, bad):
    with pytest.raises(SpecError):
        tasks_of(spark.createDataFrame([job(1, **bad)], JOB_COLUMNS), "n", SESSION)


def test_mapping_violations(spark):
    raws = ['{"k": "where", "p": "p/q", "web.k": "ok", "upper(k)": "u", "": "x", "y": ""}', '{"p": {"q": "r"}}', "*", '{"p": null}', "null", '[1]']
    jobs = spark.createDataFrame(list(enumerate(raws)), "job_id long, fields_mapping string")
    found = {(r.job_id, r.source, r.violation, r.severity) for r in mapping_violations(jobs).collect()}
    assert found == {
        (0, "k", "reserved_target", "error"),
        (0, "p", "bad_target", "error"),
        (0, "web.k", "odd_source", "warning"),
        (0, "", "empty_source", "error"),
        (0, "y", "empty_target", "error"),
        (1, "", "bad_json", "error"),
        (3, "p", "empty_target", "error"),
        (5, "", "bad_json", "error"),
    }


# Streams


def test_stream_goes_on_and_keeps_the_largest_mark(spark, store, tmp_path):
    table, folder = store("id long, at long"), str(tmp_path / "in")
    key = {k: "s" for k in hwm.KEY}

    def drop_and_run(low, high):
        spark.range(low, high).selectExpr("id", "id AS at").coalesce(1).write.mode("append").parquet(folder)
        schema = T.StructType().add("id", T.LongType()).add("at", T.LongType())
        options = {"name": "q", "checkpoint": str(tmp_path / "cp"), "pk": ["id"], "incr": "at", "key": key}
        load_arrivals(spark, folder, schema, table, "merge", **options).awaitTermination()

    drop_and_run(100, 110)
    assert table.stored_point(key) == "109"
    drop_and_run(0, 10)
    assert table.stored_point(key) == "109" and table.read().count() == 20
    version = table.snapshot().version
    drop_and_run(0, 0)
    drop_and_run(5, 8)
    assert table.read().count() == 20 and table.snapshot().version > version
    with pytest.raises(SpecError):
        load_arrivals(spark, folder, T.StructType(), table, "full", name="q", checkpoint="x")


def test_a_stream_under_a_new_checkpoint_is_no_replay(spark, store, tmp_path):
    table, schema = store("id long"), T.StructType().add("id", T.LongType())
    for run, (low, high) in enumerate([(0, 10), (10, 60)]):
        folder = str(tmp_path / f"in{run}")
        spark.range(low, high).coalesce(1).write.parquet(folder)
        load_arrivals(spark, folder, schema, table, "append", name="q", checkpoint=str(tmp_path / f"cp{run}")).awaitTermination()
    assert table.read().count() == 60


# The database target. DuckDB's in-memory connection stands in for the database: it runs the same statements.

PG = Connection("pg", "postgres", options={"url": "jdbc:postgresql://db/x", "numPartitions": "4"})


@pytest.fixture
def db():
    con = duckdb.connect()
    con.execute("CREATE TABLE target (id BIGINT, v VARCHAR DEFAULT 'none', seen BIGINT)")
    columns = ", ".join(f"{k} VARCHAR" for k in hwm.KEY)
    con.execute(f"CREATE TABLE high_water_marks ({columns}, incr_point VARCHAR, sync_mode VARCHAR)")
    con.execute("INSERT INTO target VALUES (1, 'a', 1), (2, 'b', 2)")
    return Transactional(con)


class Transactional:
    """A connection that opens a transaction at the first statement, as Python database drivers do."""

    rowcount = -1

    def __init__(self, con):
        self.con, self.open, self.statements = con, False, []

    def cursor(self):
        return self

    def execute(self, sql, values=None):
        if not self.open:
            self.con.begin()
            self.open = True
        self.statements.append(sql)
        # DuckDB has no LIKE clause for tables.
        sql = sql.replace("(LIKE target INCLUDING DEFAULTS)", "AS SELECT * FROM target LIMIT 0")
        self.con.execute(sql, values or [])

    def fetchone(self):
        return self.con.fetchone()

    def commit(self):
        self.con.commit()
        self.open = False

    def rollback(self):
        if self.open:
            self.con.rollback()
        self.open = False

    def rows(self, table="target"):
        return sorted(self.con.execute(f"SELECT * FROM {table}").fetchall())


def fill(db, keep=None):
    def insert(df, connection, staging):
        assert connection is PG
        for row in df.collect()[:keep]:
            db.con.execute(f"INSERT INTO {staging} ({', '.join(df.columns)}) VALUES ({', '.join('?' * len(row))})", list(row))

    return insert


def database_table(spark, tmp_path, db, filler=None):
    schema = T.StructType().add("id", T.LongType()).add("v", T.StringType()).add("seen", T.LongType())
    return DatabaseTable(PG, db, "target", TableStore(spark, str(tmp_path / "work")), schema=schema, marker="?", fill=filler or fill(db))


def into_database(spark, tmp_path, db, mode, data, filler=None):
    rows = spark.createDataFrame(data, "ID long, v string, seen long")
    key, pk = {k: "k" for k in hwm.KEY}, ["id"] if mode == "merge" else []
    return database_table(spark, tmp_path, db, filler).load(rows, mode, pk=pk, incr="seen", key=key, facts={"sync_mode": mode})


def test_task_into_a_database(spark, tmp_path, db):
    table = database_table(spark, tmp_path, db)
    spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, 4)], "id long, seen long").createOrReplaceTempView("src")
    nightly = Task("n", (Source(table="src", connection="session", incr_field="seen", batch_size=1),), Target("target", "merge", "id", commit_batch_size=1))
    db.con.execute("ALTER TABLE high_water_marks ADD COLUMN src_incr_field VARCHAR")
    db.con.execute("ALTER TABLE high_water_marks ADD COLUMN dst_pk VARCHAR")
    assert run_task(spark, nightly, SESSION, table)[0].rows_written == 2  # the target had reached 2
    assert db.rows() == [(1, "a", 1), (2, "b", 2), (3, "none", 3), (4, "none", 4)]
    assert run_task(spark, nightly, SESSION, table)[0].rows_written == 0


def test_database_merge_and_mark(spark, tmp_path, db):
    assert into_database(spark, tmp_path, db, "merge", [(2, "B", 5), (3, "c", 4)]).point == "5"
    assert db.rows() == [(1, "a", 1), (2, "B", 5), (3, "c", 4)]
    into_database(spark, tmp_path, db, "append", [(4, "d", 3)])
    assert [r[-2:] for r in db.rows("high_water_marks")] == [("5", "append")]
    into_database(spark, tmp_path, db, "full", [(9, "z", 9)])
    assert db.rows() == [(9, "z", 9)]
    into_database(spark, tmp_path, db, "full", [])
    assert db.rows() == [(9, "z", 9)]
    assert [s.split()[0] for s in db.statements[:9]] == ["SELECT", "CREATE", "SELECT", "DELETE", "INSERT", "DELETE", "INSERT", "DROP", "SELECT"]


def test_database_load_is_all_or_nothing(spark, tmp_path, db):
    before = db.rows()
    with pytest.raises(RuntimeError, match="fill it again"):
        into_database(spark, tmp_path, db, "merge", [(1, "x", 9), (2, "y", 9)], fill(db, keep=1))
    assert db.rows() == before and db.rows("high_water_marks") == []
    db.con.execute("DROP TABLE high_water_marks")
    db.con.execute("CREATE TABLE high_water_marks AS SELECT 1 AS wrong")
    with pytest.raises(duckdb.Error):
        apply_staging(db, "target", "target", ["id"], "append", expected_rows=2, mark={k: "k" for k in hwm.KEY}, marker="?")
    assert db.rows() == before


def test_database_options():
    assert write_options(PG, "s", 5) == {"url": "jdbc:postgresql://db/x", "dbtable": "s", "batchsize": "5", "truncate": "true", "stringtype": "unspecified"}
    for kind in ("mssql", "catalog", "parquet"):
        with pytest.raises(SpecError):
            check_sink(Connection("x", kind))
