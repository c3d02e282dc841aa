"""Whole runs: loads published to a table, with marks, chunks, metrics and streams."""

from __future__ import annotations

from pyspark.sql import types as T

from suite.apply_queries import (
    BAD_BALANCE,
    BAD_NATION,
    CHUNKED_MERGE,
    LINE_COLUMNS,
    LINE_KEY,
    MIXED,
    MIXED_TARGET,
    NEW_HOT,
    NEW_LINES,
    NEW_ORDERS,
    OLD_HOT,
    OLD_LINES,
    OLD_ORDERS,
    YEAR_ENDS,
    merged_sql,
)
from suite.registry import new_folder, new_store, query, rows_of, tables
from tidemark.plans.load import load_chunks, load_in_chunks, load_with_rejects, run_log, run_task
from tidemark.sinks.store import TableStore
from tidemark.spec import Mapping, Source, Target, Task
from tidemark.streaming.arrivals import load_arrivals


@query("publish_merge", merged_sql(OLD_ORDERS, NEW_ORDERS, ["o_orderkey"]))
def publish_merge(spark, sf_dir):
    old = rows_of(spark, sf_dir, OLD_ORDERS)
    store = new_store(spark, old)
    store.load(old, "initial")
    store.load(rows_of(spark, sf_dir, NEW_ORDERS), "merge", pk=["o_orderkey"], incr="o_orderdate")
    return store.read()


@query("mode_chunked_append", f"{OLD_LINES} UNION ALL {NEW_LINES}")
def mode_chunked_append(spark, sf_dir):
    old, new = rows_of(spark, sf_dir, OLD_LINES), rows_of(spark, sf_dir, NEW_LINES)
    store = new_store(spark, old)
    store.load(old, "initial")
    load_in_chunks(store, new, "append", -(-new.count() // 3), incr="l_shipdate")
    return store.read()


@query("publish_chunked_merge", CHUNKED_MERGE)
def publish_chunked_merge(spark, sf_dir):
    old = rows_of(spark, sf_dir, OLD_LINES)
    store = new_store(spark, old)
    store.load(old, "initial")
    load_chunks(store, rows_of(spark, sf_dir, NEW_LINES), "merge", YEAR_ENDS, incr="l_shipdate", pk=LINE_KEY)
    return store.read()


@query("mode_full_multi", "SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def mode_full_multi(spark, sf_dir):
    customers = Source(table="customer", connection="given", mapping=Mapping.of({"c_custkey": "id", "c_name": "name"}))
    suppliers = Source(table="supplier", connection="given", mapping=Mapping.of({"s_suppkey": "id", "s_name": "name"}))
    nations = rows_of(spark, sf_dir, "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation")
    store = new_store(spark, nations)
    store.load(nations, "initial")
    run_task(spark, Task("parties", (customers, suppliers), Target("ods.parties", "full")), [tables(sf_dir)], store)
    return store.read()


@query("incremental_append", "SELECT event_id, ts AS event_time, user_id, value FROM events")
def incremental_append(spark, sf_dir):
    """A first run takes the events up to mid-month, a second one only what came after its mark."""
    mapping = Mapping.of({"event_id": "event_id", "ts": "event_time", "user_id": "user_id", "value": "value"})

    def task(where: str) -> Task:
        source = Source(table="events", connection="given", mapping=mapping, incr_field="ts", where=where)
        return Task("events", (source,), Target("ods.events", "append"))

    empty = rows_of(spark, sf_dir, "SELECT event_id, ts AS event_time, user_id, value FROM events WHERE 1 = 0")
    store = new_store(spark, empty)
    for where in ("ts < TIMESTAMP_NTZ '2024-01-16 00:00:00'", ""):
        run_task(spark, task(where), [tables(sf_dir)], store)
    return store.read()


@query(
    "run_metrics",
    f"""SELECT 'initial' AS mode, 'success' AS status, count(*) AS rows_read, 0 AS rows_deleted, count(*) AS rows_written
        FROM ({OLD_ORDERS}) o
        UNION ALL SELECT 'merge', 'success', (SELECT count(*) FROM ({NEW_ORDERS}) n),
          (SELECT count(*) FROM ({OLD_ORDERS}) t WHERE o_orderkey IN (SELECT o_orderkey FROM ({NEW_ORDERS}) n)),
          (SELECT count(*) FROM ({NEW_ORDERS}) n)
        UNION ALL SELECT 'full', 'success', count(*),
          (SELECT count(*) FROM ({merged_sql(OLD_ORDERS, NEW_ORDERS, ["o_orderkey"])}) m), count(*) FROM orders""",
)
def run_metrics(spark, sf_dir):
    def source(sql: str, incr: str = "") -> Source:
        return Source(sql=sql, connection="given", incr_field=incr, auto_incr=False)

    steps = [
        (source(OLD_ORDERS), Target("ods.orders", "initial")),
        (source(NEW_ORDERS, "o_orderdate"), Target("ods.orders", "merge", "o_orderkey")),
        (source("SELECT * FROM orders"), Target("ods.orders", "full")),
    ]
    store = new_store(spark, rows_of(spark, sf_dir, OLD_ORDERS))
    records = [r for s, t in steps for r in run_task(spark, Task("orders", (s,), t), [tables(sf_dir)], store)]
    return run_log(spark, records).select("mode", "status", "rows_read", "rows_deleted", "rows_written")


def stream(spark, folder, store, mode, checkpoint, **options):
    schema = spark.read.parquet(folder).schema
    query = load_arrivals(
        spark, folder, schema, store, mode, name="events", checkpoint=checkpoint, files_per_batch=1, incr="ts", **options
    )
    query.awaitTermination()


@query("stream_append", "SELECT * FROM events")
def stream_append(spark, sf_dir):
    events = rows_of(spark, sf_dir, "SELECT * FROM events")
    work, store = new_folder(spark), new_store(spark, events)
    events.repartition(4, "event_id").write.parquet(f"{work}/in")
    stream(spark, f"{work}/in", store, "append", f"{work}/checkpoint")
    return store.read()


@query("stream_new_checkpoint", "SELECT * FROM events")
def stream_new_checkpoint(spark, sf_dir):
    """One stream name, two checkpoints: batches of the second are not taken for replays of the first."""
    events = rows_of(spark, sf_dir, "SELECT * FROM events")
    work, store = new_folder(spark), new_store(spark, events)
    for part, rows in enumerate((events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1"))):
        rows.repartition(2, "event_id").write.parquet(f"{work}/in{part}")
        stream(spark, f"{work}/in{part}", store, "append", f"{work}/checkpoint{part}")
    return store.read()


@query(
    "stream_merge",
    """SELECT event_id, ts, user_id, event_type, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value, props
       FROM events""",
)
def stream_merge(spark, sf_dir):
    """Events arrive, then corrected purchases arrive: the correction replaces the event."""
    events = rows_of(spark, sf_dir, "SELECT * FROM events")
    fixes = rows_of(
        spark, sf_dir, "SELECT event_id, ts, user_id, event_type, value + 1 AS value, props FROM events WHERE event_type = 'purchase'"
    )
    work, store = new_folder(spark), new_store(spark, events)
    events.repartition(3, "event_id").write.parquet(f"{work}/in")
    stream(spark, f"{work}/in", store, "merge", f"{work}/checkpoint", pk=["event_id"])
    fixes.coalesce(1).write.mode("append").parquet(f"{work}/in")
    stream(spark, f"{work}/in", store, "merge", f"{work}/checkpoint", pk=["event_id"])
    return store.read()


@query(
    "publish_with_rejects",
    f"""SELECT 'rows' AS what, count(*) AS n FROM ({MIXED}) m WHERE NOT {BAD_NATION} AND NOT {BAD_BALANCE}
        UNION ALL SELECT 'rejects', (SELECT count(*) FROM ({MIXED}) a WHERE {BAD_NATION}) + (SELECT count(*) FROM ({MIXED}) b WHERE {BAD_BALANCE})
        UNION ALL SELECT 'read', count(*) FROM customer""",
)
def publish_with_rejects(spark, sf_dir):
    """Good rows are loaded and bad values kept beside them, from one reading of the source."""
    mixed = rows_of(spark, sf_dir, MIXED)
    store = TableStore(spark, new_folder(spark))
    store.create(MIXED_TARGET, {"note": "none"})
    refused = TableStore(spark, new_folder(spark))
    refused.create(T.StructType.fromDDL("field string, text string, reason string, row string"))
    done = load_with_rejects(store, mixed, "initial", refused, 0.6)
    counted = [("rows", store.read().count()), ("rejects", refused.read().count()), ("read", done.read)]
    return spark.createDataFrame(counted, "what string, n long")


HOT_MERGED = merged_sql(OLD_HOT, NEW_HOT, ["o_orderkey"])


@query("publish_merge_shuffled", HOT_MERGED)
def publish_merge_shuffled(spark, sf_dir):
    """A merge whose keys are too many to broadcast; one key owns a third of both sides."""
    old = rows_of(spark, sf_dir, OLD_HOT)
    store = TableStore(spark, new_folder(spark), broadcast_bytes=0)
    store.create(old.schema)
    store.load(old, "initial")
    store.load(rows_of(spark, sf_dir, NEW_HOT), "merge", pk=["o_orderkey"], incr="o_orderdate")
    return store.read()


@query("publish_compacted", f"{CHUNKED_MERGE} UNION ALL SELECT {LINE_COLUMNS} FROM ({OLD_LINES}) o")
def publish_compacted(spark, sf_dir):
    """Chunks are merged, other rows appended, and then all key tables folded into the rows."""
    old = rows_of(spark, sf_dir, OLD_LINES)
    store = new_store(spark, old)
    store.load(old, "initial")
    load_chunks(store, rows_of(spark, sf_dir, NEW_LINES), "merge", YEAR_ENDS, incr="l_shipdate", pk=LINE_KEY)
    store.load(old, "append")
    store.compact(fold_share=0)
    return store.read()


@query(
    "publish_counts",
    f"""SELECT 'merge' AS what, (SELECT count(*) FROM ({OLD_HOT}) t WHERE EXISTS (SELECT 1 FROM ({NEW_HOT}) s WHERE s.o_orderkey = t.o_orderkey)) AS deleted,
               (SELECT count(*) FROM ({NEW_HOT}) n) AS inserted, (SELECT count(*) FROM ({HOT_MERGED}) m) AS rows
        UNION ALL SELECT 'again', (SELECT count(*) FROM ({NEW_HOT}) a), (SELECT count(*) FROM ({NEW_HOT}) b), (SELECT count(*) FROM ({HOT_MERGED}) c)""",
)
def publish_counts(spark, sf_dir):
    """What merges report: a second merge of the same rows takes away what the first has brought."""
    old, new = rows_of(spark, sf_dir, OLD_HOT), rows_of(spark, sf_dir, NEW_HOT)
    store = new_store(spark, old)
    store.load(old, "initial")
    counted = []
    for what in ("merge", "again"):
        done = store.load(new, "merge", pk=["o_orderkey"])
        counted.append((what, done.deleted, done.inserted, store.snapshot().rows))
    return spark.createDataFrame(counted, "what string, deleted long, inserted long, rows long")


@query("stream_replayed", "SELECT * FROM events")
def stream_replayed(spark, sf_dir):
    """Batches of two runs of one stream, each delivered again after the other run has gone on."""
    events = rows_of(spark, sf_dir, "SELECT * FROM events")
    store = new_store(spark, events)
    halves = [events.where(f"event_id % 4 = {i}") for i in range(4)]
    for run, number, part in ((0, 0, 0), (1, 0, 1), (0, 0, 0), (0, 1, 2), (1, 0, 1), (1, 1, 3), (0, 1, 2), (1, 1, 3)):
        store.load(halves[part], "append", stream=("events", number, f"run {run}"))
    return store.read()
