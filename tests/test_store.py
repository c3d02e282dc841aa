import datetime as dt
import pathlib
import random
import shutil
import threading
import time

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import chunks, matching
from tidemark.operators.hwm import identity
from tidemark.plans.load import load_chunks, load_in_chunks
from tidemark.sinks.files import CommitConflict, Folder, scratch_root
from tidemark.spec import Source, SpecError, Target

SCHEMA = "id long, v string, at long"
SCHEMA_NAMES = ["id", "v", "at"]
KEY = identity("job", "db", Source(table="raw.t"), Target("ods.t", "merge", "id"))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_modes_through_the_store(spark, store):
    table = store(SCHEMA, {"v": "none"})
    assert table.load(frame(spark), "initial").version == 0
    assert table.load(frame(spark, (1, "a", 1), (2, "b", 2)), "initial").inserted == 2
    assert table.load(frame(spark, (2, "b", 3)), "append", incr="at", key=KEY).point == "3"
    done = table.load(frame(spark, (2, "c", 5), (2, "d", 5), (9, "e", 4)), "merge", pk=["ID"], incr="AT", key=KEY)
    assert (done.deleted, done.inserted, done.point) == (2, 3, "5")
    assert rows(table.read()) == [(1, "a", 1), (2, "c", 5), (2, "d", 5), (9, "e", 4)]
    assert table.snapshot().rows == 4
    assert table.load(frame(spark), "full").version == done.version
    assert table.load(spark.createDataFrame([(7,)], "ID int"), "full").deleted == 4
    assert rows(table.read()) == [(7, "none", None)]
    assert table.stored_point(KEY) == "5"


def test_marks(spark, store):
    table = store(SCHEMA)
    load = lambda *data: table.load(frame(spark, *data), "append", incr="at", key=KEY)
    load((1, "a", 9))
    load((1, "a", 10))
    assert table.stored_point(KEY) == "10"
    assert load((1, "a", 3)).point == "10"
    assert load((1, "a", None)).point == "10"
    assert table.stored_point(KEY) == "10"
    table.load(frame(spark, (1, "a", 99)), "initial", incr="at", key=KEY)
    assert table.stored_point(KEY) == "10"
    marks = table.marks()
    assert [r.incr_point for r in marks.collect()] == ["10"] and marks.first().src_table_name == "t"
    fresh = store(SCHEMA)
    fresh.load(frame(spark, (1, "a", None)), "append", incr="at", key=KEY)
    assert fresh.stored_point(KEY) is None


def test_null_keys_pile_up_and_composite_keys(spark, store):
    table = store(SCHEMA)
    data = [(None, "a", 1), (1, None, 1), (1, "a", 1)]
    for _ in range(2):
        table.load(frame(spark, *data), "merge", pk=["id", "v"])
    assert rows(table.read()) == sorted([data[0], data[0], data[1], data[1], data[2]], key=repr)


def files_of(table, directories=None):
    root = pathlib.Path(table.root.removeprefix("file:")) / "data"
    return {str(f): f.stat().st_mtime_ns for d in directories or [p.name for p in root.iterdir()] for f in (root / d).glob("*.parquet")}


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merge_rewrites_no_file(spark, store, limit):
    table = store(SCHEMA, broadcast_bytes=limit)
    base = spark.range(1000).select("id", F.lit("old").alias("v"), F.col("id").alias("at"))
    table.load(base.repartitionByRange(4, "id"), "initial")
    table.load(base.select((F.col("id") + 1000).alias("id"), "v", "at"), "initial")
    before, written = table.snapshot(), files_of(table)
    fix = spark.range(10, 20).select("id", F.lit("new").alias("v"), F.lit(5).cast("long").alias("at"))
    done = table.load(fix, "merge", pk=["id"])
    assert (done.deleted, done.inserted) == (10, 10)
    after = table.snapshot()
    assert after.parts[:2] == before.parts and len(after.parts) == 3 and [d.rows for d in after.deletions] == [10]
    assert written.items() <= files_of(table).items()
    keys = spark.read.parquet(f"{table.root}/data/{after.deletions[0].directory}")
    assert rows(keys) == [(i, 1) for i in range(10, 20)]
    assert after.rows == 2000 == table.read().count()
    assert table.read().where("v = 'new'").count() == 10
    assert table.read().select("id").distinct().count() == 2000
    # A key range that meets no row leaves nothing behind but its own rows.
    far = spark.createDataFrame([(5000, "x", 1)], SCHEMA)
    assert table.load(far, "merge", pk=["id"]).deleted == 0
    assert table.snapshot().deletions == after.deletions
    folded = table.compact(rows_below=0, fold_share=0)
    assert folded.deletions == () and folded.rows == 2001 == table.read().count()
    assert before.parts[1].directory in folded.directories() and before.parts[0].directory not in folded.directories()


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_any_order_of_loads_and_compactions(spark, store, limit):
    """Against a list of rows in Python: merges by one and by two keys, appends, full loads, null keys, repeated keys."""
    table, have, pick = store(SCHEMA, broadcast_bytes=limit), [], random.Random(limit)
    for step in range(14):
        data = [(pick.choice([None, *range(6)]), pick.choice([None, "a", "b"]), step) for _ in range(pick.randint(1, 5))]
        mode, pk = pick.choice([("append", []), ("merge", ["id"]), ("merge", ["id"]), ("merge", ["id", "v"]), ("merge", ["v"])])
        mode = "full" if step == 9 else mode
        taken = {tuple(r[SCHEMA_NAMES.index(k)] for k in pk) for r in data}
        gone = [r for r in have if (key := tuple(r[SCHEMA_NAMES.index(k)] for k in pk)) in taken and None not in key] if mode == "merge" else []
        done = table.load(frame(spark, *data), mode, pk=pk)
        assert (done.deleted, done.inserted) == (len(have) if mode == "full" else len(gone), len(data))
        have = [] if mode == "full" else [r for r in have if r not in gone]
        have += data
        if step in (4, 8, 12):
            table.compact(rows_below=3, fold_share=pick.choice([0, 0.4]))
        assert rows(table.read()) == sorted(have, key=repr) and table.snapshot().rows == len(have)
    table.compact(rows_below=0, fold_share=0)
    assert table.snapshot().deletions == () and rows(table.read()) == sorted(have, key=repr)


def test_chunked_merge_rewrites_no_file(spark, store):
    table = store(SCHEMA)
    table.load(spark.range(100).select("id", F.lit("old").alias("v"), F.col("id").alias("at")).repartition(5), "initial")
    written = files_of(table)
    # Keys come again in later chunks, whose rows then stand.
    again = spark.range(300).selectExpr("id % 60 AS id", "concat('new', id) AS v", "id AS at")
    seen = []
    load_chunks(table, again, "merge", ["99", "199"], incr="at", pk=["id"], after_chunk=lambda a: seen.append((a.version, a.deleted, set(files_of(table)))))
    after = table.snapshot()
    assert [v for v, _, _ in seen] == [2, 3, 4] and after.version == 4
    assert written.items() <= files_of(table).items()
    assert len(files_of(table)) - len(written) == len(files_of(table, after.directories() - {after.parts[0].directory}))
    want = {}
    for i in range(300):
        want.setdefault((i % 60, i // 100), []).append((i % 60, f"new{i}", i))
    last = {k: max(c for key, c in want if key == k) for k in range(60)}
    left = [r for (k, c), own in want.items() if c == last[k] for r in own] + [(i, "old", i) for i in range(60, 100)]
    assert rows(table.read()) == sorted(left, key=repr) and after.rows == len(left)


def test_commits_do_not_grow_with_files(spark, store):
    table = store(SCHEMA)
    table.load(frame(spark, *[(i, "x", i) for i in range(3)]).coalesce(1), "initial")
    size = len(table.snapshot().to_json())
    (one,) = files_of(table)
    table.load(frame(spark, (7, "y", 7)).coalesce(1), "initial")
    for i in range(10_000):
        shutil.copyfile(one, one.replace("part-00000", f"part-{i + 1:05d}"))
    done = table.load(frame(spark, (1, "z", 1), (7, "z", 1)), "merge", pk=["id"])
    assert done.deleted == 10_002 and table.read().count() == 20_004
    assert len(table.snapshot().to_json()) < size + 1000


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_merge_with_a_hot_key(spark, store, limit):
    table = store(SCHEMA, broadcast_bytes=limit)
    ids = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id"))
    base = spark.range(3000).select(ids.alias("id"), F.lit("old").alias("v"), F.col("id").alias("at"))
    table.load(base.repartition(3), "initial")
    fix = [(-1, "new", 1), (-1, "new", 1), (1, "new", 1), (None, "new", 1)]
    assert table.load(spark.createDataFrame(fix, SCHEMA), "merge", pk=["id"]).deleted == 1001
    assert table.read().where("v = 'old'").count() == 3000 - 1000 - 1
    assert table.read().where("id IS NULL").count() == 1001
    assert table.snapshot().rows == table.read().count()


def test_a_run_that_dies_before_the_commit_changes_nothing(spark, store, monkeypatch):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append", incr="at", key=KEY)
    before, content = table.snapshot(), rows(table.read())

    def die(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(table._commits, "publish", die)
    for mode in ("initial", "full", "append", "merge"):
        with pytest.raises(KeyboardInterrupt):
            table.load(frame(spark, (1, "b", 2)), mode, pk=["id"], incr="at", key=KEY)
    monkeypatch.undo()
    assert table.snapshot() == before and rows(table.read()) == content
    table.load(frame(spark, (1, "b", 2)), "merge", pk=["id"], incr="at", key=KEY)
    assert rows(table.read()) == [(1, "b", 2)] and table.stored_point(KEY) == "2"


def test_bad_rows_leave_the_table_alone(spark, store):
    table = store(SCHEMA)
    with pytest.raises(Exception, match="not a bigint"):
        table.load(spark.createDataFrame([("x",)], "id string"), "append")
    with pytest.raises(SpecError):
        table.load(spark.createDataFrame([("x",)], "unknown string"), "append")
    assert table.snapshot().version == 0


def test_a_slower_writer_gets_a_conflict(spark, store):
    table = store(SCHEMA)
    stale = table.snapshot()
    table.load(frame(spark, (1, "a", 1)), "initial")
    table.snapshot = lambda: stale
    with pytest.raises(CommitConflict):
        table.load(frame(spark, (2, "b", 1)), "initial")
    del table.snapshot
    assert rows(table.read()) == [(1, "a", 1)]


def test_one_of_two_publishers_wins(tmp_path):
    folder, outcomes = Folder(str(tmp_path / "c")), []

    def publish(text):
        try:
            folder.publish("1.json", text)
            outcomes.append(text)
        except CommitConflict:
            pass

    threads = [threading.Thread(target=publish, args=(str(i),)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(outcomes) == 1 and folder.read("1.json") == outcomes[0] and folder.names() == ["1.json"]


def test_chunks_that_were_committed_stay(spark, store):
    table = store(SCHEMA)
    source = spark.range(100).select("id", F.lit("x").alias("v"), F.col("id").alias("at"))

    def stop_after_second(applied):
        if applied.version == 2:
            raise RuntimeError("stop")

    with pytest.raises(RuntimeError, match="stop"):
        load_chunks(table, source, "append", ["24", "49", "74"], incr="at", key=KEY, after_chunk=stop_after_second)
    assert table.stored_point(KEY) == "49" and table.read().count() == 50
    rest = source.where(f"at > {table.stored_point(KEY)}")
    load_chunks(table, rest, "append", ["74"], incr="at", key=KEY)
    assert rows(table.read()) == rows(source) and table.stored_point(KEY) == "99"


def test_a_replayed_batch_changes_nothing(spark, store):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append", stream=("q", 0))
    table.load(frame(spark, (2, "b", 1)), "append", stream=("q", 1))
    table.load(frame(spark, (2, "b", 1)), "append", stream=("q", 1))
    table.load(frame(spark, (3, "c", 1)), "append", stream=("other", 0))
    assert table.read().count() == 3
    table.load(frame(spark), "append", stream=("q", 2))
    assert table.snapshot().streams == {"q": {"": 2}, "other": {"": 0}}
    table.load(frame(spark, (4, "d", 1)), "append", stream=("q", 0, "another checkpoint"))
    assert table.snapshot().streams["q"] == {"": 2, "another checkpoint": 0}


@pytest.mark.parametrize("mode", ["append", "merge"])
def test_a_replay_after_another_run_changes_nothing(spark, store, mode):
    """Run A commits batch 5 and dies before its checkpoint does, run B starts, then A replays batch 5."""
    table, pk = store(SCHEMA), ["id"] if mode == "merge" else []
    table.load(frame(spark, (1, "a", 1)), mode, pk=pk, stream=("q", 5, "A"))
    table.load(frame(spark, (2, "b", 1)), mode, pk=pk, stream=("q", 0, "B"))
    table.load(frame(spark, (2, "c", 1)), mode, pk=pk, stream=("q", 1, "B"))
    version, content = table.snapshot().version, rows(table.read())
    table.load(frame(spark, (1, "a", 1)), mode, pk=pk, stream=("q", 5, "A"))
    assert table.snapshot().version == version and rows(table.read()) == content
    table.load(frame(spark, (3, "d", 1)), mode, pk=pk, stream=("q", 6, "A"))
    assert table.snapshot().streams == {"q": {"A": 6, "B": 1}}


# Two writers


def overtaken(table, monkeypatch, between):
    """Loads of the table see its state before ``between`` at first."""
    stale, seen, real = table.snapshot(), [], table.snapshot
    between()

    def snapshot():
        seen.append(1)
        return stale if len(seen) == 1 else real()

    monkeypatch.setattr(table, "snapshot", snapshot)


def test_an_append_goes_on_from_the_commit_that_overtook_it(spark, store, monkeypatch):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append", incr="at", key=KEY)
    overtaken(table, monkeypatch, lambda: table.load(frame(spark, (2, "b", 50)), "append", incr="at", key=KEY))
    done = table.load(frame(spark, (3, "c", 7)), "append", incr="at", key=KEY)
    monkeypatch.undo()
    assert (done.version, done.inserted) == (3, 1) and rows(table.read()) == [(1, "a", 1), (2, "b", 50), (3, "c", 7)]
    assert table.stored_point(KEY) == "50" and table.snapshot().rows == 3


def test_an_append_after_a_merge_keeps_its_rows(spark, store, monkeypatch):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append")
    overtaken(table, monkeypatch, lambda: table.load(frame(spark, (1, "b", 2)), "merge", pk=["id"]))
    table.load(frame(spark, (1, "c", 3)), "append")
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "b", 2), (1, "c", 3)]


@pytest.mark.parametrize("mode", ["merge", "full"])
def test_an_overtaken_merge_or_full_load_is_a_conflict(spark, store, monkeypatch, mode):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append")
    overtaken(table, monkeypatch, lambda: table.load(frame(spark, (1, "b", 2)), "merge", pk=["id"]))
    with pytest.raises(CommitConflict):
        table.load(frame(spark, (1, "c", 3)), mode, pk=["id"])
    monkeypatch.undo()
    assert rows(table.read()) == [(1, "b", 2)]


def test_appends_at_the_same_time_are_all_kept(spark, store):
    table, errors = store(SCHEMA), []

    def run(i):
        try:
            table.load(frame(spark, (i, "x", i)), "append", incr="at", key=KEY)
        except Exception as e:  # reported below
            errors.append(e)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert errors == [] and rows(table.read()) == [(i, "x", i) for i in range(5)]
    assert table.snapshot().version == 5 and table.stored_point(KEY) == "4"


def test_storage_without_a_conditional_create_is_refused(tmp_path):
    def folder(**options):
        made = Folder(str(tmp_path / "c"), **options)
        made._fs = fs.SubTreeFileSystem("/", fs.LocalFileSystem())
        return made

    with pytest.raises(CommitConflict, match="single_writer"):
        folder().publish("1.json", "x")
    alone = folder(single_writer=True)
    alone.publish("1.json", "x")
    with pytest.raises(CommitConflict):
        alone.publish("1.json", "y")
    assert alone.read("1.json") == "x" and alone.names() == ["1.json"] == [p.name for p in (tmp_path / "c").iterdir()]


# What is left behind


def test_sweep_takes_what_no_commit_names(spark, store):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "a", 1)), "append")
    table.load(frame(spark, (1, "b", 2)), "merge", pk=["id"])
    table.stage(frame(spark, (9, "lost", 9)))
    assert table.sweep() == 0  # too young
    with table.lease():
        running = table.stage(frame(spark, (8, "running", 8)))
        assert table.sweep(older_than=0) == 1
        assert table.read_part(running.part, table.snapshot().schema).count() == 1
    assert table.sweep(older_than=0) == 1
    assert rows(table.read()) == [(1, "b", 2)] and table.sweep(older_than=0) == 0
    table._leases.publish("0000000000001-dead", "")
    table.stage(frame(spark, (9, "lost", 9)))
    assert table.sweep(older_than=0) == 1 and table._leases.names() == []


def test_loads_leave_nothing_that_no_commit_names(spark, store):
    table = store(SCHEMA)
    source = spark.range(100).select((F.col("id") % 40).alias("id"), F.lit("x").alias("v"), F.col("id").alias("at"))
    load_in_chunks(table, source, "merge", 30, incr="at", pk=["id"])
    table.load(frame(spark), "append")
    table.load(frame(spark, (5000, "far", 1)), "merge", pk=["id"])
    assert set(table._data.directories()) == table.snapshot().directories() and table._leases.names() == []


# Chunks


def test_a_chunked_load_reads_its_source_once(spark, store):
    table = store(SCHEMA)
    # Every reading of this source gives other values, so a second one would lose or double rows.
    source = spark.range(2000).select("id", F.lit("x").alias("v"), (F.rand() * 1000).cast("long").alias("at"))
    done = load_in_chunks(table, source, "append", 500, incr="at", key=KEY)
    assert len(done) == 4 and sum(d.inserted for d in done) == 2000
    assert rows(table.read().select("id")) == sorted(((i,) for i in range(2000)), key=repr)
    ends = [set(r.at for r in table.read_part(p, table.snapshot().schema).select("at").distinct().collect()) for p in table.snapshot().parts]
    assert all(max(a) < min(b) for a, b in zip(ends, ends[1:]))  # equal values share a chunk


@pytest.mark.parametrize("of", ["text", "ties", "many", "null"])
def test_chunks_of_awkward_fields(spark, store, monkeypatch, of):
    if of == "many":
        monkeypatch.setattr(chunks, "GRID", 20)  # too coarse for so many chunks
    kind = {"text": "string"}.get(of, "long")
    table = store(f"id long, at {kind}")
    value = {"text": "concat('k', lpad(id % 50, 3, '0'))", "ties": "CAST(7 AS LONG)", "many": "id", "null": "CAST(IF(id % 2 = 0, NULL, id) AS LONG)"}[of]
    source = spark.range(400).selectExpr("id", f"{value} AS at")
    done = load_in_chunks(table, source, "append", 80 if of == "many" else 100, incr="at")
    assert len(done) == {"text": 4, "ties": 1, "many": 5, "null": 4}[of]
    assert rows(table.read()) == rows(source)


def test_staging_shuffles_nothing_and_packs_small_files(spark, store):
    table = store("id long")
    few, many = (table.stage(spark.range(0, 4000, 1, n), gather=True) for n in (4, 400))
    assert len(files_of(table, [few.part.directory])) == 4  # rows stay in the task that read them
    assert len(files_of(table, [many.part.directory])) <= max(spark.sparkContext.defaultParallelism, 400 // 20)
    assert few.part.rows == many.part.rows == 4000
    assert {f.name for f in (pathlib.Path(table.root.removeprefix("file:")) / "data").iterdir()} == {few.part.directory, many.part.directory}
    for part in (few.part, many.part):
        assert rows(table.read_part(part, table.snapshot().schema)) == [(i,) for i in sorted(range(4000), key=lambda i: repr((i,)))]


def test_rows_whose_keys_were_surely_not_taken_are_not_shuffled(spark, store):
    table = store("k double, s string, v long")
    table.broadcast_bytes = 4096  # fewer than the keys need, and 32768 bits for their hashes
    key = lambda i: None if i % 1000 == 7 else -0.0 if i == 0 else float("nan") if i == 1 else float(i)
    made = lambda ids, v: spark.createDataFrame([(key(i), f"s{i % 3}", v) for i in ids], table.snapshot().schema)
    table.load(made(range(4000), 0), "initial")
    expected = {i: 0 for i in range(4000)}
    nulls = []
    for v, ids in ((1, range(0, 4000, 10)), (2, range(1, 4000, 9)), (3, [*range(0, 300), *range(4000, 4300)])):
        done = table.load(made(ids, v).replace(-0.0, 0.0), "merge", pk=["K", "s"])
        assert done.deleted == sum(key(i) is not None and i in expected for i in ids)
        nulls += [i for i in ids if key(i) is None]
        expected |= {i: v for i in ids if key(i) is not None}
    got = table.read()
    assert "__bits" in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 4300 - 5 + 4 + len(nulls)  # four rows with a null key match nothing, and those of merges are added
    values = {("nan" if r.k != r.k else r.k, r.s): r.v for r in got.where("k IS NOT NULL").collect()}
    assert values == {("nan" if i == 1 else float(i), f"s{i % 3}"): v for i, v in expected.items() if key(i) is not None}
    keys = made(range(0, 4000, 10), 0)
    seen = matching.marked(made(range(4000), 0), matching.key_filter(keys, ["k", "s"], 4096), ["k", "s"], 4096).groupBy("__may").count()
    may = {r["__may"]: r["count"] for r in seen.collect()}
    assert 400 <= may[True] < 500 and may[True] + may[False] == 4000
    before = list(map(repr, rows(got)))
    table.compact(fold_share=0)
    assert not table.snapshot().deletions and list(map(repr, rows(table.read()))) == before


def test_compaction_keeps_rows_and_marks(spark, store):
    table = store(SCHEMA)
    big = spark.range(100).select("id", F.lit("x").alias("v"), F.col("id").alias("at"))
    table.load(big, "initial")
    for i in range(3):
        table.load(frame(spark, (200 + i, "y", 200 + i)), "append", incr="at", key=KEY)
    before = rows(table.read())
    after = table.compact(rows_below=50)
    assert len(after.parts) == 2 and rows(table.read()) == before and table.stored_point(KEY) == "202"
    assert table.compact(rows_below=50) == after


def test_a_load_is_one_commit_however_many_parts_there_are(spark, store):
    table = store(SCHEMA)
    for i in range(5):
        table.load(frame(spark, (i, "y", i)), "append", incr="at", key=KEY)
    assert table.snapshot().version == 5 and len(table.snapshot().parts) == 5
    table.compact()
    assert len(table.snapshot().parts) == 1 and table.read().count() == 5


def test_expire_deletes_what_only_old_commits_name(spark, store, tmp_path):
    table = store(SCHEMA)
    for i in range(4):
        table.load(frame(spark, (i, "y", i)), "full")
    table.load(frame(spark, (9, "z", 9)), "append")
    staged = table.stage(frame(spark, (5, "staged", 5)))
    before = rows(table.read())
    assert table.expire(keep=2) == 3
    assert rows(table.read()) == before and table.expire(keep=2) == 0
    assert table.read_part(staged.part, table.snapshot().schema).count() == 1


def test_dedupe_takes_the_latest(spark, store):
    table = store(SCHEMA)
    table.load(frame(spark, (1, "old", 1), (1, "new", 2)), "merge", pk=["id"], incr="at", dedupe=True)
    assert rows(table.read()) == [(1, "new", 2)]


def test_marks_of_zoned_times_survive_a_zone_change(spark, store):
    table = store("id long, t timestamp")
    source = spark.sql("SELECT 1L AS id, timestamp'2024-01-01 00:00:00Z' AS t")
    table.load(source, "append", incr="t", key=KEY)
    assert table.stored_point(KEY).startswith("2024-01-01 00:00:00.000000")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        later = spark.sql("SELECT 2L AS id, timestamp'2023-12-31 23:00:00Z' AS t")
        point = table.load(later, "append", incr="t", key=KEY).point
    finally:
        spark.conf.unset("spark.sql.session.timeZone")
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    instant = spark.sql(f"SELECT unix_seconds(CAST('{point}' AS timestamp))").first()[0]
    assert instant == int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def test_scratch_root(spark):
    assert scratch_root(spark, "/tmp/x").rsplit("/", 1)[1].startswith("tidemark-")
