"""The write modes against brute force in plain Python, on small random tables with copies, NULLs and hot keys."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark.operators import modes
from tidemark.operators.align import align, align_marked, good_rows, rejected
from tidemark.operators.chunks import chunk_bounds, chunk_index, chunks
from tidemark.operators.matching import hot_keys, hot_on_either, key_hash, match, plan_match, usable_keys
from tidemark.plans.load import load_with_rejects
from tidemark.spec import SpecError

SCHEMA = "k long, j string, v double, at long"


def table(spark, seed, n, hot=0.4, nulls=0.2):
    rng = random.Random(seed)

    def key():
        draw = rng.random()
        return 7 if draw < hot else None if draw < hot + nulls else rng.randrange(40)

    data = [(key(), rng.choice("abc"), float(rng.randrange(100)), rng.randrange(30)) for _ in range(n)]
    return data, spark.createDataFrame(data, SCHEMA).repartition(5)


def brute_merge(target, source, width):
    keys = {r[:width] for r in source if None not in r[:width]}
    return [r for r in target if r[:width] not in keys] + source


@pytest.mark.parametrize("pk", [["k"], ["k", "j"]])
@pytest.mark.parametrize("how", ["broadcast", "apart", "plain"])
def test_merge(spark, pk, how):
    target, t = table(spark, 1, 300)
    source, s = table(spark, 2, 120, hot=0.1)
    options = {"broadcast": {"small": True}, "apart": {"hot": hot_keys(t, pk)}, "plain": {}}[how]
    if how == "apart":
        assert options["hot"]
    assert rows(modes.merge(t, s, pk, **options)) == sorted(brute_merge(target, source, len(pk)), key=repr)
    counts = modes.merge_counts(t, s, pk).first()
    kept = len(brute_merge(target, source, len(pk))) - len(source)
    assert (counts.deleted, counts.inserted) == (len(target) - kept, len(source))


def test_merge_twice_is_merge_once_without_null_keys(spark):
    _, t = table(spark, 3, 200)
    _, s = table(spark, 4, 80, nulls=0)
    once = modes.merge(t, s, ["k"])
    assert rows(modes.merge(once, s, ["k"])) == rows(once)


def test_initial_append_full(spark):
    target, t = table(spark, 5, 50)
    source, s = table(spark, 6, 20)
    assert rows(modes.initial(t, s)) == rows(modes.append(t, s)) == sorted(target + source, key=repr)
    assert rows(modes.full(t, s)) == sorted(source, key=repr)
    assert rows(modes.full(t, s.where("v < 0"))) == sorted(target, key=repr)


@pytest.mark.parametrize("pk", [["k"], ["k", "j"]])
def test_chunked_merge_is_the_loop(spark, pk):
    target, t = table(spark, 7, 200)
    source, s = table(spark, 8, 150)
    bounds = ["5", "9", "20"]
    looped = target
    edges = [-1, 5, 9, 20, 99]
    for low, high in zip(edges, edges[1:]):
        looped = brute_merge(looped, [r for r in source if low < r[3] <= high], len(pk))
    got = modes.chunked_merge(t, s, pk, "at", bounds, hot=hot_keys(s, pk))
    assert rows(got) == sorted(looped, key=repr)


def test_latest_per_key(spark):
    source, s = table(spark, 9, 100)
    got = rows(modes.latest_per_key(s, ["k"], "at"))
    nulls = [r for r in source if r[0] is None]
    best = {}
    for r in source:
        if r[0] is not None:
            best[r[0]] = max(best.get(r[0], (-1,)), (r[3], r[0], r[1], r[2]))
    assert sorted(r for r in got if r[0] is not None) == sorted((k, j, v, at) for at, k, j, v in best.values())
    assert len(got) == len(best) + len(nulls)


def test_hot_keys_finds_every_heavy_key(spark):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    found = hot_keys(df, ["k"])
    assert found == [df.where("k = -1").select(key_hash(df, ["k"])).first()[0]]
    assert hot_keys(spark.range(10_000), ["id"]) == []
    assert hot_keys(df.where("k IS NULL"), ["k"]) == []


def test_zero_has_one_hash(spark):
    df = spark.createDataFrame([(0.0 if i % 2 else -0.0, i) for i in range(100)], "k double, i int")
    keys = spark.createDataFrame([(-0.0,)], "k double")
    found = hot_keys(df, ["k"])
    assert len(found) == 1
    assert match(df, keys, ["k"], "left_anti", hot=found).count() == 0
    assert match(df, keys, ["k"], "left_semi", hot=found).count() == 100


def test_plan_match_measures_the_keys(spark):
    _, t = table(spark, 1, 100)
    assert plan_match(t, t, ["k", "j"]) == {"small": True}
    assert "hot" in plan_match(t, t, ["k", "j"], limit=10)
    assert plan_match(t, t.where("k < 0"), ["k"]) == {"small": True}


@pytest.mark.parametrize("hot_key", ["7", "NULL"])
def test_copies_of_a_hot_or_null_key_never_meet_in_one_task(spark, hot_key):
    df = spark.range(0, 2_000, 1, 8).selectExpr(f"IF(id % 2 = 0, {hot_key}, id) AS k", "'copy' AS v")
    keys = usable_keys(spark.range(8, 3000, 2).selectExpr("id AS k"), ["k"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = match(df, keys, ["k"], "left_anti", hot=hot_keys(df, ["k"]))
        sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 2_000
    assert max(sizes) < 400


# Chunks


def test_bounds_never_split_ties_and_chunks_cover_everything(spark):
    _, s = table(spark, 10, 200)
    s = s.withColumn("at", F.when(F.col("at") > 3, F.col("at")))
    bounds = chunk_bounds(s, "at", 200, 40)
    assert 1 <= len(bounds) <= 4 and [int(b) for b in bounds] == sorted({int(b) for b in bounds})
    parts = list(chunks(s, "at", bounds))
    assert sum(p.count() for p in parts) == 200
    numbered = s.withColumn("c", chunk_index(F.col("at"), bounds, T.LongType()))
    assert [numbered.where(f"c = {i}").count() for i in range(len(parts))] == [p.count() for p in parts]
    assert numbered.groupBy("at").agg(F.countDistinct("c").alias("n")).agg(F.max("n")).first()[0] == 1
    assert numbered.where("at IS NULL").select("c").distinct().collect()[0].c == len(bounds)


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date", "decimal(9,2)", "double"])
def test_bounds_of_any_ordered_type(spark, kind):
    base = spark.range(100).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"), "id")
    column = F.col("id") if kind in ("decimal(9,2)", "double") else F.col("d")
    df = base.select(column.cast(kind).alias("x"))
    bounds = chunk_bounds(df, "x", 100, 30)
    sizes = [c.count() for c in chunks(df, "x", bounds)]
    assert sum(sizes) == 100 and 2 <= len(sizes) <= 4 and min(sizes) > 5


def test_one_chunk(spark):
    _, s = table(spark, 11, 10)
    assert chunk_bounds(s, "at", 10, 10) == []
    assert [c.count() for c in chunks(s, "at", [])] == [10]
    same = s.withColumn("at", F.lit(5).cast("long"))
    assert chunk_bounds(same, "at", 10, 2) == []


# Alignment

TARGET = (
    T.StructType()
    .add("id", T.LongType())
    .add("name", T.StringType())
    .add("price", T.DecimalType(9, 2))
    .add("note", T.StringType())
    .add("flag", T.BooleanType())
)


def test_align(spark):
    df = spark.createDataFrame([("5", 1.5, "x")], "ID string, Price double, NAME string")
    got = align(df, TARGET, {"Note": "-", "flag": True})
    assert got.columns == TARGET.names and got.schema.simpleString() == TARGET.simpleString()
    assert [str(x) for x in got.first()] == ["5", "x", "1.50", "-", "True"]
    assert align(df, TARGET).first().note is None


@pytest.mark.parametrize("columns", ["id long, other string", "id long, ID string"])
def test_align_rejects_columns(spark, columns):
    with pytest.raises(SpecError):
        align(spark.createDataFrame([], columns), TARGET)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(("value", "kind"), [("abc", "string"), ("", "string"), (1.5, "double"), (1e30, "double")])
def test_align_rejects_values_in_any_session(spark, ansi, value, kind):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a bigint"):
            align(spark.createDataFrame([(value,)], f"id {kind}"), TARGET).collect()
        assert align(spark.createDataFrame([(None,)], f"id {kind}"), TARGET).first().id is None
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_align_text_forms_and_zones(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' AS a, timestamp_ntz'2024-01-01 00:00:00' AS b, array(1, 2) AS c")
    target = T.StructType.fromDDL("a string, b timestamp, c string")
    row = align(df, target, zone="America/Mexico_City").select("a", F.unix_micros("b").alias("b"), "c").first()
    assert tuple(row) == ("2024-01-01 00:00:00.000000", 1704088800000000, "{1,2}")


def test_text_with_its_own_offset_keeps_its_instant(spark):
    target = T.StructType().add("t", T.TimestampType())
    texts = ["2024-01-01 00:00:00", "2024-01-01 06:00:00Z", "2024-01-01 07:00:00.5+01:00", "2024-01-01"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    seconds = [r[0] for r in align(df, target, zone="America/Mexico_City").select(F.unix_seconds("t")).collect()]
    assert seconds == [1704088800] * 4


@pytest.mark.parametrize("small", [True, False])
def test_counts_with_a_key_that_owns_a_third_of_the_target_alone(spark, small):
    target = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id + 100) AS k", "'x' AS j", "0.5 AS v", "id AS at")
    source = spark.createDataFrame([(7, "x", 0.5, 1), (101, "x", 0.5, 1), (None, "x", 0.5, 1), (7, "y", 0.5, 2)], SCHEMA)
    got = modes.merge_counts(target, source, ["k"], small=small).first()
    assert (got.deleted, got.inserted) == (1001, 4)


def test_chunked_merge_with_a_key_that_is_hot_in_the_target_alone(spark):
    target = spark.range(900).selectExpr("IF(id % 3 = 0, 7, id + 100) AS k", "'x' AS j", "CAST(0 AS DOUBLE) AS v", "id AS at")
    source = spark.createDataFrame([(7, "n", 1.0, 1), (7, "n", 2.0, 9), (101, "n", 1.0, 5), (None, "n", 1.0, 2)], SCHEMA)
    hot = hot_on_either(target, source, ["k"])
    assert set(hot) >= {r.h for r in spark.range(1).selectExpr("xxhash64(CAST(7 AS LONG)) AS h").collect()}
    got = rows(modes.chunked_merge(target, source, ["k"], "at", ["4"], hot=hot))
    old = [tuple(r) for r in target.collect() if r.k not in (7, 101)]
    assert got == sorted(old + [(7, "n", 2.0, 9), (101, "n", 1.0, 5), (None, "n", 1.0, 2)], key=repr)


def test_bad_values_become_rows(spark):
    df = spark.createDataFrame([("5", 1.5, "x"), ("q", 1e30, "y"), ("", None, None), (None, 2.0, "z")], "ID string, Price double, NAME string")
    marked = align_marked(df, TARGET, {"flag": True})
    assert good_rows(marked).schema.simpleString() == TARGET.simpleString()
    assert [(r.id, str(r.price), r.name) for r in good_rows(marked).collect()] == [(5, "1.50", "x"), (None, "2.00", "z")]
    found = {(r.field, r.text, r.reason) for r in rejected(marked).collect()}
    assert found == {("id", "q", "not a bigint"), ("price", "1.0E30", "not a decimal(9,2)"), ("id", "", "not a bigint")}
    assert json.loads(rejected(marked).where("text = 'q'").first().row) == {"ID": "q", "Price": 1e30, "NAME": "y"}
    same = align_marked(good_rows(marked), TARGET)
    assert good_rows(same).count() == 2 and rejected(same).count() == 0


def test_rejects_are_bounded_by_a_share(spark, store):
    kept, refused = store("id long"), store("field string, text string, reason string, row string")
    source = spark.createDataFrame([("1",), ("x",), ("3",), ("4",)], "id string")
    with pytest.raises(SpecError, match="1 of 4 rows"):
        load_with_rejects(kept, source, "append", refused, 0.2)
    assert kept.snapshot().version == refused.snapshot().version == 0 and kept._data.directories() == []
    done = load_with_rejects(kept, source, "append", refused, 0.25)
    assert (done.inserted, done.read) == (3, 4) and [r.text for r in refused.read().collect()] == ["x"]
    assert rows(kept.read()) == [(1,), (3,), (4,)]
