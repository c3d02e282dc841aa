"""Operators that learn or sample: held-out accuracy, planted cases, closed forms on small tables."""

import math
import tempfile
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm.conftest import prose
from tidemark.llm import components, neardup, perplexity, rules, scratch, streams

SMALL = "/root/testdata/sf0.01"


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = Counter(r.root for r in found)
    assert groups == {0: 41, 100: 30, 200: 3}


def edited(words, places):
    return " ".join(f"e{i}" if i in places else w for i, w in enumerate(words))


def test_near_copies_meet_and_others_do_not(spark, docs_of):
    base = prose(1, 400).split()
    texts = [" ".join(base), " ".join(base), edited(base, {50}), edited(base, {10, 390}), prose(2, 400), None, "", "a b", "a b", "a  b", "a c"]
    texts += [" ".join(base[:200] + prose(3, 200).split()), " ".join(base[200:] + base[:200])]
    ids = [10, 4, 5, 6, 7, 8, 9, 11, 12, 13, 14, 15, None]
    got = {r.doc_id: r.class_id for r in neardup.class_of(docs_of(texts, ids)).collect()}
    assert {i: got[i] for i in (10, 4, 5, 6)} == dict.fromkeys((10, 4, 5, 6), 4)
    assert got[7] == 7 and got[8] == got[9] == 8 and got[11] == got[12] == got[13] == 11 and got[14] == 14
    assert got[15] == 15 and got[None] is None  # half shared; blocks in another order
    assert neardup.class_of(docs_of([])).count() == 0


def test_one_row_stays_of_each_class(docs_of):
    texts = ["x y z", "x y z", "x y z", prose(1, 50), None]
    kept = neardup.one_of_each(docs_of(texts, [3, 3, 4, 5, 6])).collect()
    assert sorted(r.doc_id for r in kept) == [3, 5, 6] and kept[0].lang == "en"


def test_links_against_all_pairs(docs_of):
    texts, pick = [], np.random.default_rng(5)
    for group in range(12):
        base = prose(group, 150).split()
        for _ in range(6):
            texts.append(edited(base, set(pick.integers(0, 150, pick.integers(0, 6)).tolist())))
    got = {r.doc_id: r.class_id for r in neardup.class_of(docs_of(texts)).collect()}
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        words, seen = t.split(), Counter()
        own = set()
        for i in range(len(words) - 4):
            run = tuple(words[i : i + 5])
            own.add((run, seen[run]))
            seen[run] += 1
        sets.append(own)

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert got == {i: root(i) for i in range(len(texts))}


def test_alignment_heeds_order_and_repeats():
    import pyarrow as pa

    def own(text):
        return neardup.labels(streams.Words(pa.array([text])).hashes)

    base = prose(1, 100).split()
    assert neardup.aligned(own(" ".join(base)), own(" ".join(base))) == 1.0
    assert neardup.aligned(own(" ".join(base)), own(" ".join(base[50:] + base[:50]))) == 0.0
    assert len(set(own("a " * 50).tolist())) == 46
    assert neardup.aligned(own("a " * 100), own("a " * 90)) == pytest.approx(86 / 96)


def test_probabilities_sum_to_one_and_follow_the_formula(spark, docs_of):
    words = spark.createDataFrame([(b"abab", 3), (b"abc", 2), (b"b", 1), (b"cab", 1)], "word binary, n long")
    by_order = perplexity.counts(words)
    signs = ["a", "b", "c", perplexity.FINISH, "\x05"]
    contexts = ["\x02" * 4, "\x02\x02ab", "\x02aba", "zzzz"]
    wanted = spark.createDataFrame([(c + s,) for c in contexts for s in signs], "gram string")
    total = defaultdict(float)
    for r in perplexity.probabilities(by_order, wanted).collect():
        assert 0 < r.p < 1
        total[r.gram[:-1]] += r.p
    for c in contexts:  # all known signs and one that stands for every other
        assert total[c] == pytest.approx(1.0, abs=1e-9)


def test_perplexity_against_plain_sums_and_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    trained = labels.where("doc_id % 2 = 0")
    got = {r.doc_id: r for r in perplexity.classify(docs, trained).collect()}
    assert len(got) == docs.count()
    held = [r for r in labels.where("doc_id % 2 = 1").collect()]
    good = [got[r.doc_id].kept for r in held if r.quality == 1 and r.toxic == 0]
    poor = [got[r.doc_id].kept for r in held if r.quality == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.25


def test_perplexity_of_awkward_rows(spark, docs_of):
    labels = spark.createDataFrame([(0, 1, 0), (0, 1, 0), (1, 1, None), (2, 0, 0), (2, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    texts = [prose(1, 200), prose(2, 200), "§§ ¤¤ ##", None, "", prose(1, 200), "\x02\x03"]
    got = perplexity.classify(docs_of(texts, [0, 1, 2, 3, 4, None, None]), labels).collect()
    assert len(got) == 7
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    assert by_id[0][0].kept and by_id[1][0].kept and not by_id[2][0].kept and by_id[3][0].perplexity is None and not by_id[4][0].kept
    assert any(r.perplexity == pytest.approx(by_id[0][0].perplexity) for r in by_id[None])
    assert perplexity.classify(docs_of([]), labels).count() == 0
    assert perplexity.classify(docs_of(texts[:1]), labels.limit(0)).first().kept
    assert math.isinf(perplexity.classify(docs_of(texts[:1]), labels.limit(0)).first().threshold)


def test_rules_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = rules.fit(docs, labels.where("doc_id % 2 = 0"), sample_rows=500)
    got = {r.doc_id: r for r in rules.rate(docs, model).collect()}
    held = [r for r in labels.where("doc_id % 2 = 1").collect() if not got[r.doc_id].base_failed]
    good = [got[r.doc_id].p_good for r in held if r.quality == 1]
    poor = [got[r.doc_id].p_good for r in held if r.quality == 0]
    assert np.mean(np.array(good) >= rules.KEEP_FROM) > 0.97 and np.mean(np.array(poor) < rules.KEEP_FROM) > 0.7
    assert rules.fit(docs, labels.limit(0)).slope == 0.0


def test_the_pipeline_on_awkward_rows(spark, docs_of, monkeypatch):
    monkeypatch.setattr(corpus_pipeline.queries, "table", lambda spark, d, name: tables[name])
    item = prose(77, 40)
    tables = {
        "labels": spark.createDataFrame([], "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, item)], "item_id long, text string"),
    }
    clean = prose(1, 200)
    texts = [clean, clean, None, "", "short", f"{prose(2, 60)} {item}", f"{prose(3, 60)} token=abcdefghijkl {prose(4, 60)}", clean]
    docs = docs_of(texts, [1, 1, 2, 3, 4, 5, 6, None])
    expected = [{1, 5, 6, None}, {1, 5, 6}, {1, 6}, {1, 6}]
    for (_, stage), ids in zip(corpus_pipeline.STAGES, expected):
        docs = stage(spark, docs, "")
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        rows = docs.collect()
        assert {r.doc_id for r in rows} == ids
        docs = spark.createDataFrame(rows, docs.schema)
    assert docs.where("doc_id = 6").first().text == f"{prose(3, 60)} [SECRET] {prose(4, 60)}"
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in packed} == {1, 6} and len({r.sequence_id for r in packed}) == 1
    empty = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
        assert empty.count() == 0


def test_perplexity_looks_past_a_word(spark, docs_of):
    pick = np.random.default_rng(3)
    after = {i: (i * 7 + 3) % 61 for i in range(61)}

    def chain(start, n=60):
        out = [start]
        while len(out) < n:
            out.append(after[out[-1]] if pick.random() < 0.9 else int(pick.integers(61)))
        return [f"w{i}" for i in out]

    trusted = [chain(i % 61) for i in range(60)]
    whole = chain(5)
    texts = [" ".join(t) for t in [*trusted, whole, pick.permutation(whole), whole[30:] + whole[:30]]]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in perplexity.classify(docs_of(texts), labels).collect()}
    assert got[60].kept and not got[61].kept
    assert got[61].perplexity > 1.3 * got[60].perplexity


def test_a_task_of_the_classifier_stays_small(monkeypatch):
    many = 16 << 20
    words = np.random.default_rng(1).integers(0, 50_000, many // 6)
    texts = [" ".join(f"w{w}" for w in part) for part in np.array_split(words, 4000)]
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts)]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "text"])
    monkeypatch.setattr(streams, "_powers", {})
    tracemalloc.start()
    try:
        rows = sum(len(b.column("rows")[0].as_py()) for b in perplexity._entries(iter([batch]), 6, 0, 12))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows > 0 and peak < 120 << 20


def test_frequent_keys_and_unseen_pairs_are_not_shuffled(spark, docs_of):
    texts = [prose(i, 150) for i in range(40)]
    docs = docs_of(texts).select("doc_id", "text", F.xxhash64("text").alias("key"), (F.col("doc_id") < 30).alias("trusted"))
    counted = perplexity._counted(docs, 0, 1, 3).collect()
    pairs = pa.table({c: [r[c] for r in counted if r.v is not None and r.c > 1] for c in ("v", "w")}).append_column("value", pa.array([-0.5] * sum(r.v is not None and r.c > 1 for r in counted)))
    pairs = pairs.append_column("often", pa.array([r.c for r in counted if r.v is not None and r.c > 1]))
    heads = sorted({r.v for r in counted if r.v is not None})[::3]
    words = pa.table({"w": heads, "value": [-1.0] * len(heads), "n": [2] * len(heads), "often": [10] * len(heads)})
    known = perplexity.Known(words, pairs, {r.shard: bytes(r.bits) for r in counted if r.v is None}, 3)
    seen = [(r.v, r.w) for r in counted if r.v is not None]
    v, w = (np.array(x).view(np.uint64) for x in zip(*seen))
    assert known.may_have(v, perplexity._pair(v, w)).all()  # no pair of trusted documents is missed
    batch = docs.select("doc_id", "key", "text").toArrow().combine_chunks().to_batches()[0]

    def entries(known):
        rows = [r for b in perplexity._entries(iter([batch]), 1, 0, 1, known) for r in b.to_pylist()]
        sums = [(np.frombuffer(r["log"]), np.frombuffer(r["n"], np.int64)) for r in rows if r["log"]]
        return [np.frombuffer(r["keys"], np.uint64) for r in rows if r["keys"]][0], sums

    plain, none = entries(None)
    rest, sums = entries(known)
    assert not none and len(sums) == 1 and len(rest) < 0.7 * len(plain) and set(rest) <= set(plain)
    kept = set(known.keys[known.keys > 0])
    assert not kept & set(rest) and {int(k) for k in perplexity._pair(v, w)} & set(plain.tolist()) <= {int(k) for k in kept} | set(rest.tolist())
    row, tokens, _, pair = perplexity._pairs(batch, 1)
    value = {int(k): (x, n) for k, x, n in zip(known.keys, known.values, known.sizes) if k}
    for i in range(batch.num_rows):
        own = [value.get(int(k), (0.0, 0)) for k in (*tokens[row == i], *pair[row == i])]
        assert sums[0][0][i] == pytest.approx(sum(x for x, _ in own)) and sums[0][1][i] == sum(n for _, n in own)


def test_pairs_of_passes_are_all_pairs_once(spark, docs_of, monkeypatch):
    texts = [prose(i, 150) for i in range(24)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    whole = {r.doc_id: r.perplexity for r in perplexity.classify(docs_of(texts), labels).collect()}
    docs = docs_of(texts).select("text", F.xxhash64("text").alias("key"), F.lit(True).alias("trusted"))
    pairs = Counter({(r.v, r.w): r.c for r in perplexity.pair_counts(docs).collect()})
    passes = [Counter({(r.v, r.w): r.c for r in perplexity.pair_counts(docs, i, 4).collect()}) for i in range(4)]
    assert sum(passes, Counter()) == pairs and sum(map(len, passes)) == len(pairs) and max(map(len, passes)) < len(pairs) / 2
    shuffled, parts = [], scratch.parts
    monkeypatch.setattr(perplexity, "PASS_TOKENS", 1000)
    monkeypatch.setattr(scratch, "parts", lambda spark, frames, name: shuffled.append(name) or parts(spark, (shuffled.append(i) or f for i, f in enumerate(frames)), name))
    dealt = {r.doc_id: r.perplexity for r in perplexity.classify(docs_of(texts), labels).collect()}
    n = shuffled.index("sums") - 1
    assert n > 1 and shuffled == ["pairs", *range(n), "sums", *range(n)]
    assert dealt == pytest.approx(whole, rel=1e-12)


def test_pairs_and_what_is_left_sum_to_one(spark):
    words = {w: 2 * (i + 1) for i, w in enumerate("abcd")}
    counted = [("a", "b", 3), ("a", "c", 1), ("b", "a", 2), ("c", "a", 1), ("b", "b", 1)]
    pairs = spark.createDataFrame([(1000 + i, words[v], words[w], c) for i, (v, w, c) in enumerate(counted)], "pair long, v long, w long, c long")
    spelled = spark.createDataFrame([(h, [math.log(0.25)] * 2, 1) for h in words.values()], "hash long, logs array<double>, n int")
    got = {r.id: r.value for r in perplexity.values(pairs, spelled).collect()}
    extra = {(v, w): got[1000 + i] for i, (v, w, _) in enumerate(counted)}
    n_follow, kinds = Counter(w for _, w, _ in counted), len(counted)
    low = perplexity._discounts(Counter(n_follow.values()))
    cut = {w: low[min(n, 3) - 1] for w, n in n_follow.items()}
    p = {w: (n_follow[w] - cut.get(w, 0)) / kinds + sum(cut.values()) / kinds * 0.25 for w in words}
    assert sum(p.values()) == pytest.approx(1.0)
    for v in words:
        left = math.exp(got[words[v]]) / p[v]
        assert sum(left * p[w] * math.exp(extra.get((v, w), 0.0)) for w in words) == pytest.approx(1.0)


def test_pairs_at_the_threshold_align_after_a_header():
    import pyarrow as pa

    def own(words):
        return neardup.labels(streams.Words(pa.array([" ".join(words)])).hashes)

    for m in (1, 2, 3, 7, 50, 100, 333):
        body, header = [f"b{i}" for i in range(4 * m + 4)], [f"h{i}" for i in range(m)]
        assert neardup.aligned(own(header + body), own(body)) == pytest.approx(0.8), m


def test_short_pairs_never_miss(docs_of):
    texts = [" ".join(f"x{k}_{i}" for i in range(n)) for k in range(1500) for n in (8, 9)]
    got = {r.doc_id: r.class_id for r in neardup.class_of(docs_of(texts)).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}
    words = [f"y{i}" for i in range(79)]
    for n in range(5, 76):
        longer, shorter = (neardup.labels(streams.Words(neardup.pa.array([" ".join(words[:k])])).hashes) for k in (n + 4, -(-4 * n // 5) + 4))
        assert np.intersect1d(neardup.prefix(longer), neardup.prefix(shorter)).size


def test_scratch_tables_go_with_their_phase(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "folder", lambda spark: f"file://{tempfile.mkdtemp(dir=tmp_path)}")
    before = spark.conf.get(scratch.CLEANED)
    with scratch.phase(spark) as outer:
        with scratch.phase(spark) as keep:
            lost = scratch.written(spark.range(5), "lost")
            passed = keep(lost.groupBy("id").count(), "passed")
        assert {p.name for p in tmp_path.glob("*/*")} == {"passed"}
        kept = outer(passed.withColumnRenamed("count", "n"), "kept")
    assert {p.name for p in tmp_path.glob("*/*")} == {"kept"} and kept.count() == 5
    assert spark.conf.get(scratch.CLEANED) == before
