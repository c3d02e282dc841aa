"""Language identification against plain vectors, on awkward rows, and by its accuracy on held out documents."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import langid, queries

EN = "The weather was fine and we walked along the river until the evening came."
DE = "Das Wetter war schön und wir gingen am Fluss entlang, bis der Abend kam."
FR = "Le temps était beau et nous avons marché le long de la rivière jusqu'au soir."
SCHEMA = "doc_id long, text string, lang string, score double, spoken string, h string, bucket string"


def plain_counts(text, buckets):
    raw = " ".join(["", "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text), " "]).encode()
    out = Counter()
    for i in range(len(text.encode()) + 1):
        a, b, c = raw[i : i + 3]
        grams = ([a | b << 8] if not a == b == 0x20 else []) + ([a | b << 8 | c << 16 | 1 << 24] if b != 0x20 else [])
        for gram in grams:
            out[((gram * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - int(math.log2(buckets)))] += 1
    return out


def test_counts_are_those_of_the_rows_alone():
    texts = [EN.lower(), "", "a", "a1b", "été!", "  two  ", DE.lower() * 20]
    found = {}
    for at, counts in langid.counted(pa.array(texts), 512):
        for i, row in zip(range(at.start, at.stop), counts):
            found[i] = {int(k): int(row[k]) for k in np.flatnonzero(row)}
    assert found == {i: dict(plain_counts(t, 512)) for i, t in enumerate(texts)}


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "a", "b", "c") for r in rows], SCHEMA)


def learned(n=40):
    return [(i, " ".join([text] * (1 + i % 3)) + f" {i}", lang) for i, (text, lang) in enumerate([(EN, "en"), (DE, "de"), (FR, "fr")] * n)]


def test_prediction_is_the_nearest_centroid(spark):
    model = langid.fit(frame(spark, learned()))
    assert model.languages == ("de", "en", "fr") and set(model.owner.tolist()) == {0, 1, 2}
    assert np.allclose(np.linalg.norm(model.centroids, axis=1), 1, atol=1e-5)
    texts = [EN, DE, FR, "the river", "der Fluss", "la rivière", "the Fluss", "zzzz qqqq", None, "", "123 !?", "é", "a" * 100_000]
    got = {r.doc_id: r for r in langid.predict(frame(spark, [(i, t, None) for i, t in enumerate(texts)]), model).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0) and r.rejected
            continue
        counts = plain_counts(text.lower(), len(model.idf))
        vector = np.zeros(len(model.idf))
        for k, n in counts.items():
            vector[k] = (1 + math.log(n)) * model.idf[k]
        cosines = model.centroids @ (vector / max(np.linalg.norm(vector), 1e-12))
        assert r.score == pytest.approx(max(cosines.max(), 0), abs=1e-4)
        assert r.lang_pred == model.languages[model.owner[cosines.argmax()]]
    assert [got[i].lang_pred for i in range(6)] == ["en", "de", "fr", "en", "de", "fr"]
    assert not got[0].rejected and got[7].rejected


def test_document_frequencies_are_over_all_rows(spark):
    rows = learned(50)
    model = langid.fit(frame(spark, rows), sample_rows=2)
    df = Counter(k for _, t, _ in rows for k in plain_counts(t.lower(), len(model.idf)))
    want = [math.log((1 + len(rows)) / (1 + df[k])) + 1e-3 for k in range(len(model.idf))]
    assert np.allclose(model.idf, want, atol=1e-5)


def test_awkward_tables(spark):
    none = langid.identify(frame(spark, [])).collect()
    assert none == []
    unlabelled = langid.identify(frame(spark, [(1, EN, None), (None, DE, None), (1, EN, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)] * 3
    rows = [*learned(5), (None, EN, "en"), (None, EN, "en"), (7, "1 2 3", "xx"), (8, None, "yy"), (9, "", "zz"), (2, "lone", "")]
    out = langid.identify(frame(spark, rows)).collect()
    assert len(out) == len(rows) and {r.lang_pred for r in out} <= {"en", "de", "fr", "", "und"}
    assert [r.lang_pred for r in out if r.doc_id is None] == ["en", "en"]


def test_many_languages_make_a_smaller_model(spark, monkeypatch):
    monkeypatch.setattr(langid, "MODEL_BYTES", 3 * 4 * 4 * 1024)
    model = langid.fit(frame(spark, learned(10)))
    assert model.centroids.shape[1] == 1024
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        langid.fit(frame(spark, learned(2)))


def test_held_out_documents_are_not_learned_from_and_are_known(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = queries.QUERIES["op13_language_id"](spark, "/root/testdata/sf0.01")
    assert out.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = out.collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) > 0.98 * len(held)
    poisoned = [(i, EN, "xx") for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert "xx" not in {r.lang_pred for r in langid.identify(frame(spark, learned(5) + poisoned)).collect()}
