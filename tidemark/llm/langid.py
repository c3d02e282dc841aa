"""Language of a text by the nearest of several centroids per language, over normalised TF-IDF vectors of n-grams.

N-grams are pairs and triples of bytes of the lowered text, signs and digits read as spaces. Counts are dampened, weighted
by inverse document frequency over all documents to learn from, and brought to length one; the cosine with a centroid is
then a product. Each language has centroids of its own clusters: found on a bounded sample, then moved to the mean of all
documents of the language nearest to them. A text that is farther from its centroid than nearly every learned one is
marked as rejected, with its nearest language beside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import streams

BUCKETS = 1 << 12  # of hashed n-grams; halved while the model would pass its bound
CLUSTERS = 4  # of each language
SAMPLE_ROWS = 400  # documents of a language that its clusters are sought in, the bound of that sample
ROUNDS = 12  # of clustering
MODEL_BYTES = 64 << 20  # bound of the centroids, which are broadcast
LANGUAGES = 1 << 16  # more learned languages are an error
REJECT_SHARE = 0.001  # of learned documents lie farther than what is rejected
BINS = 1000  # of cosines
UNKNOWN = "und"

_SPACE = 0x20
_CELLS = 1 << 21  # of a matrix of vectors


def _folded() -> np.ndarray:
    """ASCII letters and bytes of other letters stay, everything else is a space."""
    out = np.arange(256, dtype=np.uint8)
    letter = np.zeros(256, bool)
    letter[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    out[~letter] = _SPACE
    return out


FOLD = _folded()


@dataclass(frozen=True)
class Model:
    """Learned languages, weights of the buckets, centroids with the number of their language, and rejection bounds."""

    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    least: np.ndarray


def counted(column: pa.Array, buckets: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows of the column in slices, with the counts of their hashed n-grams as a matrix."""
    raw, offsets = streams.texts_of(column)
    rows = len(offsets) - 1
    text = np.full(len(raw) + rows + 2, _SPACE, np.uint8)  # a space before each text, and behind the last
    of = np.repeat(np.arange(rows), np.diff(offsets))
    text[np.arange(len(raw)) + of + 1] = FOLD[raw]
    starts = offsets + np.arange(rows + 1)
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    step = max(1, _CELLS // buckets)
    for low in range(0, rows, step):
        high = min(rows, low + step)
        part = text[starts[low] : starts[high] + 2].astype(np.uint32)
        row = np.repeat(np.arange(high - low), np.diff(starts[low : high + 1]))
        a, b, c = part[:-2], part[1:-1], part[2:]
        pair, triple = a | b << np.uint32(8), a | b << np.uint32(8) | c << np.uint32(16) | np.uint32(1 << 24)
        spoken = b != _SPACE
        either = spoken | (a != _SPACE)
        keys = [
            row[own] * buckets + ((gram[own] * np.uint32(0x9E3779B1)) >> shift)
            for gram, own in ((pair, either), (triple, spoken))
        ]
        yield slice(low, high), np.bincount(np.concatenate(keys), minlength=(high - low) * buckets).reshape(-1, buckets)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Dampened counts by weight, each row of length one; a row without n-grams is zero."""
    out = np.zeros(counts.shape, np.float32)
    at = np.flatnonzero(counts)
    out.ravel()[at] = (1 + np.log(counts.ravel()[at].astype(np.float32))) * idf[at % counts.shape[1]]
    length = np.sqrt(np.einsum("ij,ij->i", out, out))
    return out / np.maximum(length, 1e-12)[:, None]


def clustered(points: np.ndarray, clusters: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length one by spherical k-means; starts are the mean's nearest point and then the farthest ones."""
    picked = [int(np.argmax(points @ points.mean(0)))]
    near = points @ points[picked[0]]
    while len(picked) < clusters and near.min() < 1 - 1e-6:
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, points @ points[picked[-1]])
    centres = points[picked]
    for _ in range(rounds):
        own = np.argmax(points @ centres.T, axis=1)
        moved = np.stack([points[own == k].sum(0) if (own == k).any() else centres[k] for k in range(len(centres))])
        moved /= np.maximum(np.linalg.norm(moved, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centres, atol=1e-6):
            break
        centres = moved
    return centres.astype(np.float32)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2. A null id is not."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    spoken = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    columns = [F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), spoken.alias("spoken")]
    return docs.select(*columns, F.when(spoken, F.lower(text)).alias("text"))


def fit(learned: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of the languages of these rows; rows without a language or a letter are passed over.

    Document frequencies, centroids and rejection bounds are over all rows. Only the search for clusters looks at a sample,
    at most ``sample_rows`` texts of each language, those with the smallest hashes. A text that is there several times is one
    text of the sample. The driver gets the counts of the buckets and the centroids, both of bounded size.
    """
    spark = learned.sparkSession
    rows = learned.select(F.col(lang).alias("lang"), F.lower(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    sizes = hashed.groupBy("lang").agg(F.count("*").alias("count"), F.approx_count_distinct("h").alias("texts"))
    sizes = sizes.orderBy("lang").limit(LANGUAGES + 1).collect()
    if len(sizes) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    languages = tuple(r["lang"] for r in sizes)
    if not languages:
        return Model((), np.zeros(buckets, np.float32), np.zeros((0, buckets), np.float32), np.zeros(0, np.int64), np.zeros(0))
    number = {name: i for i, name in enumerate(languages)}
    clusters = CLUSTERS
    while len(languages) * clusters * buckets * 4 > MODEL_BYTES:
        buckets, clusters = (buckets // 2, clusters) if buckets > 256 else (buckets, 1)
        if buckets <= 256 and clusters == 1:
            break

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in streams.pieces(batches, "text"):
            for _, counts in counted(part.column("text"), buckets):
                total += (counts > 0).sum(0)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = rows.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(buckets, np.int64)
    for r in found:
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + sum(r["count"] for r in sizes)) / (1 + df)).astype(np.float32) + np.float32(1e-3)

    # Hashes are spread evenly, so few but the smallest need to be ranked; a language of any size sends as many to its task.
    shares = [(r["lang"], min(4 * sample_rows * 2**64 // max(r["texts"], 1), 2**64 - 1) - 2**63) for r in sizes]
    low = spark.createDataFrame(shares, "lang string, low long")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    few = hashed.select("lang", "h").join(F.broadcast(low), "lang").where("h <= low").select("lang", "h")
    last = few.distinct().withColumn("nth", nth).where(f"nth <= {sample_rows}")
    last = last.groupBy("lang").agg(F.max("h").alias("last"))  # a row for each language
    sample = hashed.join(F.broadcast(last), "lang").where("h <= last").dropDuplicates(["lang", "h"]).select("lang", "text")
    shared_idf = spark.sparkContext.broadcast(idf)

    def seeds(part: pa.Table) -> pa.Table:
        kept = [vectors(c, shared_idf.value) for p in streams.pieces(part.to_batches(), "text") for _, c in counted(p.column("text"), buckets)]
        points = np.concatenate(kept)
        points = points[np.lexsort(points[:, :8].T)]
        centres = clustered(points, clusters)
        return pa.table({"lang": [part.column("lang")[0].as_py()] * len(centres), "centre": [c.tobytes() for c in centres]})

    got = sample.groupBy("lang").applyInArrow(seeds, "lang string, centre binary").collect()
    got = sorted((number[r["lang"]], bytes(r["centre"])) for r in got)
    owner = np.array([k for k, _ in got], np.int64)
    seeded = np.stack([np.frombuffer(c, np.float32) for _, c in got])
    first = spark.sparkContext.broadcast((number, owner, seeded))

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, owner, centres = first.value
        sums, seen = {}, np.zeros((len(number), BINS), np.int64)
        for part in streams.pieces(batches, "text"):
            names = part.column("lang").to_pylist()
            for at, counts in counted(part.column("text"), buckets):
                own = np.array([number[n] for n in names[at]])
                points = vectors(counts, shared_idf.value)
                cosines = np.where(owner[None, :] == own[:, None], points @ centres.T, -1)
                nearest = cosines.argmax(1)
                for k in np.unique(nearest):
                    sums[int(k)] = sums.get(int(k), 0) + points[nearest == k].sum(0, dtype=np.float64)
                np.add.at(seen, (own, np.clip(cosines.max(1) * BINS, 0, BINS - 1).astype(int)), 1)
        for k, total in sums.items():
            at = np.flatnonzero(total)
            yield made("sum", k, at, total[at])
        for k in np.flatnonzero(seen.sum(1)):
            at = np.flatnonzero(seen[k])
            yield made("seen", k, at, seen[k][at])

    def made(kind: str, k: int, at: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        n = len(at)
        columns = [pa.array([kind] * n), pa.array(np.full(n, k)), pa.array(at), pa.array(value.astype(np.float64))]
        return pa.RecordBatch.from_arrays(columns, ["kind", "k", "at", "value"])

    told = rows.mapInArrow(moved, "kind string, k long, at long, value double")
    told = told.groupBy("kind", "k", "at").agg(F.sum("value").alias("value")).toArrow()
    kind, k, at, value = (told.column(c).to_numpy() for c in ("kind", "k", "at", "value"))
    centres, seen = np.zeros(seeded.shape), np.zeros((len(languages), BINS))
    centres[k[kind == "sum"], at[kind == "sum"]] = value[kind == "sum"]
    seen[k[kind == "seen"], at[kind == "seen"]] = value[kind == "seen"]
    empty = ~centres.any(1)
    centres[empty] = seeded[empty]
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    share = np.cumsum(seen, 1) / np.maximum(seen.sum(1, keepdims=True), 1)
    least = (share >= REJECT_SHARE).argmax(1) / BINS
    return Model(languages, idf, centres.astype(np.float32), owner, least)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row its nearest language, the cosine with that centroid, and whether it is too far to trust.

    Null texts and texts without a letter are ``und`` with score 0, as is everything where no language was learned. Equal
    cosines are decided by the order of the languages' names. Null ids, repeated rows and empty tables go through; no other
    column is read.
    """
    rows = _rows(docs, doc_id, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for part in streams.pieces(batches, "text"):
            spoken = part.column("spoken").to_numpy(zero_copy_only=False)
            best, score = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
            if len(names) > 1:
                for at, counts in counted(part.column("text"), len(model.idf)):
                    cosines = vectors(counts, model.idf) @ model.centroids.T
                    nearest = cosines.argmax(1)
                    best[at], score[at] = model.owner[nearest], np.clip(cosines.max(1), 0, 1)
                best[~spoken], score[~spoken] = len(names) - 1, 0
            far = score < np.append(model.least, 2)[best]
            out = [part.column("doc_id"), part.column("held_out"), pa.array(names[best].tolist(), pa.string())]
            yield pa.RecordBatch.from_arrays([*out, pa.array(score), pa.array(far)], columns)

    columns = ["doc_id", "held_out", "lang_pred", "score", "rejected"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    return predict(docs, fit(docs.where(~held_out()).select("text", "lang")))
