"""Quality rules: counts of what makes a text poor, and a hashed n-gram logistic regression with calibrated output.

The model sees four families of hashed features: words, pairs of words, and runs of three and of four bytes. Each
family is a distribution over buckets, so long and short texts weigh alike. It is fitted on a bounded sample of
labelled rows, calibrated on a part of the sample held out, and applied in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import streams
from tidemark.llm.streams import U

BUCKET_BITS = 16
FAMILIES = 4
SCALE = 20.0  # of the features; with it, unit weights tell families apart
SAMPLE_ROWS = 1000  # the bound of the training sample
HELD_OUT = 5  # one row of so many calibrates

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 20, 30, 8
KEEP_FROM = 0.5  # probability of good quality

NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


@dataclass(frozen=True)
class Model:
    """Weights by family and bucket, intercept, and the two numbers of the calibration. None of it grows with the data."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float

    @staticmethod
    def keep_all() -> Model:
        return Model(np.zeros(FAMILIES << BUCKET_BITS, np.float32), 0.0, 0.0, 20.0)


def families(words: streams.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each family the bucket of every feature, and the bounds of the rows in it."""
    out = [(words.hashes, words.bounds)]
    starts, hashes = words.windows(2)
    out.append((hashes, np.searchsorted(starts, words.bounds)))
    raw = words.raw.astype(U)
    for size in (3, 4):
        n = max(len(raw) - size + 1, 0)
        run = np.zeros(n, U)
        for i in range(size):
            run |= raw[i : i + n] << U(8 * i)
        last = np.clip(words.offsets[1:] - size + 1, words.offsets[:-1], None)  # runs stay within their row
        inside = np.zeros(n + 1, np.int64)
        np.add.at(inside, np.minimum(words.offsets[:-1], n), 1)
        np.add.at(inside, np.minimum(last, n), -1)
        at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
        out.append((streams.mix(run[at] + U(size << 40)), np.searchsorted(at, words.offsets)))
    return [((h >> U(64 - BUCKET_BITS)).astype(np.int64) + (k << BUCKET_BITS), b) for k, (h, b) in enumerate(out)]


def scores(words: streams.Words, model: Model) -> np.ndarray:
    """The calibrated probability of good quality of each row."""
    total = np.full(len(words.counts), model.intercept)
    for buckets, bounds in families(words):
        sums = streams.per_row(model.weights[buckets].astype(np.float64), bounds)
        total += SCALE * sums / np.maximum(np.diff(bounds), 1)
    return 1 / (1 + np.exp(-np.clip(model.slope * total + model.shift, -50, 50)))


def _repeated(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which values occur more than once in their row."""
    keys = streams.mix(hashes + rows.astype(U) * U(streams.BYTE_BASE))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def base_counts(words: streams.Words) -> dict[str, np.ndarray]:
    """The counts of the base rules, for each row."""
    raw, rows = words.raw, len(words.counts)
    chars = words.inside & ((raw & 0xC0) != 0x80)
    out = {"n_words": words.counts.astype(np.int64), "word_chars": streams.per_row(chars, words.offsets)}
    out["n_symbols"] = streams.per_row(_SYMBOL[raw], words.offsets)

    text = pa.LargeStringArray.from_buffers(
        rows, pa.py_buffer(words.offsets.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())
    )
    lines = streams.Words(text, NEWLINE)
    spoken = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    hashes, line_rows = lines.hashes[spoken], lines.rows()[spoken]
    again = np.zeros(len(hashes), bool)
    twice = np.flatnonzero(_repeated(hashes, line_rows))
    order = twice[np.lexsort((twice, hashes[twice], line_rows[twice]))]
    same = (hashes[order][1:] == hashes[order][:-1]) & (line_rows[order][1:] == line_rows[order][:-1])
    again[order[1:][same]] = True
    out["n_dup_lines"] = np.bincount(line_rows[again], minlength=rows).astype(np.int64)

    starts, windows = words.windows(REPEAT_WINDOW)
    word_rows = words.rows()
    hit = starts[_repeated(windows, word_rows[starts])]
    covered = streams.cover(hit, hit + REPEAT_WINDOW, len(words.starts))
    out["n_repeat_words"] = streams.per_row(covered, words.bounds)
    return out


def rate(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Base counts, probability and verdict of every row, with the columns named in ``carry`` beside them.

    Null text has no words and fails the base rules; null ids, repeated rows and empty tables go through as they are.
    Columns that are not named are not read; a carried column must not have the name of a result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "_text"):
            words = streams.Words(part.column("_text"))
            counts = base_counts(words)
            failed = (counts["n_words"] < MIN_WORDS) | (
                100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
            )
            good = scores(words, model)
            results = [*counts.values(), failed, good, ~failed & (good >= KEEP_FROM)]
            kept = [part.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, results)], names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry, F.col(text).alias("_text"))
    results = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    schema += f", {results}, base_failed boolean, p_good double, kept boolean"
    names = [f.split(" ")[0].strip("`") for f in schema.split(", ")]
    return rows.mapInArrow(work, schema)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, rounds: int = 60) -> Model:
    """A model from at most ``sample_rows`` labelled rows, those with the smallest hashes of their ids.

    Conflicting labels of an id count as poor; labels other than 0 and 1 are left out. Features are hashed where the
    texts are; the driver gets sparse vectors of the sample alone. Without both kinds of label the model keeps all.
    """
    picked = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            found = families(words)
            for row in range(part.num_rows):
                at, value = [], []
                for buckets, bounds in found:
                    own, n = np.unique(buckets[bounds[row] : bounds[row + 1]], return_counts=True)
                    at.append(own)
                    value.append(SCALE * n / max(n.sum(), 1))
                at, value = np.concatenate(at).astype(np.int32), np.concatenate(value).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(row, 1), part.column("quality").slice(row, 1), pa.array([at.tobytes()]), pa.array([value.tobytes()])],
                    ["doc_id", "quality", "at", "value"],
                )

    kind = sample.schema["doc_id"].dataType.simpleString()
    got = sample.mapInArrow(vectors, f"doc_id {kind}, quality int, at binary, value binary").toPandas().sort_values("doc_id")
    good = got["quality"].to_numpy(np.float64)
    if not 0 < good.sum() < len(good):
        return Model.keep_all()
    at = [np.frombuffer(b, np.int32) for b in got["at"]]
    value = [np.frombuffer(b, np.float32) for b in got["value"]]
    held = np.arange(len(good)) % HELD_OUT == 0
    weights, intercept = _regress([a for a, h in zip(at, held) if not h], [v for v, h in zip(value, held) if not h], good[~held], rounds)
    raw = np.array([intercept + float(weights[a] @ v) for a, v in zip(at, value)])
    slope, shift = _calibrate(raw[held], good[held])
    return Model(weights.astype(np.float32), intercept, slope, shift)


def _regress(at: list[np.ndarray], value: list[np.ndarray], good: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a small ridge, both labels weighing alike, by Adam on all rows."""
    sizes = np.array([len(a) for a in at])
    row = np.repeat(np.arange(len(at)), sizes)
    at, value = np.concatenate(at), np.concatenate(value).astype(np.float64)
    n = FAMILIES << BUCKET_BITS
    share = np.where(good > 0, 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1))
    w, m, v = np.zeros(n), np.zeros(n), np.zeros(n)
    b = bm = bv = 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(row, value * w[at], len(good)) + b
        error = share * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - good)
        g = np.bincount(at, value * error[row], n) + 1e-5 * w
        gb = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        bm, bv = 0.9 * bm + 0.1 * gb, 0.99 * bv + 0.01 * gb * gb
        rate = 0.1 * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
        w -= rate * m / (np.sqrt(v) + 1e-6)
        b -= rate * bm / (np.sqrt(bv) + 1e-6)
    return w, float(b)


def _calibrate(raw: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn scores into probabilities, by guarded Newton steps; targets are drawn in a little."""
    n1, n0 = good.sum(), (1 - good).sum()
    target = np.where(good > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    spread = max(float(raw.std()), 1e-9)
    x = np.stack([raw / spread, np.ones_like(raw)])

    def loss(k: np.ndarray) -> float:
        z = k @ x
        return float((np.logaddexp(0, z) - target * z).sum() + 1e-3 * (k @ k))

    k = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(k @ x, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 2e-3 * np.eye(2), x @ (p - target) + 2e-3 * k)
        size, now = 1.0, loss(k)
        while size > 1e-6 and loss(k - size * step) > now:
            size /= 2
        k = k - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(k[0] / spread), float(k[1])
