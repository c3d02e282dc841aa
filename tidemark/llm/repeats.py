"""Substring dedup: long word sequences that stand in an earlier document too.

Seed: every window of ``length`` words holds exactly one anchor, the smallest of the hashes of its k-word runs
(winnowing), so two documents that share a window share its anchor. Consecutive windows with one anchor form a run; the
run is extended from the anchor to both sides as far as the anchor stays the smallest, and hashed as a whole.
Extend: runs that agree as a whole share all their windows with the earliest document that has the run. Only the
earliest holders of runs that differ around a common anchor, that is runs at the rims of repeats, are compared window
by window. Overlapping windows found so are joined into maximal repeats. Groups are only ever reduced to their smallest
document, with partial aggregation, so a passage in a third of all documents costs a row for each of its places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams
from tidemark.llm.streams import U

LENGTH = 50
ANCHOR_WORDS = 8
LAST = (1 << 63) - 1


def runs(hashes: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor hash and whole hash of each run."""
    counts = np.maximum(np.diff(bounds) - length + 1, 0)
    if not counts.any():
        none = np.zeros(0, np.int64)
        return none, none, none.view(U), none.view(U)
    grams = np.arange(len(hashes) - k + 1)
    value = streams.mix(streams.span_sums(hashes, streams.WORD_BASE, grams, grams + k))
    width, reach, least = length - k + 1, 1, grams
    while 2 * reach <= width:  # place of the smallest hash, leftmost first, over ever longer stretches
        a, b = least[: len(least) - reach], least[reach:]
        least, reach = np.where(value[a] <= value[b], a, b), 2 * reach
    rest = width - reach
    a, b = least[: len(least) - rest], least[rest:]
    least = np.where(value[a] <= value[b], a, b)
    row = np.repeat(np.arange(len(counts)), counts)
    at = bounds[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    anchor = least[at]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    n = np.diff(np.append(first, len(at)))
    start = at[first]
    whole = streams.span_sums(hashes, streams.WORD_BASE, start, start + n + length - 1)
    return start, n, value[anchor[first]], streams.mix(whole + n.astype(U) * U(streams.BYTE_BASE) + (anchor[first] - start).astype(U))


def _order(doc_id: str) -> Column:
    """Documents by id; those without one come last and are earlier than none."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def _key(text: str) -> Column:
    """With the id it tells rows apart; rows alike in both are alike in all that is decided here."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def seeds(docs: DataFrame, doc_id: str, text: str, length: int, k: int) -> DataFrame:
    """A row for each run: its document, first window, number of windows, anchor and whole."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            start, n, anchor, whole = runs(words.hashes, words.bounds, length, k)
            row = np.searchsorted(words.bounds, start, "right") - 1
            own = [part.column(c).take(pa.array(row)) for c in ("doc", "key")]
            local = (start - words.bounds[row]).astype(np.int32)
            columns = [*own, pa.array(local), pa.array(n.astype(np.int32)), *(pa.array(streams.signed(x)) for x in (anchor, whole))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "key", "start", "n", "anchor", "whole"])

    rows = docs.select(_order(doc_id).alias("doc"), _key(text).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc long, key long, start int, n int, anchor long, whole long")


def _window_hashes(docs: DataFrame, rims: DataFrame, doc_id: str, text: str, length: int) -> DataFrame:
    """Every window of the given runs with its hash."""
    by_doc = rims.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("rims"))
    rows = docs.select(_order(doc_id).alias("doc"), _key(text).alias("key"), F.col(text).alias("text")).join(by_doc, ["doc", "key"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            lists = part.column("rims")
            flat = lists.flatten()
            row = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
            start, n, anchor = (flat.field(c).to_numpy() for c in ("start", "n", "anchor"))
            which = np.repeat(np.arange(len(n)), n)
            at = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            begin = words.bounds[row[which]] + at
            hashes = streams.mix(streams.span_sums(words.hashes, streams.WORD_BASE, begin, begin + length))
            own = [part.column(c).take(pa.array(row[which])) for c in ("doc", "key")]
            columns = [*own, pa.array(at.astype(np.int32)), pa.array(anchor[which]), pa.array(streams.signed(hashes))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "key", "start", "anchor", "whole"])

    return rows.mapInArrow(work, "doc long, key long, start int, anchor long, whole long")


def _later(places: DataFrame) -> DataFrame:
    """With the earliest document that has the same sequence around the same anchor."""
    first = places.groupBy("anchor", "whole").agg(F.min("doc").alias("first"))
    return places.join(first, ["anchor", "whole"])


def repeated_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = ANCHOR_WORDS) -> DataFrame:
    """Runs of windows that also start in an earlier document: doc, key, start, n."""
    found = seeds(docs, doc_id, text, length, k)
    groups = found.groupBy("anchor").agg(
        (F.min("whole") != F.max("whole")).alias("differ"), F.min("doc").alias("least"), F.max("doc").alias("most")
    )
    shared = groups.where("least < most").select("anchor", "differ")
    placed = scratch.written(_later(scratch.written(found.join(shared, "anchor"), "seeds")), "runs")
    whole = placed.where("doc > first").select("doc", "key", "start", "n")
    rims = placed.where("doc = first AND differ")
    single = _later(scratch.written(_window_hashes(docs, rims, doc_id, text, length), "rims"))
    return whole.unionByName(single.where("doc > first").select("doc", "key", "start", F.lit(1).alias("n")))


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    with_text: bool = False,
) -> DataFrame:
    """Every document without the words of repeats: counts, digest of what is kept, the maximal repeats, the text if asked.

    Null text has no words. Documents without an id come after all others and repeat nothing among themselves; rows with
    one id are one document as far as order goes. An empty table gives no rows; other columns are neither read nor returned.
    """
    windows = repeated_windows(docs, doc_id, text, length)
    by_doc = scratch.written(windows.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n")).alias("found")), "repeats")
    rows = docs.select(F.col(doc_id).alias("doc_id"), _order(doc_id).alias("doc"), _key(text).alias("key"), F.col(text).alias("text"))
    joined = rows.join(by_doc, ["doc", "key"], "left").drop("doc", "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            lists = part.column("found")
            flat = lists.flatten()
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            base = words.bounds[np.repeat(np.arange(part.num_rows), sizes)]
            start, n = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "n"))
            gone = streams.cover(base + start, base + start + n + length - 1, len(words.starts))
            kept, digests, repeats = [], [], []
            data = words.raw.tobytes()
            for row in range(part.num_rows):
                lo, hi = words.bounds[row], words.bounds[row + 1]
                own = data[words.offsets[row] : words.offsets[row + 1]].split()
                if sizes[row]:
                    edge = np.flatnonzero(np.diff(gone[lo:hi].astype(np.int8), prepend=0, append=0)).tolist()
                    repeats.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])])
                    own = [w for w, g in zip(own, gone[lo:hi].tolist()) if not g]
                else:
                    repeats.append([])
                joined_words = b" ".join(own)
                digests.append(hashlib.sha256(joined_words).hexdigest())
                if with_text:
                    kept.append(joined_words.decode())
            columns = [
                part.column("doc_id"),
                pa.array(words.counts.astype(np.int64)),
                pa.array(streams.per_row(gone, words.bounds)),
                pa.array(digests, pa.string()),
                pa.array(repeats, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                *([pa.array(kept, pa.string())] if with_text else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "repeats", *(["text"] if with_text else [])]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, repeats array<struct<start:int,end:int>>"
    return joined.mapInArrow(work, schema + (", text string" if with_text else ""))
