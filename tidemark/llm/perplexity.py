"""A quality classifier by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model predicts each word, or run of signs, of a document from the one before it, and the document's end from its last
word. Pairs of words are counted over the token stream of trusted documents; below them stands how many words come before
a word, and below that the word's spelling, so no word is without a probability:

* the spelling predicts each character of a word from the four before it; a word begins with four begin marks and ends
  with an end mark. Its n-gram counts, continuation counts and smoothed probabilities are joins and aggregations over
  n-grams, sharded by n-gram; it is asked once for every distinct word of the corpus;
* all of it is counted apart for two halves of the documents, dealt by their text. A document is scored by the counts of
  the other half, so none, and no copy of it, is scored by what it has brought itself;
* a pair that the model has not seen costs what its two words cost each for itself, and a pair that it has seen differs
  from that by an amount of its own. So words and pairs alike are keys with a value, dealt to shards; each slice of
  documents sends to every shard which of its keys stand in which documents and how often, and the shard answers with
  the documents' sums.

Keys are dealt to passes by word, or by the first word of a pair. Pairs are counted and documents scored in one pass after
another, and what a pass has shuffled is deleted before the next, so the disk holds a share of the pairs at a time; every
pass reads all texts again. The most frequent keys of a pass are sent to all executors with their values, a bounded number
of them, and a filter tells most pairs that no trusted document has; only the other keys are shuffled.

A document's perplexity is taken over its characters. Documents are kept up to a quantile of the trusted documents'
perplexities in the same language. Shards hold a bounded number of keys, and are streamed, so memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams
from tidemark.llm.streams import U

ORDER = 5
BEGIN, FINISH = "\x02", "\x03"
PASSES, PASS_TOKENS = 4, 600_000  # passes at most, and tokens of trusted documents for each of fewer
FREQUENT_WORDS, FREQUENT_PAIRS = 100_000, 300_000  # keys of a pass whose values are sent to all executors: at most some 10 MB
FILTER_BITS, FILTER_BYTES = 12, 64 << 20  # bits of the filter for each pair, and bytes of it in a pass at most
TASK_PAIRS = 400_000  # pairs that a task gathers before it passes them on
SHARD_PAIRS = 500_000  # pairs that a shard counts, as they come from the tasks
SHARD_WORDS = 50_000
SHARD_KEYS = 2_000_000  # words and pairs whose values a shard holds
SLICE = 1 << 20  # bytes of text whose words and keys are gathered before they are passed on; arrays of a task take some 100 times as much
TASK_WORDS = 500_000  # distinct words that a task gathers before it passes them on
TASK_SLOTS = 1 << 18  # places for words of its first slice that a task counts without a sort
FEW_IDS = 4_000_000  # ids of trusted documents sent to all executors: at most some 100 MB
QUANTILE, MARGIN = 0.995, 1.05

# Kinds of bytes: 0 parts words, letters and digits and all beyond ASCII form words, other signs form runs of signs.
KIND = np.full(256, 2, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]] = 0
KIND[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
EVEN = U(2**64 - 2)  # the lowest bit of a word's hash gives way to the half of the model
EDGE = 0x2545F4914F6CDD1C  # stands before the first and after the last word of a document


class Tokens:
    """Words and runs of signs of a batch: spans, hashes, and for each row the range of its tokens."""

    def __init__(self, column: pa.Array) -> None:
        self.raw, self.offsets = streams.texts_of(column)
        data = self.raw.tobytes()
        self.raw, kind = (np.frombuffer(data.translate(table.tobytes()), np.uint8) for table in (FOLD, KIND))  # signs keep their kind when folded
        edge = np.ones(len(kind) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[self.offsets] = True
        at = np.flatnonzero(edge)
        starts, ends = at[:-1], at[1:]
        real = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
        self.starts, self.ends = starts[real], ends[real]
        self.bounds = np.searchsorted(self.starts, self.offsets)
        sums = streams.span_sums(streams.KEYED[self.raw], streams.BYTE_BASE, self.starts, self.ends)
        self.hashes = streams.mix(sums + (self.ends - self.starts).astype(U))

    def spelled(self, which: np.ndarray) -> pa.Array:
        """The bytes of the tokens with these numbers."""
        starts, sizes = self.starts[which], self.ends[which] - self.starts[which]
        at = np.zeros(len(which) + 1, np.int64)
        np.cumsum(sizes, out=at[1:])
        data = self.raw[np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])]
        return pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> U(32)) % U(shards)).astype(np.int32)


def vocabulary(docs: DataFrame) -> DataFrame:
    """Every distinct word with its hash and its counts in the trusted documents of either half; ``docs`` has text, key and trusted."""

    def together(parts: list[tuple[np.ndarray, pa.Array, np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        hashes, one, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
        n = np.concatenate([p[2] for p in parts])
        n = np.stack([np.bincount(which, n[:, i], len(hashes)) for i in (0, 1)], 1)
        return hashes, pa.concat_arrays([p[1] for p in parts]).take(pa.array(one)), n

    def batch_of(hashes: np.ndarray, words: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        columns = [words, pa.array(streams.signed(hashes)), *(pa.array(n[:, i].astype(np.int64)) for i in (0, 1))]
        return pa.RecordBatch.from_arrays(columns, ["word", "hash", "n0", "n1"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        first = None
        for part in streams.pieces(batches, "text", SLICE):
            t = Tokens(part.column("text"))
            good = np.repeat(part.column("trusted").to_numpy(zero_copy_only=False).astype(float), np.diff(t.bounds))
            half = np.repeat(part.column("key").to_numpy(zero_copy_only=False) & 1, np.diff(t.bounds))
            left = np.arange(len(good))
            if first is not None:
                at = (t.hashes >> U(40)).astype(np.int64) % TASK_SLOTS
                hit = (keys[at] == t.hashes) & taken[at]
                often += np.bincount(at[hit] * 2 + half[hit], weights=good[hit], minlength=2 * TASK_SLOTS).reshape(-1, 2)
                left = np.flatnonzero(~hit)
            hashes, one, which = np.unique(t.hashes[left], return_index=True, return_inverse=True)
            n = np.bincount(which * 2 + half[left], weights=good[left], minlength=2 * len(hashes)).reshape(-1, 2)
            held.append((hashes, t.spelled(left[one]), n))
            if first is None and len(hashes):
                first = np.full(TASK_SLOTS, -1)
                first[(hashes >> U(40)).astype(np.int64) % TASK_SLOTS] = np.arange(len(hashes))
                taken, often, words = first >= 0, np.zeros((TASK_SLOTS, 2)), held[-1][1]
                keys = np.where(taken, hashes[first], U(0))
            if sum(len(h[0]) for h in held) > 2 * TASK_WORDS:
                held = [together(held)]
                if len(held[0][0]) > TASK_WORDS:
                    yield batch_of(*held.pop())
        if first is not None:
            counted = np.flatnonzero(often.sum(1))
            held.append((keys[counted], words.take(pa.array(first[counted])), often[counted]))
        if held:
            yield batch_of(*together(held))

    found = docs.select("text", "key", "trusted").mapInArrow(work, "word binary, hash long, n0 long, n1 long")
    return found.groupBy("hash", "word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))  # words as keys need no sort


def _grams(words: DataFrame) -> DataFrame:
    """Characters of words with the characters before them, as n-grams of the full order."""
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.lower(F.col("word").cast("string")), F.lit(FINISH))
    spelled = words.select(padded.alias("p"), "n")
    return spelled.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("p") - ORDER + 1), lambda i: F.substring("p", i, F.lit(ORDER)))).alias("gram"), "n")


def counts(words: DataFrame) -> list[DataFrame]:
    """Counts by order, from 1: of the full order how often an n-gram stands, of lower ones how many n-grams end in it."""
    top = scratch.written(_grams(words.where("n > 0")).groupBy("gram").agg(F.sum("n").alias("c")), "grams")
    out = [top]
    for _ in range(ORDER - 1):
        shorter = out[0].select(F.expr("substring(gram, 2)").alias("gram")).groupBy("gram").agg(F.count("*").alias("c"))
        out.insert(0, scratch.written(shorter, "grams"))
    return out


def discounts(grams: DataFrame) -> list[float]:
    """The discounts of n-grams counted once, twice and more often, from how many there are of each."""
    return _discounts({r["c"]: r["n"] for r in grams.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect()})


def _discounts(seen: dict[int, int]) -> list[float]:
    n = [0, *(seen.get(i, 0) for i in range(1, 5))]
    y = n[1] / max(n[1] + 2 * n[2], 1)
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), float(i)) if n[i] else min(0.5 * i, 1.5) for i in (1, 2, 3)]


def probabilities(by_order: list[DataFrame], wanted: DataFrame) -> DataFrame:
    """The smoothed probability of the last character of every wanted n-gram of the full order."""
    known = by_order[0].count() + 1  # characters, and all others as one
    p = None
    for order, grams in enumerate(by_order, 1):
        d1, d2, d3 = discounts(grams)
        context = F.expr("substring(gram, 1, length(gram) - 1)")
        of = grams.groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), *[F.count_if(test).alias(f"n{i}") for i, test in ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") > 2))]
        )
        asked = wanted.select(F.expr(f"substring(gram, {ORDER - order + 1})").alias("gram")).distinct()
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).when(F.col("c") > 2, d3)
        joined = (
            asked.withColumn("context", context)
            .join(grams, "gram", "left")
            .join(of, "context", "left")
            .withColumn("lower", F.expr("substring(gram, 2)"))
        )
        if p is None:
            joined = joined.withColumn("q", F.lit(1.0 / known))
        else:
            joined = joined.join(p.select(F.col("gram").alias("lower"), F.col("p").alias("q")), "lower")
        own = F.coalesce((F.col("c") - cut) / F.col("total"), F.lit(0.0))
        rest = F.coalesce((d1 * F.col("n1") + d2 * F.col("n2") + d3 * F.col("n3")) / F.col("total"), F.lit(1.0))
        p = scratch.written(joined.select("gram", (own + rest * F.col("q")).alias("p")), "probabilities")
    return p


def _windows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of full order of each text, and where each text's begin; texts are at least that long."""
    signs = np.frombuffer(b"".join(column.to_pylist()).decode().encode("utf-32-le"), "<u4").astype(U)
    sizes = pc.utf8_length(column.cast(pa.string())).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    counts = sizes - (ORDER - 1)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(ends - sizes - bounds[:-1], counts) + np.arange(bounds[-1])
    sums = np.zeros(len(at), U)
    for i in range(ORDER):
        sums = streams.mix(sums * U(streams.WORD_BASE) + signs[at + i])
    return sums, bounds


def spellings(words: DataFrame, shards: int) -> DataFrame:
    """For each word, by hash, the log probabilities of its spelling in either half and its number of predicted characters."""
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.lower(F.col("word").cast("string")), F.lit(FINISH))
    grams = F.transform(F.sequence(F.lit(1), F.length("p") - ORDER + 1), lambda i: F.substring("p", i, F.lit(ORDER)))
    asked = scratch.written(words.select("shard", padded.alias("p")).select("shard", F.explode(grams).alias("gram")).distinct(), "asked")
    wanted = scratch.written(asked.select("gram").distinct(), "wanted")
    first, second = (probabilities(counts(words.select("word", F.col(n).alias("n"))), wanted).withColumnRenamed("p", n) for n in ("n0", "n1"))
    logs = F.array(F.log("n0"), F.log("n1"))
    answers = asked.join(first.join(second, "gram"), "gram").select("shard", F.lit(0).alias("kind"), F.col("gram").cast("binary").alias("a"), logs.alias("p"))
    spelling = words.select("shard", F.lit(1).alias("kind"), padded.cast("binary").alias("a"), "hash")
    rows = answers.unionByName(spelling, allowMissingColumns=True).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, known = None, [], None
        for batch in batches:
            shard, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            edges = np.flatnonzero(np.diff(shard.astype(np.int64) * 2 + kind, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                part = batch.slice(a, b - a)
                if shard[a] != current:
                    current, held, known = shard[a], [], None
                grams, bounds = _windows(part.column("a"))
                if kind[a] == 0:
                    held.append((grams, part.column("p").flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)))
                    continue
                if known is None:
                    keys, logs = (np.concatenate(x) for x in zip(*held))
                    order = np.argsort(keys)
                    known, held = (keys[order], logs[order]), []
                own = np.add.reduceat(known[1][np.searchsorted(known[0], grams)], bounds[:-1])
                logs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(own) + 1, 2, np.int32)), pa.array(own.ravel()))
                columns = [part.column("hash"), logs, pa.array(np.diff(bounds).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "logs", "n"])

    return rows.select("shard", "kind", "a", "p", "hash").mapInArrow(work, "hash long, logs array<double>, n int")


def _pairs(part: pa.RecordBatch, other: int) -> tuple[np.ndarray, ...]:
    """Rows, words and words before them of a batch, each document between two edges, and the hashes of these pairs.

    Words carry the half of their document's text, or with ``other`` = 1 the other half, in the lowest bit.
    """
    t = Tokens(part.column("text"))
    size = np.diff(t.bounds)
    size = size + (size > 0)
    ends = np.cumsum(size)
    row = np.repeat(np.arange(len(size)), size)
    half = part.column("key").to_numpy(zero_copy_only=False).view(U) & U(1) ^ U(other)
    words = np.empty(len(row), U)
    last = np.zeros(len(row), bool)
    last[ends[size > 0] - 1] = True
    words[~last], words[last] = t.hashes, U(EDGE)
    words = words & EVEN | half[row]
    before = np.concatenate([words[-1:], words[:-1]])  # the edge that ends a document is that before the next
    before = np.where(np.concatenate([last[-1:], last[:-1]]), U(EDGE) & EVEN | half[row], before)
    return row, words, before, _pair(before, words)


def _pair(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return streams.mix(before * U(streams.WORD_BASE) + words)


def pass_of(words: np.ndarray, passes: int) -> np.ndarray:
    return (words >> U(8)) % U(passes)


def in_pass(word: str, number: int, passes: int) -> Column:
    return F.pmod(F.shiftrightunsigned(word, 8), F.lit(passes)) == number


def _range_of(words: np.ndarray, shards: int) -> np.ndarray:
    """Shards that are runs of words in the order of their hashes."""
    return ((words >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def _places(pair: np.ndarray, sizes: np.ndarray | U) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a pair in a filter of so many bits."""
    return (pair >> U(8)) % sizes, (pair * U(streams.BYTE_BASE) >> U(8)) % sizes


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Pairs in the order of their first words, each once with the sum of its counts."""
    v, w, n = (np.concatenate(x) for x in zip(*parts))
    pair = _pair(v, w)
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(v), 1), bool), pair[1:] != pair[:-1]]))
    if len(first):
        n = np.add.reduceat(n[order], first)
    v, w = v[order[first]], w[order[first]]
    order = np.argsort(v)
    return v[order], w[order], n[order]


def _gathered(batches: Iterator[pa.RecordBatch], shards: int, number: int, passes: int) -> Iterator[pa.RecordBatch]:
    """The pairs of a pass in runs for each shard of first words, with how often each stands in a run's texts."""

    def dealt(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        v, w, n = _summed(parts)
        at = _range_of(v, shards)
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1)) if len(at) else np.zeros(1, np.int64)
        blobs = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (v, w, n.astype(np.uint32))]
        return pa.RecordBatch.from_arrays([pa.array(at[cuts[:-1]], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)], ["shard", "v", "w", "n"])

    held, many = [], 0
    for part in streams.pieces(batches, "text", SLICE):
        _, w, v, _ = _pairs(part, 0)
        own = pass_of(v, passes) == number
        held.append((v[own], w[own], np.ones(int(own.sum()), np.int64)))
        many += len(held[-1][0])
        if many > TASK_PAIRS:
            yield dealt(held)
            held, many = [], 0
    if many:
        yield dealt(held)


def _counted(docs: DataFrame, number: int, passes: int, shards: int) -> DataFrame:
    """Pairs of a pass with their counts, and how many pairs of their first word stand once, twice and more often.

    For each shard there is a row without words that has the filter of its pairs.
    """

    def finished(shard: int, held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        v, w, n = _summed(held)
        held.clear()
        size = max(64, min(FILTER_BITS * len(v), 8 * FILTER_BYTES // shards) // 8 * 8)
        bits = np.zeros(size, bool)
        pair = _pair(v, w)
        for x in _places(pair, U(size)):
            bits[x] = True
        start = np.flatnonzero(np.concatenate([np.ones(min(len(v), 1), bool), v[1:] != v[:-1]]))
        followers = [np.repeat(np.add.reduceat(test.astype(np.int64), start), np.diff(start, append=len(v))) if len(v) else n for test in (n == 1, n == 2, n > 2)]
        schema = pa.schema([(c, pa.int64()) for c in ("v", "w", "c", "n1", "n2", "n3")] + [("shard", pa.int32()), ("bits", pa.binary())])
        for a in range(0, len(v), 50_000):
            some = slice(a, a + 50_000)
            columns = [pa.array(x[some].view(np.int64)) for x in (v, w, n.astype(np.int64), *followers)]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(columns[0]), t) for t in (pa.int32(), pa.binary()))], schema=schema)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(6)), pa.array([shard], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for i, shard in enumerate(batch.column("shard").to_pylist()):
                if shard != current and held:
                    yield from finished(current, held)
                current = shard
                held.append(tuple(np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("v", U), ("w", U), ("n", np.uint32))))
        if held:
            yield from finished(current, held)

    runs = docs.where("trusted").select("text", "key").mapInArrow(lambda batches: _gathered(batches, shards, number, passes), "shard int, v binary, w binary, n binary")
    return runs.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(work, "v long, w long, c long, n1 long, n2 long, n3 long, shard int, bits binary")


def pair_counts(docs: DataFrame, number: int = 0, passes: int = 1, shards: int = 1) -> DataFrame:
    """How often each pair of words of a pass follows one another in trusted documents, by half; ``docs`` has text, key and trusted."""
    return _counted(docs, number, passes, shards).where("v IS NOT NULL").select("v", "w", "c")


class Known:
    """The values of the most frequent keys of a pass, and the filter of its pairs."""

    def __init__(self, words: pa.Table, pairs: pa.Table, filters: dict[int, bytes], shards: int) -> None:
        """``words`` has w, value and n, and ``pairs`` v, w and value; of two keys with one place the more frequent one stays."""
        w, v, value, often = (np.concatenate([t[c].to_numpy() if c in t.column_names else np.zeros(len(t), np.int64) for t in (words, pairs)]) for c in ("w", "v", "value", "often"))
        n = np.concatenate([words["n"].to_numpy(), np.zeros(len(pairs), np.int64)])
        keys = np.concatenate([w[: len(words)].view(U), _pair(v[len(words) :].view(U), w[len(words) :].view(U))])
        order = np.argsort(often, kind="stable")
        self.slots = 1 << max(4, len(keys).bit_length())
        at = self.place(keys[order])
        self.keys, self.values, self.sizes = np.zeros(self.slots, U), np.zeros(self.slots), np.zeros(self.slots, np.int32)
        self.keys[at], self.values[at], self.sizes[at] = keys[order], value[order], n[order]
        self.shards = shards
        found = [np.frombuffer(filters.get(i, bytes(8)), np.uint8) for i in range(shards)]
        self.bits = np.concatenate(found)
        sizes = np.array([8 * len(x) for x in found], U)
        self.many, self.starts = sizes, np.cumsum(sizes) - sizes

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> U(40)).astype(np.int64) & (self.slots - 1)

    def may_have(self, v: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Whether trusted documents may have the pairs; no pair that they have is missed."""
        at = _range_of(v, self.shards)
        good = np.ones(len(v), bool)
        for x in _places(pair, self.many[at]):
            x = x + self.starts[at]
            good &= (self.bits[(x >> U(3)).astype(np.int64)] >> (x & U(7)).astype(np.uint8) & 1).astype(bool)
        return good


def values(pairs: DataFrame, spelled: DataFrame) -> DataFrame:
    """Keys of words and of pairs seen with their values: the log probability of a document is the sum over its keys.

    ``pairs`` have their two words, ``v`` and ``w``, their count, and a key of their own, ``pair``.
    """
    table, top = word_values(pairs, spelled)
    followers = pairs.groupBy("v").agg(*(F.count_if(test).alias(f"n{i}") for i, test in ((1, F.col("c") == 1), (2, F.col("c") == 2), (3, F.col("c") > 2))))
    more = pair_values(pairs.join(followers, "v"), table, top, "pair").select(F.col("pair").alias("id"), "value", F.lit(0).alias("n"))
    return table.select(F.col("word").alias("id"), "value", "n").unionByName(more)


def _half(c: str) -> Column:
    return F.col(c).bitwiseAND(F.lit(1))


def _leveled(column: Column, by: list[list[float]], which: Column) -> Column:
    """The discount of a count in one of the halves."""
    each = [F.when(column == 1, d[0]).when(column == 2, d[1]).when(column > 2, d[2]).otherwise(0.0) for d in by]
    return F.when(which == 0, each[0]).otherwise(each[1])


def word_values(pairs: DataFrame, spelled: DataFrame, written: Callable[[DataFrame, str], DataFrame] = scratch.written) -> tuple[DataFrame, list[list[float]]]:
    """What each word is worth, with what its pairs are reckoned from; and the discounts of pairs.

    A word's value is the log of its probability below pairs and of the weight that it leaves to what it was not seen
    with.
    """

    def found(counted: DataFrame) -> list[list[float]]:
        seen = [(r["half"], r["c"], r["n"]) for r in counted.where("c <= 4").groupBy("half", "c").agg(F.count("*").alias("n")).collect()]
        return [_discounts({c: n for h, c, n in seen if h == k}) for k in (0, 1)]

    top = found(pairs.select(_half("v").alias("half"), "c"))
    cut = _leveled(F.col("c"), top, _half("v"))
    after = pairs.groupBy(F.col("v").alias("word")).agg(F.sum("c").alias("total"), F.sum(cut).alias("left"))
    follows = scratch.written(pairs.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("c")), "follows")
    low = found(follows.select(_half("word").alias("half"), "c"))
    low_cut = _leveled(F.col("c"), low, _half("word"))
    whole = {r["half"]: (r["c"], r["left"]) for r in follows.groupBy(_half("word").alias("half")).agg(F.sum("c").alias("c"), F.sum(low_cut).alias("left")).collect()}
    share = [(lambda c, left: (1.0 / c, left / c))(*whole[k]) if k in whole else (0.0, 1.0) for k in (0, 1)]
    words = spelled.select(F.col("hash").bitwiseAND(F.lit(-2)).alias("hash"), "n", F.posexplode("logs").alias("half", "log"))
    words = words.select(F.col("hash").bitwiseOR(F.col("half").cast("long")).alias("word"), "log", "n", "half")
    one, rest = (F.when(F.col("half") == 0, share[0][i]).otherwise(share[1][i]) for i in (0, 1))
    p = F.coalesce(F.col("c") - low_cut, F.lit(0.0)) * one + rest * F.exp("log")
    left = F.coalesce(F.col("left") / F.col("total"), F.lit(1.0))
    table = words.join(follows, "word", "left").join(after, "word", "left").select(
        "word", F.log(p).alias("log_p"), F.log(left).alias("log_left"), "total", "n", F.col("c").isNotNull().alias("follows")
    )
    return written(table, "words").withColumn("value", F.col("log_p") + F.col("log_left")), top


def pair_values(pairs: DataFrame, words: DataFrame, top: list[list[float]], *name: str, chosen: bool = False) -> DataFrame:
    """What the probability of each pair differs by from those of its two words, as a log; ``chosen`` pairs are few."""
    by_word = words.where("follows").select(F.col("word").alias("w"), "log_p")
    each = [sum((F.col(f"n{i}") * x for i, x in enumerate(d, 1)), F.lit(0.0)) for d in top]
    left = F.when(_half("v") == 0, each[0]).otherwise(each[1])  # of the first word's count, so that the count itself cancels out
    own = pairs.select(*{*name, "w"}, ((F.col("c") - _leveled(F.col("c"), top, _half("v"))) / left).alias("own"))
    return by_word.join(F.broadcast(own) if chosen else own, "w").select(*name, F.log1p(F.col("own") * F.exp(-F.col("log_p"))).alias("value"))


def _dealt(keyed: DataFrame, shards: int) -> DataFrame:
    """Keys and their values in runs, a few for each shard of a batch. A key is ``w`` alone, or where ``v`` is given a pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, value, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("w", "value", "n"))
            v = pc.fill_null(batch.column("v"), 0).to_numpy(zero_copy_only=False).view(U)
            keys = np.where(batch.column("v").is_null().to_numpy(zero_copy_only=False), w.view(U), _pair(v, w.view(U)))
            at = shard_of(keys, shards)
            order = np.argsort(at, kind="stable")
            keys, value, n, at = keys[order], value[order], n[order].astype(np.uint32), at[order]
            cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1))
            blobs = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (keys, n, value)]
            columns = [pa.array(at[cuts[:-1]], pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "keys", "sizes", "known"])

    return keyed.select("v", "w", "value", "n").mapInArrow(work, "shard int, keys binary, sizes binary, known binary")


ENTRY = ["shard", "docs", "doc_keys", "keys", "sizes", "rows", "times", "log", "n"]


def _entries(batches: Iterator[pa.RecordBatch], shards: int, number: int, passes: int, known: Known | None = None) -> Iterator[pa.RecordBatch]:
    """For each slice of documents and each shard: keys of a pass, and by key the documents it stands in and how often.

    What is known of a slice beforehand is a row without keys that has its documents' sums.
    """
    for turn, part in enumerate(streams.pieces(batches, "text", SLICE)):
        row, words, before, pair = _pairs(part, 1)
        alone, paired = (pass_of(x, passes) == number for x in (words, before))
        words, firsts, pair = words[alone], before[paired], pair[paired]
        rows = [row[alone], row[paired]]
        ids = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(c)) for c in ("doc_id", "key")]
        if known is not None:
            log, size = np.zeros(part.num_rows), np.zeros(part.num_rows)
            for i, x in enumerate((words, pair)):
                place = known.place(x)
                hit = known.keys[place] == x
                place = place[hit]
                log += np.bincount(rows[i][hit], known.values[place], part.num_rows)
                size += np.bincount(rows[i][hit], known.sizes[place], part.num_rows)
                left = np.flatnonzero(~hit)
                if i:
                    left = left[known.may_have(firsts[left], pair[left])]
                    pair = pair[left]
                else:
                    words = words[left]
                rows[i] = rows[i][left]
            blobs = [pa.array([x.tobytes()], pa.binary()) for x in (log, size.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([turn % shards], pa.int32()), *ids, *(pa.nulls(1, pa.binary()) for _ in range(4)), *blobs], ENTRY)
        row = np.concatenate(rows)
        keys, which = np.unique(np.concatenate([words, pair]), return_inverse=True)
        at = shard_of(keys, shards)
        order = np.argsort(at, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        keys, at = keys[order], at[order]
        cell, n = np.unique(rank[which] * part.num_rows + row, return_counts=True)
        key, row = cell // part.num_rows, (cell % part.num_rows).astype(np.uint16 if part.num_rows <= 65536 else np.uint32)
        per_key = np.bincount(key, minlength=len(keys))
        cuts = np.flatnonzero(np.diff(at, prepend=-1, append=-1)) if len(at) else np.zeros(1, np.int64)
        for a, b, x, y in zip(cuts, cuts[1:], np.searchsorted(key, cuts), np.searchsorted(key, cuts[1:])):
            times = n[x:y].astype(np.uint8 if n[x:y].max(initial=0) < 256 else np.uint32)
            sizes = per_key[a:b].astype(np.uint8 if per_key[a:b].max(initial=0) < 256 else np.uint32)
            blobs = [keys[a:b].tobytes(), sizes.tobytes(), row[x:y].tobytes(), times.tobytes()]
            columns = [
                pa.array([at[a]], pa.int32()),
                *ids,
                *(pa.array([blob], pa.binary()) for blob in blobs),
                *(pa.nulls(1, pa.binary()) for _ in range(2)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ENTRY)


def _incidence(docs: DataFrame, shards: int, number: int, passes: int, known: Broadcast | None) -> DataFrame:
    schema = "shard int, docs array<long>, doc_keys array<long>, keys binary, sizes binary, rows binary, times binary, log binary, n binary"
    return docs.select("doc_id", "key", "text").mapInArrow(lambda batches: _entries(batches, shards, number, passes, known and known.value), schema)


def sums(docs: DataFrame, keyed: DataFrame, shards: int, number: int = 0, passes: int = 1, frequent: Broadcast | None = None) -> DataFrame:
    """For each document, over its keys of a pass, the log probability and the number of predicted characters.

    ``docs`` has doc_id, key and text; ``keyed`` the values of words, ``w``, and of pairs, ``v`` and ``w``.
    """
    known = _dealt(keyed, shards).withColumn("kind", F.lit(0))
    slices = _incidence(docs, shards, number, passes, frequent).withColumn("kind", F.lit(1))
    rows = known.unionByName(slices, allowMissingColumns=True).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, ordered = None, [], None
        for batch in batches:
            column = {n: batch.column(n) for n in batch.schema.names}
            shard, kind = (column[c].to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            edges = np.flatnonzero(np.diff(shard.astype(np.int64) * 2 + kind, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                if shard[a] != current:
                    current, held, ordered = shard[a], [], None
                if kind[a] == 0:
                    blobs = [b"".join(column[c].slice(a, b - a).to_pylist()) for c in ("keys", "known", "sizes")]
                    held.append([np.frombuffer(x, t) for x, t in zip(blobs, (U, float, np.uint32))])
                    continue
                if ordered is None:
                    keys, value, n = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, t) for t in (U, float, np.uint32))
                    order = np.argsort(keys)
                    ordered, held = (keys[order], value[order], n[order]), []
                for i in range(a, b):
                    docs_, doc_keys = column["docs"][i].values, column["doc_keys"][i].values
                    if column["log"][i].is_valid:
                        log, size = (np.frombuffer(column[c][i].as_py(), t) for c, t in (("log", float), ("n", np.int64)))
                        seen = np.flatnonzero((size > 0) | (log != 0))
                        columns = [docs_.take(pa.array(seen)), doc_keys.take(pa.array(seen)), pa.array(log[seen]), pa.array(size[seen])]
                        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "log", "n"])
                        continue
                    keys, sizes = np.frombuffer(column["keys"][i].as_py(), U), column["sizes"][i].as_py()
                    sizes = np.frombuffer(sizes, np.uint8 if len(sizes) == len(keys) else np.uint32)
                    many = int(sizes.sum())
                    of_row, times = (column[c][i].as_py() for c in ("rows", "times"))
                    row = np.frombuffer(of_row, np.uint16 if len(of_row) == 2 * many else np.uint32)
                    times = np.frombuffer(times, np.uint8 if len(times) == many else np.uint32)
                    log, size = np.zeros(len(docs_)), np.zeros(len(docs_), np.int64)
                    if len(ordered[0]):
                        at = np.minimum(np.searchsorted(ordered[0], keys), len(ordered[0]) - 1)
                        hit = ordered[0][at] == keys  # a pair that was not seen adds nothing
                        at, hit = np.repeat(at, sizes), np.repeat(hit, sizes)
                        log = np.bincount(row, np.where(hit, ordered[1][at], 0.0) * times, len(docs_))
                        size = np.bincount(row, np.where(hit, ordered[2][at], 0) * times, len(docs_)).astype(np.int64)
                    seen = np.flatnonzero(np.bincount(row, minlength=len(docs_)))
                    columns = [docs_.take(pa.array(seen)), doc_keys.take(pa.array(seen)), pa.array(log[seen]), pa.array(size[seen])]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "log", "n"])

    return rows.mapInArrow(work, "doc_id long, key long, log double, n long").groupBy("doc_id", "key").agg(F.sum("log").alias("log"), F.sum("n").alias("n"))


def _least(df: DataFrame, count: str, most: int) -> int:
    """The least count from which on no more than so many rows have theirs."""
    each = df.groupBy(F.least(F.col(count), F.lit(1_000_000)).cast("long").alias("c")).agg(F.count("*").alias("n")).collect()
    kept, least = 0, 1_000_001
    for r in sorted(each, key=lambda r: -r["c"]):
        kept += r["n"]
        if kept > most:
            break
        least = r["c"]
    return least


def classify(
    docs: DataFrame,
    labels: DataFrame,
    quantile: float = QUANTILE,
    margin: float = MARGIN,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Every document with its perplexity, its language's threshold and the verdict.

    Trusted are documents labelled of good quality and not toxic; an id with conflicting labels is not. Documents
    without words have no perplexity and are not kept; a language without trusted documents has the threshold of all
    languages together; without any trusted documents all with words are kept. Null ids and repeated rows are documents
    of their own; an empty table gives no rows; other columns are neither read nor returned.
    """
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    good = scratch.written(good.where("quality = 1 AND coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("good")), "trusted")
    few = good.count() <= FEW_IDS
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), content.alias("text"), F.col(lang).alias("lang"), F.xxhash64(content).alias("key"))
    rows = rows.join(F.broadcast(good) if few else good, F.col("doc_id") == F.col("good"), "left").withColumn("trusted", F.col("good").isNotNull()).drop("good")
    spark = docs.sparkSession
    with scratch.phase(spark) as keep_scored:
        with scratch.phase(spark):
            with scratch.phase(spark) as keep:
                words = scratch.written(vocabulary(rows), "words")
                found = words.agg(F.count("*").alias("words"), F.coalesce(F.sum(F.col("n0") + F.col("n1")), F.lit(0)).alias("tokens")).first()
                passes = min(PASSES, max(1, -(-found["tokens"] // PASS_TOKENS)))
                runs = max(2 * spark.sparkContext.defaultParallelism, -(-found["tokens"] // (passes * SHARD_PAIRS)))
                counted = keep((_counted(rows, i, passes, runs) for i in range(passes)), "pairs")
                pairs = counted.where("v IS NOT NULL").select("v", "w", "c", "n1", "n2", "n3", "part")
                with scratch.phase(spark) as keep_spelled:
                    shards = max(1, -(-found["words"] // SHARD_WORDS))
                    at = F.pmod(F.shiftrightunsigned("hash", 32), F.lit(shards)).cast("int")
                    edge = spark.createDataFrame([(EDGE, bytearray(), 0, 0)], "hash long, word binary, n0 long, n1 long")  # spelled as no characters and an end
                    spelled = keep_spelled(spellings(words.unionByName(edge).withColumn("shard", at), shards), "spellings")
                table, top = word_values(pairs, spelled, keep)
            many = table.count()
            common, often = _least(table.where("total IS NOT NULL"), "total", passes * FREQUENT_WORDS), _least(pairs, "c", passes * FREQUENT_PAIRS)

            def keyed(i: int) -> DataFrame:
                own = table.where(in_pass("word", i, passes))
                more = pair_values(pairs.where(F.col("part") == i), table, top, "v", "w")
                return own.select(F.lit(None).cast("long").alias("v"), F.col("word").alias("w"), "value", "n").unionByName(more.withColumn("n", F.lit(0)))

            def frequent(i: int) -> Broadcast:
                own = table.where(in_pass("word", i, passes))
                first = own.where(F.col("total") >= common).select(F.col("word").alias("w"), "value", "n", F.col("total").alias("often")).toArrow()
                chosen = pairs.where((F.col("part") == i) & (F.col("c") >= often)).withColumn("often", F.col("c"))
                second = pair_values(chosen, table, top, "v", "w", "often", chosen=True).toArrow()
                filters = {r["shard"]: bytes(r["bits"]) for r in counted.where((F.col("part") == i) & F.col("v").isNull()).select("shard", "bits").collect()}
                return spark.sparkContext.broadcast(Known(first, second, filters, runs))

            shards = max(spark.sparkContext.defaultParallelism, -(-(many + pairs.count()) // (passes * SHARD_KEYS)))

            def summed() -> Iterator[DataFrame]:
                for i in range(passes):
                    known = frequent(i)
                    yield sums(rows, keyed(i), shards, i, passes, known)
                    known.destroy()  # when the pass is written; every node has a file of it

            partial = scratch.parts(spark, summed(), "sums")
            scored = keep_scored(partial.groupBy("doc_id", "key").agg(F.sum("log").alias("log"), F.sum("n").alias("n")), "scored")
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.key") == F.col("s.key"))
    rated = rows.drop("text").alias("d").join(scored.alias("s"), same, "left").select("d.*", F.exp(-F.col("log") / F.col("n")).alias("perplexity"))
    rated = scratch.written(rated.drop("key"), "rated")
    trusted = rated.where("trusted AND perplexity IS NOT NULL")
    limit = F.percentile_approx("perplexity", quantile, 10_000) * margin
    by_lang = trusted.groupBy("lang").agg(limit.alias("own"))
    overall = trusted.agg(limit.alias("overall")).first()["overall"]
    threshold = F.coalesce("own", F.lit(overall).cast("double"), F.lit(float("inf")))
    joined = rated.alias("r").join(F.broadcast(by_lang.alias("l")), F.col("r.lang").eqNullSafe(F.col("l.lang")), "left")  # a row a language
    return joined.select("doc_id", "r.lang", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(False)).alias("kept"))
