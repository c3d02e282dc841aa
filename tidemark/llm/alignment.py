"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers split a space and the text; their tokens are spans of the same bytes. Two pointers walk the two token
lists of a document, and each step links the tokens under them, then moves past those that end first; where both end, the
step is a cut. All documents of a batch step together: one NumPy vector holds the pointers of every document, and
documents that are done are taken out of it. A long document is several entries of the vector, each from a byte offset on,
so its length does not add steps.

How often a pair of ids is linked is a count over the corpus. Each task sums the pairs it has seen into blocks; only those
sums are shuffled by pair. The counts go back to their block, where the compact links of its documents wait for them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams

LANE = 1024  # bytes of text that one entry of the state vector walks
CACHED_SEGMENTS, CACHED_BYTES = 100_000, 64  # segments in each half of the cache, bytes of the longest kept
PIECE = 1 << 19  # bytes of text that are aligned at once; what a task holds beside its cache is in proportion to it
BLOCK_PAIRS, BLOCK_BYTES = 1 << 20, 64 << 20  # a block is closed beyond either
B_BITS = 32  # a pair is one number: the id of A above so many bits, the id of B below

_SPACE = 0x20
_loaded: dict[tuple[int, int], Pair] = {}


class Pair:
    """Two tokenizers over one text: byte-level BPE (A, a JSON file) and sentence pieces (B, a model that adds a space).

    No token of either runs over the place between a character that is not white space and a space, so a text's tokens are
    those of its segments between such places; each segment is looked up, and the libraries see a new one once. New
    segments of A go to the merges by rank where the file's merges stand in the order of their ids, else and for long
    segments to the file's own library. The cache has two halves; when one is full it becomes the older, and segments
    still in use move on. A segment's ids of both are one run of numbers, as narrow as the vocabularies allow: the number
    of A's ids in two 16-bit halves, A's ids, B's ids. A segment that the tokens do not spell has an empty run.
    """

    def __init__(self, spec_a: str, model_b: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(spec_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        letters = {chr(c): b for b, c in _byte_letters().items()}
        size_a, size_b = self._a.get_vocab_size(), self._b.get_piece_size()
        self.bytes_a = [_spelled(self._a.id_to_token(i) or "", letters) for i in range(size_a)]
        pieces = [self._b.id_to_piece(i) for i in range(size_b)]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece runs from a word into the next; segments would not be independent")
        self._ranked = _by_rank(json.loads(spec_a), letters)
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.kind = np.dtype("<u2" if max(size_a, size_b) <= 1 << 16 else "<i4")
        self._cache: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _one(self, segment: bytes) -> bytes:
        """The run of one segment."""
        text = segment.decode(errors="replace")
        a = self._a.encode(text, add_special_tokens=False).ids
        b = self._b.encode(text[1:], num_threads=1) if text[1:] else [self._b.piece_to_id("▁")]  # a text's last space
        if b"".join([self.bytes_a[i] for i in a]) != segment or b"".join([self.bytes_b[i] for i in b]) != segment:
            return b""
        return np.array([len(a) >> 16, len(a) & 0xFFFF, *a, *b], self.kind).tobytes()

    def _many(self, segments: list[bytes]) -> list[bytes]:
        """The same of many short segments that end in no white space: one call of each library."""
        whole = b"".join(segments)
        ends = np.cumsum([len(s) for s in segments])
        if self._ranked is None or not segments:
            return [self._one(s) for s in segments]
        try:
            text, words = whole.decode(), [s[1:].decode() for s in segments]
        except UnicodeDecodeError:
            return [self._one(s) for s in segments]
        a = np.array(self._ranked.encode_ordinary(text), "<i4")
        each = self._b.encode(words, num_threads=1)
        b = np.array([i for ids in each for i in ids], "<i4")
        if b"".join([self.bytes_a[i] for i in a]) != whole or b"".join([self.bytes_b[i] for i in b]) != whole:
            return [self._one(s) for s in segments]
        after_a, after_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
        to_a, to_b = np.searchsorted(after_a, ends, "right"), np.cumsum([len(ids) for ids in each])
        if (after_a[to_a - 1] != ends).any() or (after_b[to_b - 1] != ends).any():
            return [self._one(s) for s in segments]
        n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        after = np.cumsum(2 + n_a + n_b)
        runs = np.zeros(after[-1], self.kind)
        first = after - n_a - n_b
        runs[first - 1] = n_a  # short segments have few
        runs[np.repeat(first - (to_a - n_a), n_a) + np.arange(len(a))] = a
        runs[np.repeat(after - to_b, n_b) + np.arange(len(b))] = b
        data, stops = runs.tobytes(), (self.kind.itemsize * after).tolist()
        return [data[x:y] for x, y in zip([0, *stops], stops)]

    def of(self, segments: list[bytes]) -> list[bytes]:
        if len(self._cache) > CACHED_SEGMENTS:
            self._cache, self._older = {}, self._cache
        cache, older = self._cache, self._older
        new = {s for s in segments if s not in cache}
        passing: dict[bytes, bytes] = {}
        if new:
            short = []
            for s in new:
                if s in older:
                    cache[s] = older[s]
                elif len(s) > CACHED_BYTES:
                    passing[s] = self._one(s)
                elif _sure(s):
                    short.append(s)
                else:
                    cache[s] = self._one(s)
            cache.update(zip(short, self._many(short)))
        return [cache[s] if s in cache else passing[s] for s in segments]

    @functools.cached_property
    def written(self) -> Written:
        return Written(max(len(self.bytes_a), len(self.bytes_b)))

    def split(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of A and those of B of runs that are not empty."""
        runs = np.frombuffer(b"".join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        first = np.cumsum(sizes) - sizes
        n_a = (runs[first].astype(np.int64) << 16) | runs[first + 1]
        is_a, is_b = (np.repeat(np.tile([False, of_a, not of_a], len(found)), np.stack([np.full(len(found), 2), n_a, sizes - 2 - n_a], 1).ravel()) for of_a in (True, False))
        return runs[is_a].astype(np.int32), runs[is_b].astype(np.int32)


def _sure(segment: bytes) -> bool:
    """Whether the last character surely is not white space: ASCII, or a letter of two bytes."""
    last, before = segment[-1], segment[-2:][0]
    return 0x20 < last < 0x7F or (last >= 0x80 and 0xC3 <= before < 0xE0)


def _by_rank(spec: dict, letters: dict[str, int]):
    """An encoder that merges by id, where the tokenizer file says nothing else; None where it does."""
    import public_tokenizers
    import tiktoken

    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or spec.get("normalizer") or model.get("type") != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    ranks = {_spelled(t, letters): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get("".join(m)) for m in merged]
    if None in made or made != sorted(set(made)) or (made and made[0] < 256) or len(made) + 256 != len(ranks):
        return None
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _byte_letters() -> dict[int, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 0x100 + i for i, b in enumerate(others)}


def _spelled(token: str, letters: dict[str, int]) -> bytes:
    return bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()


def spaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each, as one run of bytes with offsets; empty texts stay empty."""
    full = (offsets[1:] > offsets[:-1]).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(full + np.diff(offsets))])
    out = np.full(starts[-1], _SPACE, np.uint8)
    kept = np.ones(len(out), bool)
    kept[starts[:-1][full > 0]] = False
    out[kept] = raw
    return out, starts


def segment_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of texts, and spaces behind a character that surely is not white space: ASCII, or a letter of two bytes."""
    space = np.flatnonzero(raw == _SPACE)
    space = space[space >= 2]
    last, before = raw[space - 1], raw[space - 2]
    sure = ((last > _SPACE) & (last < 0x7F)) | ((last >= 0x80) & (before >= 0xC3) & (before < 0xE0))
    return np.union1d(space[sure], offsets[:-1][offsets[1:] > offsets[:-1]])


@dataclass
class Aligned:
    """The tokens and links of a batch. ``bounds_x`` are where a document's tokens, links or groups start and end."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray  # byte offsets within the batch, each document with its space
    ends_b: np.ndarray
    link_a: np.ndarray  # token numbers within the batch
    link_b: np.ndarray
    cut: np.ndarray  # whether both tokens of the link end at one byte
    starts: np.ndarray  # of documents, in bytes
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    bounds_links: np.ndarray

    def pairs(self) -> np.ndarray:
        return (self.a[self.link_a].astype(np.int64) << B_BITS) | self.b[self.link_b]

    def cuts(self) -> np.ndarray:
        return self.ends_a[self.link_a[self.cut]]


def lockstep(
    ends_a: np.ndarray, ends_b: np.ndarray, lows: np.ndarray, highs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links whose common bytes end in one of the ranges (low, high], in order, and which of them are cuts.

    Every range has its pointers in the state vector and moves one link a step; ranges that are done leave it.
    """
    beyond = np.array([np.iinfo(np.int64).max], np.int64)
    stop_a, stop_b = np.concatenate([ends_a, beyond]), np.concatenate([ends_b, beyond])
    i, j = np.searchsorted(ends_a, lows, "right"), np.searchsorted(ends_b, lows, "right")
    most = np.searchsorted(ends_a, highs, "right") - i + np.searchsorted(ends_b, highs, "right") - j
    at = np.cumsum(most) - most
    total = int(most.sum())
    link_a, link_b = np.zeros(total, np.int32), np.zeros(total, np.int32)
    cut, used = np.zeros(total, bool), np.zeros(total, bool)
    high = highs
    while len(i):
        end_a, end_b = stop_a[i], stop_b[j]
        end = np.minimum(end_a, end_b)
        on = end <= high
        if not on.all():
            i, j, at, high, end_a, end_b, end = (x[on] for x in (i, j, at, high, end_a, end_b, end))
        past_a, past_b = end_a == end, end_b == end
        link_a[at], link_b[at], cut[at], used[at] = i, j, past_a & past_b, True
        i, j, at = i + past_a, j + past_b, at + 1
    return link_a[used], link_b[used], cut[used]


def aligned(column: pa.Array, tokenizers: Pair) -> Aligned:
    """Tokens, links and cuts of the texts of a batch; texts that the tokens do not spell have none."""
    raw, offsets = spaced(*streams.texts_of(column))
    data = raw.tobytes()
    at = segment_starts(raw, offsets)
    edges = [*at.tolist(), len(data)]
    found = tokenizers.of([data[x:y] for x, y in zip(edges, edges[1:])])
    spelled = np.array([len(f) > 0 for f in found], bool)
    if not spelled.all():
        row = np.searchsorted(offsets, at, "right") - 1
        spelled = ~np.isin(row, row[~spelled])
        found = [f for f, ok in zip(found, spelled.tolist()) if ok]
    a, b = tokenizers.split(found)
    sizes = np.diff(np.array(edges, np.int64))

    def ends(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Where tokens end; bytes of texts that are left out lie between them."""
        after = np.cumsum(lengths[ids])
        if spelled.all() or not len(after):
            return after
        inside = np.cumsum(sizes[spelled])
        skipped = np.cumsum(np.where(spelled, 0, sizes))[spelled]
        return after + skipped[np.searchsorted(inside, after, "left")]

    ends_a, ends_b = ends(a, tokenizers.sizes_a), ends(b, tokenizers.sizes_b)
    lanes = -(-np.diff(offsets) // LANE)
    lows = np.repeat(offsets[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    highs = np.minimum(lows + LANE, np.repeat(offsets[1:], lanes))
    link_a, link_b, cut = lockstep(ends_a, ends_b, lows, highs)
    bounds_a, bounds_b = np.searchsorted(ends_a, offsets, "right"), np.searchsorted(ends_b, offsets, "right")
    bounds_links = np.searchsorted(link_a, bounds_a, "left")
    return Aligned(a, b, ends_a, ends_b, link_a, link_b, cut, offsets, bounds_a, bounds_b, bounds_links)


class Written:
    """Groups as text: ``a1,a2|b1;a3|b2,b3`` of decimal ids."""

    def __init__(self, ids: int) -> None:
        spelled = [str(i).encode() for i in range(ids)]
        self.sizes = np.array([len(s) for s in spelled], np.int8)
        self.width = int(self.sizes.max()) + 1
        self.table = np.frombuffer(b"".join(s.ljust(self.width) for s in spelled), np.uint8).reshape(ids, self.width)

    def texts(self, x: Aligned) -> Iterator[memoryview]:
        """For each document of the batch the text of its groups."""
        last_a, last_b = x.link_a[x.cut], x.link_b[x.cut]
        size_a, size_b = (np.diff(last, prepend=-1) for last in (last_a, last_b))
        n = len(x.a) + len(x.b)
        place_a = np.arange(len(x.a)) + np.repeat(last_b + 1 - size_b, size_a)  # behind B's tokens of earlier groups
        place_b = np.arange(len(x.b)) + np.repeat(last_a + 1, size_b)
        ids, sign = np.empty(n, np.int32), np.full(n, ord(","), np.uint8)
        ids[place_a], ids[place_b] = x.a, x.b
        sign[place_a[last_a]], sign[place_b[last_b]] = ord("|"), ord(";")
        cells, sizes = self.table[ids], self.sizes[ids].astype(np.int64)
        cells[np.arange(n), sizes] = sign
        flat = cells[np.arange(self.width) <= sizes[:, None]]
        after = np.concatenate([[0], np.cumsum(sizes + 1)])
        view = memoryview(flat)
        for low, high in zip(after[x.bounds_a[:-1] + x.bounds_b[:-1]], after[x.bounds_a[1:] + x.bounds_b[1:]]):
            yield view[low : max(low, high - 1)]


def _tokenizers(spec_a, model_b) -> Pair:
    key = hash(spec_a.value), hash(model_b.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Pair(spec_a.value, model_b.value)
    return _loaded[key]


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def links(docs: DataFrame, spec_a: str, model_b: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignment of every row's text: ids of both tokenizers, links as pairs of token numbers, cuts as byte offsets.

    Offsets count from the space that stands before the text. Null and empty texts, and texts that the tokens of either
    do not spell, have empty lists; null ids, repeated rows and empty tables go through; other columns are left out.
    """
    context = docs.sparkSession.sparkContext
    a, b = context.broadcast(spec_a), context.broadcast(model_b)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text", PIECE):
            x = aligned(part.column("text"), _tokenizers(a, b))
            rows = np.repeat(np.arange(part.num_rows), np.diff(x.bounds_links))
            cut_bounds = np.concatenate([[0], np.cumsum(x.cut)])[x.bounds_links]
            first = x.starts[:-1]
            columns = [
                (x.bounds_a, x.a),
                (x.bounds_b, x.b),
                (cut_bounds, x.cuts() - first[rows[x.cut]]),
                (x.bounds_links, x.link_a - x.bounds_a[:-1][rows]),
                (x.bounds_links, x.link_b - x.bounds_b[:-1][rows]),
            ]
            lists = [pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.array(v, pa.int32())) for n, v in columns]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *lists], names)

    rows = _texts(docs, doc_id, text)
    names = ["doc_id", "a_ids", "b_ids", "cuts", "link_a", "link_b"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, " + ", ".join(f"{n} array<int>" for n in names[1:]))


_PER_DOC = ("n_a", "n_b", "n_groups", "n_links")


def digest(docs: DataFrame, spec_a: str, model_b: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the alignment of every row's text, the hash of its groups, and how its links stand in the corpus.

    ``n_best`` are links whose pair is the most frequent of its id of B, ``count_sum`` sums the pairs' counts over links.
    Awkward rows are treated as in ``links`` and have zeros and an empty hash.
    """
    spark = docs.sparkSession
    a, b = spark.sparkContext.broadcast(spec_a), spark.sparkContext.broadcast(model_b)
    rows = _texts(docs, doc_id, text)
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    fields = [("block", pa.string()), ("doc_id", pa.list_(to_arrow_type(kind)))]
    fields += [(n, pa.list_(pa.int64())) for n in _PER_DOC]
    fields += [("groups_sha256", pa.list_(pa.string())), ("seen", pa.binary()), ("links", pa.binary()), ("size", pa.int64())]
    fields += [("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def one_list(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def row(**given: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([given.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = uuid.uuid4().hex, 0
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def summed() -> pa.RecordBatch:
            return row(block=pa.array([block]), pairs=one_list(pa.array(pairs)), counts=one_list(pa.array(counts)))

        for part in streams.pieces(batches, "text"):
            hashes, per_piece, linked = [], [], []
            for piece in streams.pieces(iter([part]), "text", PIECE):
                tokenizers = _tokenizers(a, b)
                x = aligned(piece.column("text"), tokenizers)
                hashes += [hashlib.sha256(t).hexdigest() if len(t) else "" for t in tokenizers.written.texts(x)]
                cuts = streams.per_row(x.cut, x.bounds_links)
                per_piece.append((np.diff(x.bounds_a), np.diff(x.bounds_b), cuts, np.diff(x.bounds_links)))
                linked.append(x.pairs())
                size += int(x.starts[-1])
            per_doc = [np.concatenate(values) for values in zip(*per_piece)]
            seen, local, own = np.unique(np.concatenate(linked), return_inverse=True, return_counts=True)
            narrow = local.astype("<u2" if len(seen) <= 1 << 16 else "<u4").tobytes()
            yield row(
                block=pa.array([block]),
                doc_id=one_list(part.column("doc_id")),
                groups_sha256=one_list(pa.array(hashes, pa.string())),
                seen=pa.array([pa.compress(seen.astype("<i8").tobytes(), "zstd", asbytes=True)]),
                links=pa.array([pa.compress(narrow, "zstd", asbytes=True)]),
                size=pa.array([len(seen)]),
                **{n: one_list(pa.array(v.astype(np.int64))) for n, v in zip(_PER_DOC, per_doc)},
            )
            both, into = np.unique(np.concatenate([pairs, seen]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, into, np.concatenate([counts, own]))
            pairs, counts = both, total
            if len(pairs) >= BLOCK_PAIRS or size >= BLOCK_BYTES:
                yield summed()
                block, size = uuid.uuid4().hex, 0
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if size:
            yield summed()

    from pyspark.sql.pandas.types import from_arrow_schema

    made = scratch.written(rows.mapInArrow(work, from_arrow_schema(schema)), "slices")
    spread = made.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    spread = spread.select("block", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n"))
    totals = spread.groupBy("pair").agg(F.sum("n").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.expr(f"pair & {(1 << B_BITS) - 1}L")))
    totals = totals.withColumn("best", F.col("n") == top)
    known = spread.select("block", "pair").join(totals.hint("merge"), "pair")
    known = known.groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("known"))
    known = known.select("block", *[F.col(f"known.{c}").alias(c) for c in ("pair", "n", "best")])
    slices = made.where("pairs IS NULL").drop("pairs", "counts")
    met = slices.join(known.hint("merge"), "block", "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                cell = {n: one.column(n) for n in one.schema.names}
                bounds = np.concatenate([[0], np.cumsum(cell["n_links"].flatten().to_numpy(zero_copy_only=False))])
                size = cell["size"][0].as_py()
                seen = np.frombuffer(pa.decompress(cell["seen"][0].as_py(), 8 * size, "zstd", asbytes=True), "<i8")
                width = 2 if size <= 1 << 16 else 4
                plain = pa.decompress(cell["links"][0].as_py(), width * int(bounds[-1]), "zstd", asbytes=True)
                local = np.frombuffer(plain, f"<u{width}")
                pair, n, best = (cell[c].flatten().to_numpy(zero_copy_only=False) for c in ("pair", "n", "best"))
                order = np.argsort(pair)
                at = order[np.searchsorted(pair, seen, sorter=order)] if size else np.zeros(0, np.int64)
                sums = [streams.per_row(values.astype(np.int64)[at][local], bounds) for values in (best, n)]
                same = [cell[c].flatten() for c in ("doc_id", *_PER_DOC, "groups_sha256")]
                yield pa.RecordBatch.from_arrays([*same[:5], *map(pa.array, sums), same[5]], names)

    names = ["doc_id", *_PER_DOC, "n_best", "count_sum", "groups_sha256"]
    out = ", ".join(f"{n} long" for n in names[1:-1])
    return met.mapInArrow(judge, f"doc_id {kind.simpleString()}, {out}, groups_sha256 string")
