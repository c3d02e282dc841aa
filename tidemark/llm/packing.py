"""Best-fit packing: documents as token sequences of a fixed capacity, as few as can be found.

The number of pieces of each length is all that the plan needs, at most ``capacity`` numbers. Over it stands the
configuration linear program: choose how often to use each way of filling a sequence so that all pieces are covered.
It is solved by multiplicative weights; the fills that are worth most under the weights come from a knapsack dynamic
program. The solution is rounded to whole uses, the program is solved again over what that leaves, and only the last rest
is filled by best fit. Pieces then find their places by their rank among the pieces of their length, so no task sees more
than its own rows.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams

ROUNDS = 100  # of multiplicative weights
LEADERS = 256  # fills drawn in a round
SLACK = 0.0005  # a drawn fill is worth at most this share less than the best
PASSES = 4  # over what rounding has left
CACHED_WORDS = 250_000  # in each half of the cache, some 50 MB
LATIN_END = "\u0250"
SIGNS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())

# Byte-level vocabularies write bytes as characters: printable ones as themselves, the others from U+0100 on.
_PLAIN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

_loaded: dict[int, WordIds] = {}


class WordIds:
    """Ids of texts through a cache by white-space delimited word; the library sees each new word once.

    For a tokenizer that drops white space, a text's ids are its words' ids in a row. A run of ASCII signs that follows a
    Latin letter or a digit is split off by the tokenizer, so the word and the run are looked up apart. A word of Latin
    letters alone is lowered and handed to the merges at once, as normalizing and splitting leave it whole. When the cache
    is full, it becomes the older half and words still in use move on.
    """

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(spec)
        self._merges = self._library.model
        self._written = [i.to_bytes(4, "little") for i in range(self._library.get_vocab_size())]
        self._cache: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _ask(self, word: bytes) -> bytes:
        text, written = word.decode(), self._written
        if word.isalpha() and word.islower():  # of bytes: of ASCII letters alone
            return b"".join([written[t.id] for t in self._merges.tokenize(text)])
        if text.isalpha() and max(text) < LATIN_END and text.lower() == text:
            return b"".join([written[t.id] for t in self._merges.tokenize(word.decode("latin-1").translate(_BYTE_LETTERS))])
        return b"".join([written[i] for i in self._library.encode(text, add_special_tokens=False).ids])

    def _find(self, word: bytes) -> bytes:
        ids = self._cache.get(word)
        if ids is None:
            ids = self._older.get(word)
            if ids is None:
                special = b"<" in word  # special strings stand as they are written
                if word[-1] in SIGNS and not special and _splits(core := word.rstrip(SIGNS)):
                    ids = self._find(core) + self._find(word[len(core) :])
                elif not special and (low := _lowered(word)) != word:
                    ids = self._find(low)
                else:
                    ids = self._ask(word)
            self._cache[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        if len(self._cache) > CACHED_WORDS:
            self._cache, self._older = {}, self._cache
        words = text.split()
        out = list(map(self._cache.get, words))
        if None in out:
            out = [self._find(word) if ids is None else ids for word, ids in zip(words, out)]
        return b"".join(out)


def _splits(core: bytes) -> bool:
    """Whether the tokenizer parts this from the signs behind it: it ends in a Latin letter or an ASCII digit."""
    if core[-1:].isalnum():
        return True
    last = core[-2:].decode(errors="ignore")[-1:]  # Latin letters beyond ASCII have two bytes
    return last.lower().isalpha() and last < LATIN_END  # a dotted capital I leaves its dot to the signs


def _lowered(word: bytes) -> bytes:
    """The word in lower case as the tokenizer has it, where that is sure: of ASCII or of Latin letters alone."""
    if word.isascii():
        return word.lower()
    text = word.decode()
    low = text.lower()
    return low.encode() if low != text and text.isalpha() and low.isalpha() and max(text) < LATIN_END and max(low) < LATIN_END else word


def cut(docs: DataFrame, spec: str, capacity: int, end_id: int, doc_id: str, text: str, with_ids: bool) -> DataFrame:
    """Pieces of every document's ids, each with its rank among the pieces of its length that its task has made."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shared.value)
        if key not in _loaded:
            _loaded.clear()
            _loaded[key] = WordIds(shared.value)
        part, ranks = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in streams.pieces(batches, "text"):
            raw, offsets = streams.texts_of(batch.column("text"))
            row, piece, start, length, crc, rank, kept = [], [], [], [], [], [], []
            for i in range(batch.num_rows):
                ids = _loaded[key].ids(raw[offsets[i] : offsets[i + 1]].tobytes()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
                    rank.append(ranks[len(own) // 4])
                    ranks[len(own) // 4] += 1
                    if with_ids:
                        kept.append(np.frombuffer(own, "<u4").astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                    pa.array([part] * len(row), pa.int32()),
                    pa.array(rank, pa.int64()),
                    *([pa.array(kept, pa.list_(pa.int32()))] if with_ids else []),
                ],
                names,
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", *(["ids"] if with_ids else [])]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, rank long"
    return rows.mapInArrow(work, schema + (", ids array<int>" if with_ids else ""))


def knapsack(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room up to the capacity what its best fill is worth, and a length to begin that fill with, -1 if none."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1, np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        n = fitting[c]
        best[c], took[c] = best[c - 1], took[c - 1]
        if n:
            values = best[c - lengths[:n]] + worth[:n]
            i = int(values.argmax())
            if values[i] > best[c]:
                best[c], took[c] = values[i], i
    return best, took


def priced(lengths: np.ndarray, worth: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths within the capacity that is worth most: an unbounded knapsack by dynamic programming."""
    _, took = knapsack(lengths, worth, capacity)
    fill: dict[int, int] = {}
    c = capacity
    while took[c] >= 0:
        length = int(lengths[took[c]])
        fill[length] = fill.get(length, 0) + 1
        c -= length
    return fill


def near_best(
    lengths: np.ndarray, worth: np.ndarray, best: np.ndarray, first: np.ndarray, slack: float, liked: np.ndarray, pick: np.random.Generator
) -> np.ndarray:
    """Fills that begin with the given lengths and are worth at most ``slack`` less than the best, drawn as lengths are liked.

    A row is a fill: how often each length is in it. Beginnings that cannot be completed so well give no row.
    """
    capacity = len(best) - 1
    fills = np.zeros((len(first), len(lengths)), np.int32)
    fills[np.arange(len(first)), first] = 1
    room = capacity - lengths[first]
    spare = slack - (best[capacity] - worth[first] - best[room])
    row = np.flatnonzero(spare >= 0)
    room, spare, good = room[row], spare[row], row
    while len(row):
        after = room[:, None] - lengths
        loss = np.where(after >= 0, best[room][:, None] - worth - best[np.maximum(after, 0)], np.inf)
        fits = loss <= spare[:, None] + 1e-12
        go = fits.any(1)
        row, room, spare, loss, fits = row[go], room[go], spare[go], loss[go], fits[go]
        if len(row):
            chance = np.cumsum(fits * liked, 1)
            drawn = (chance <= (pick.random(len(row)) * chance[:, -1])[:, None]).sum(1)
            at = np.arange(len(row))
            fills[row, drawn] += 1
            spare, room = spare - loss[at, drawn], room - lengths[drawn]
    return fills[good]


def program(lengths: np.ndarray, need: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[np.ndarray, np.ndarray, float]], float]:
    """The configuration program: fills as lengths (by index), pieces of each, and uses; and a lower bound of all uses.

    Each round the knapsack prices fills, and those drawn among its near-best ones cover lengths by some share. Prices
    rise where that share stays short, by a length's part of all tokens, and fall where it is twice what is needed.
    Among fills worth alike, lengths are liked more the less they were covered. The solution is the mean of the later half.
    """
    pick = np.random.default_rng(1)  # the plan is the same in every run
    tokens = need * lengths
    part = tokens / tokens.sum()
    raised, lowered, liking, recent, lasting = (np.zeros(len(lengths)) for _ in range(5))
    recent += 1
    lasting += 1
    uses: dict[tuple[bytes, bytes], float] = {}
    bound, begin = 0.0, rounds // 2
    for r in range(rounds):
        worth = lengths * np.exp(raised + lowered)
        worth /= worth.max()
        best, _ = knapsack(lengths, worth, capacity)
        bound = max(bound, float(need @ worth / best[capacity]))
        liked = need * np.exp(liking)
        chance = np.cumsum(liked * lengths)
        first = np.searchsorted(chance, chance[-1] * (np.arange(LEADERS) + pick.random()) / LEADERS)
        fills = near_best(lengths, worth, best, np.minimum(first, len(lengths) - 1), SLACK * best[capacity], liked, pick)
        if not len(fills):
            one = priced(lengths, worth, capacity)
            fills = np.array([[one.get(int(k), 0) for k in lengths]], np.int32)
        each = tokens.sum() / (fills.sum(0) @ lengths)  # sequences that a drawn fill stands for
        share = fills.sum(0) * each / need
        recent = 0.9 * recent + 0.1 * share
        lasting = 0.97 * lasting + 0.03 * share
        short = np.sign(1 - recent) * np.maximum(np.abs(1 - recent) - 0.3, 0)
        raised += 4 / (r + 1) ** 0.5 * part * np.clip(short, -1, 1)
        lowered = np.where(lasting > 2, lowered - 0.2, np.where(lasting < 1, np.minimum(lowered + 0.2, 0), lowered))
        liking = np.clip(liking - 0.3 * np.clip(share - 1, -1, 4), -12, 12)
        if r >= begin:
            for fill in fills:
                at = np.flatnonzero(fill)
                key = (at.tobytes(), fill[at].tobytes())
                uses[key] = uses.get(key, 0.0) + each / (rounds - begin)
    return [(np.frombuffer(a, np.int64), np.frombuffer(n, np.int32).astype(np.int64), x) for (a, n), x in uses.items()], bound


def rounded(solution: list[tuple[np.ndarray, np.ndarray, float]], lengths: np.ndarray, left: np.ndarray) -> list[tuple[dict[int, int], int]]:
    """Whole uses of the solution's fills, taken off ``left``; fractions are carried on to the next fill, then fills are
    used once more, fullest first, while their pieces are there."""
    times: dict[int, int] = {}

    def use(i: int, wanted: int) -> None:
        at, n, _ = solution[i]
        able = min(wanted, int((left[at] // n).min()))
        if able > 0:
            times[i] = times.get(i, 0) + able
            left[at] -= n * able

    carry = 0.0
    for i in sorted(range(len(solution)), key=lambda i: -solution[i][2]):
        whole = int(solution[i][2] + carry)
        carry += solution[i][2] - whole
        use(i, whole)
    for i in sorted(range(len(solution)), key=lambda i: -int(lengths[solution[i][0]] @ solution[i][1])):
        use(i, 1)
    return [({int(k): int(n) for k, n in zip(lengths[solution[i][0]], solution[i][1])}, t) for i, t in times.items()]


def best_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Sequences filled from the longest piece that fits down, for pieces that the program has left."""
    left = dict(left)
    out: list[tuple[dict[int, int], int]] = []
    rest = sorted(k for k, n in left.items() if n > 0)
    while rest:
        fill, room = {}, capacity
        while True:
            i = bisect_right(rest, room) - 1
            while i >= 0 and fill.get(rest[i], 0) >= left[rest[i]]:
                i -= 1
            if i < 0:
                break
            n = min(room // rest[i], left[rest[i]] - fill.get(rest[i], 0))
            fill[rest[i]] = fill.get(rest[i], 0) + n
            room -= n * rest[i]
        times = min(left[k] // n for k, n in fill.items())
        out.append((fill, times))
        for k, n in fill.items():
            left[k] -= n * times
            if not left[k]:
                rest.remove(k)
    return out


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """Fills and how often to use each, so that every piece of the histogram has a place.

    The program is solved and rounded, then solved again over what rounding has left, while that places a tenth of it.
    """
    out = [({capacity: 1}, n) for k, n in histogram.items() if k == capacity and n > 0]  # no choice to be made
    left = {k: n for k, n in histogram.items() if n > 0 and k < capacity}
    for _ in range(PASSES):
        if not left:
            break
        lengths = np.array(sorted(left), np.int64)
        need = np.array([left[int(k)] for k in lengths], np.int64)
        solution, _ = program(lengths, need.astype(float), capacity, rounds)
        before = int(need.sum())
        out += rounded(solution, lengths, need)
        left = {int(k): int(n) for k, n in zip(lengths, need) if n}
        if before - int(need.sum()) < before // 10:
            break
    return out + best_fit(left, capacity)


def places(plans: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows of length, first rank, first sequence, pieces of the length in a sequence, offset there; sorted."""
    rows, seen, base = [], {}, 0
    for fill, times in plans:
        offset = 0
        for length in sorted(fill, reverse=True):
            rows.append((length, seen.get(length, 0), base, fill[length], offset))
            seen[length] = seen.get(length, 0) + fill[length] * times
            offset += length * fill[length]
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    spec: str,
    capacity: int = 4096,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there; ``spec`` is the tokenizer file's content.

    Null text is empty text: its document is the end id alone. Null ids and repeated rows are documents of their own;
    an empty table gives no rows. Other columns are neither read nor returned.
    """
    made = scratch.written(cut(docs, spec, capacity, end_id, doc_id, text, with_ids), "pieces")
    counts = made.groupBy("length", "part").agg(F.count("*").alias("n"))
    by_length = counts.groupBy("length").agg(F.sum("n").alias("n"))
    table = places(plan({r["length"]: r["n"] for r in by_length.collect()}, capacity))  # at most ``capacity`` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        key = (t[:, 0] << 44) + t[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = t[np.searchsorted(key, (length << 44) + rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            kept = [batch.column(c) for c in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "sequence_id", "offset"]
    ranked = made.join(before, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    fields = {f.name: f.dataType.simpleString() for f in made.schema} | {"sequence_id": "bigint", "offset": "bigint"}
    return ranked.mapInArrow(place, ", ".join(f"{n} {fields[n]}" for n in names))
