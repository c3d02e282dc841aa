"""Benchmark decontamination by a positional inverted index of the training texts.

The index holds, for each term that test windows need, the places where it stands: (term, text, position). For every
window of test words its rarest terms in the corpus are chosen; their posting lists, each moved back by the term's
offset in the window, are intersected, exactly or up to a slop. What is left are phrases or near phrases, and both are
compared word by word with the text before they count: a phrase has all words of its window in their places, a near match
most of them, each at most the slop away from its place. Rarest terms are few, so the index that is stored stays small
beside the corpus.

Texts are told apart by 128 bits of hash of the whole text, so copies share postings and one text's rows need no id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams

WINDOW = 10
RAREST = 2
NEAR_RAREST = 4  # of a window of ten, two words of which may be missing, two of the four are there
SLOP = 2  # words by which a word of a near match may stand off its place
NEAR = 0.8  # share of a window's words that a near match has
BLOCK_CHOSEN = 1_000_000  # chosen words looked up in one pass over the index: at most 40 MB sent to an executor
ROWS = 1 << 21  # postings moved to items at once
CANDIDATES = 50_000  # verified at once
BLOCK_TERMS = 2_000_000  # terms looked up in one pass over the corpus: at most 16 MB sent to an executor

RESULTS = {
    "n_words": "long",
    "n_hit": "long",
    "n_items": "long",
    "items_sha256": "string",
    "contaminated": "boolean",
    "n_near": "long",
    "n_near_items": "long",
    "items": "array<string>",
    "near_items": "array<string>",
    "spans": "array<struct<start:int,end:int>>",
}

# Words are runs of letters, digits and all characters beyond ASCII; only A-Z are lowered.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_FOLDED = bytes(0x20 if SEPARATOR[FOLD[b]] else int(FOLD[b]) for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLDED).split()


def keyed(df: DataFrame, text: str = "text") -> DataFrame:
    """With the 128 bits that tell texts apart; null is empty text."""
    content = F.coalesce(F.col(text), F.lit(""))
    return df.withColumn("k1", F.xxhash64(content)).withColumn("k2", F.xxhash64(F.lit(1), content))


def test_items(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Every item that has words: a number, its id as text, its words and the hashes of its terms.

    Items without an id have the empty id. Rows are numbered as they are written, so the numbers stay.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in streams.pieces(batches, "text"):
            words = streams.Words(batch.column("text"), SEPARATOR, FOLD)
            own = [
                [words.raw[a:b].tobytes().decode() for a, b in zip(words.starts[lo:hi], words.ends[lo:hi])]
                for lo, hi in zip(words.bounds, words.bounds[1:])
            ]
            terms = [streams.signed(words.hashes[lo:hi].copy()) for lo, hi in zip(words.bounds, words.bounds[1:])]
            columns = [batch.column("id"), pa.array(own, pa.list_(pa.string())), pa.array(terms, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "words", "terms"])

    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    found = rows.mapInArrow(work, "id string, words array<string>, terms array<long>").where(F.size("words") > 0)
    return scratch.written(found.withColumn("item", F.monotonically_increasing_id()), "items")


def _blocks(docs: DataFrame, terms: list[int]) -> Iterator:
    for at in range(0, max(len(terms), 1), BLOCK_TERMS):
        yield docs.sparkSession.sparkContext.broadcast(np.sort(np.array(terms[at : at + BLOCK_TERMS], np.int64)))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def term_counts(docs: DataFrame, terms: list[int], text: str = "text") -> DataFrame:
    """How often each of the terms stands in the corpus."""

    def counted(shared) -> DataFrame:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            wanted = shared.value
            counts = np.zeros(len(wanted), np.int64)
            for part in streams.pieces(batches, "text"):
                words = streams.Words(part.column("text"), SEPARATOR, FOLD)
                hashes = streams.signed(words.hashes)
                at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
                hit = np.flatnonzero(wanted[at] == hashes) if len(wanted) else np.zeros(0, np.int64)
                counts += np.bincount(at[hit], minlength=len(wanted))
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(wanted[seen]), pa.array(counts[seen])], ["term", "n"])

        return docs.select(F.col(text).alias("text")).mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))

    return _union([counted(shared) for shared in _blocks(docs, terms)])


def index(docs: DataFrame, terms: list[int] | np.ndarray, text: str = "text") -> DataFrame:
    """The stored index, in segments: the texts of a slice of the corpus and the postings of the terms there, by term.

    All postings of a text lie in one segment, so lists are intersected where they are stored. The terms are sent to all
    tasks: ``hits`` gives those of a block of items.
    """
    shared = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(terms, np.int64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"), SEPARATOR, FOLD)
            hashes = streams.signed(words.hashes)
            at = np.minimum(np.searchsorted(wanted, hashes), max(len(wanted) - 1, 0))
            hit = np.flatnonzero(wanted[at] == hashes) if len(wanted) else np.zeros(0, np.int64)
            hit = hit[np.argsort(at[hit], kind="stable")]
            row = words.rows()[hit]
            lists = [part.column(c).to_numpy() for c in ("k1", "k2")]
            lists += [hashes[hit], row.astype(np.int32), (hit - words.bounds[row]).astype(np.int32)]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists]
            yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "term", "text", "position"])

    rows = keyed(docs.select(F.col(text).alias("text"))).select("k1", "k2", "text")
    schema = "k1 array<long>, k2 array<long>, term array<long>, text array<int>, position array<int>"
    return scratch.written(rows.mapInArrow(work, schema), "postings")


def rarest(items: DataFrame, counts: DataFrame, size: int = WINDOW, most: int = RAREST, share: float = 1.0) -> DataFrame:
    """The chosen words of every window with enough terms in the corpus: item, offset of the window, place, term, rank.

    A window is ``size`` words of an item, or the whole item if it has fewer. A match has ``share`` of its words at least;
    ``met`` is how many of the chosen ones are then among them.
    """
    place = items.select("item", F.size("terms").alias("n"), F.posexplode("terms").alias("place", "term"))
    last = F.greatest(F.col("n") - size, F.lit(0))
    first = F.greatest(F.col("place") - size + 1, F.lit(0))
    in_window = place.withColumn("offset", F.explode(F.sequence(first, F.least(F.col("place"), last))))
    known = in_window.join(counts.withColumnRenamed("n", "often"), "term")
    whole = Window.partitionBy("item", "offset")
    ranked = known.withColumn("known", F.count("*").over(whole)).withColumn(
        "rank", F.row_number().over(whole.orderBy("often", "place"))
    )
    words = F.least("n", F.lit(size))
    least = F.ceil(words * F.lit(share) - 1e-9)
    kept = ranked.where((F.col("known") >= least) & (F.col("rank") <= most))
    met = F.greatest(F.least("known", F.lit(most)) - (words - least), F.lit(1)).cast("int").alias("met")
    return kept.select("item", "offset", "place", "term", "rank", met)


def phrase_candidates(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """Where the posting lists of a window's chosen terms, moved back by their places, meet: text, item, offset, start."""
    return proximity_matches(postings, chosen, 0)


def proximity_matches(postings: DataFrame, chosen: DataFrame, slop: int) -> DataFrame:
    """Where the moved lists of a window's chosen terms come within ``slop`` words of one of them: text, item, offset, start.

    As many of them meet as a match must have. The chosen words are sent to all tasks: ``hits`` gives those of a block of items.
    """
    names = ["item", "offset", "place", "term", "met"]
    own = chosen.select(*names).toArrow()
    shared = postings.sparkSession.sparkContext.broadcast([own.column(c).to_numpy().astype(np.int64) for c in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(*shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                k1, k2, *lists = (batch.column(c)[i].values.to_numpy() for c in ("k1", "k2", "term", "text", "position"))
                for text, item, offset, start in windows.meetings(*lists, slop):
                    columns = [pa.array(k1[text]), pa.array(k2[text]), *(pa.array(x) for x in (item, offset, start))]
                    yield pa.RecordBatch.from_arrays(columns, ["k1", "k2", "item", "offset", "start"])

    return postings.mapInArrow(work, "k1 long, k2 long, item long, offset long, start long")


def _meetings(docs: DataFrame, chosen: DataFrame, slop: int, text: str) -> DataFrame:
    """The matches of all items: for each block of them an index of its terms and one pass over that."""
    blocks = max(1, -(-chosen.count() // BLOCK_CHOSEN))
    parts = []
    for b in range(blocks):
        own = chosen.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        needed = own.select("term").distinct().toArrow().column(0).to_numpy()
        parts.append(proximity_matches(index(docs, needed, text), own, slop))
    return _union(parts)


def _expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges the number of the range and the place of each of their members."""
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    return which, lo[which] + np.arange(len(which)) - (np.cumsum(n) - n)[which]


class Windows:
    """Chosen words of windows, by term and by the item and place that windows share."""

    def __init__(self, item: np.ndarray, offset: np.ndarray, place: np.ndarray, term: np.ndarray, met: np.ndarray) -> None:
        self.items, number = np.unique(item, return_inverse=True)
        order = np.lexsort((offset, place, number))
        self.number, self.place, self.offset, self.met = number[order], place[order], offset[order], met[order]
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(self.number) != 0) | (np.diff(self.place) != 0)
        self.first = np.append(np.flatnonzero(first), len(order))  # of the windows that chose a place of an item
        spot = np.argsort(term[order][self.first[:-1]], kind="stable")
        self.spot, self.term = spot, term[order][self.first[:-1]][spot]
        self.least = np.full(len(self.items), 1 << 30)
        np.minimum.at(self.least, self.number, self.met)

    def meetings(self, term: np.ndarray, text: np.ndarray, position: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Text, item, offset and start of windows that a segment's postings meet, for some texts at a time."""
        order = np.argsort(text, kind="stable")
        term, text, position = term[order], text[order].astype(np.int64), position[order].astype(np.int64)
        lo, hi = np.searchsorted(self.term, term), np.searchsorted(self.term, term, "right")
        ends = np.flatnonzero(np.diff(text, append=-1)) + 1
        size = np.cumsum(hi - lo)
        a = 0
        while a < len(term):
            done = size[a - 1] if a else 0
            k = np.searchsorted(size[ends - 1], done + ROWS, "right")
            b = int(ends[min(max(k, np.searchsorted(ends, a, "right") + 1), len(ends)) - 1])
            own, at = _expand(lo[a:b], hi[a:b])
            spot = self.spot[at]
            where = self.first[spot]
            diagonal = position[a:b][own] - self.place[where]
            yield from self._of(text[a:b][own], spot, diagonal, slop)
            a = b

    def _of(self, text: np.ndarray, spot: np.ndarray, diagonal: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, ...]]:
        item = self.number[self.first[spot]]
        order = np.lexsort((diagonal, item, text))
        text, item, spot, diagonal = text[order], item[order], spot[order], diagonal[order]
        close = np.zeros(len(text), bool)  # to the posting before it on the diagonals of its text and item
        close[1:] = (np.diff(text) == 0) & (np.diff(item) == 0) & (np.diff(diagonal) <= slop)
        kept = np.flatnonzero(close | np.append(close[1:], False) | (self.least[item] <= 1))
        own, at = _expand(self.first[spot[kept]], self.first[spot[kept] + 1])
        text, item, start = text[kept][own], item[kept][own], diagonal[kept][own] + self.offset[at]
        offset, met = self.offset[at], self.met[at]
        order = np.lexsort((start, offset, item, text))
        text, item, offset, start, met = (x[order] for x in (text, item, offset, start, met))
        new = np.ones(len(text), bool)
        new[1:] = (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(offset) != 0)
        if not len(text):
            return
        apart = int(start.max() - start.min()) + 2 * slop + 2
        line = (np.cumsum(new) - 1) * apart + (start - start.min())  # starts of one text and window, far from all others
        near = np.searchsorted(line, line + slop, "right") - np.searchsorted(line, line - slop)
        once = np.append(True, np.diff(line) != 0)
        hit = np.flatnonzero((near >= met) & once)
        if len(hit):
            yield text[hit], self.items[item[hit]], offset[hit], start[hit]


def _verified(words: streams.Words, row: np.ndarray, start: np.ndarray, phrases: pa.Array, slop: int):
    """Places where candidates hold: candidate, first word in the batch, number of words, and whether it is the phrase itself."""
    test = streams.Words(phrases, SEPARATOR)
    size = test.counts
    for a in range(0, len(row), CANDIDATES):
        c = np.arange(a, min(a + CANDIDATES, len(row)))
        place = np.arange(int(size[c].max(initial=0)))
        real = place < size[c, None]
        term = test.hashes[np.where(real, test.bounds[c, None] + place, 0)]
        lo, hi = words.bounds[row[c]], words.bounds[row[c] + 1]
        begin = lo + start[c]
        found = np.zeros(real.shape, bool)
        for off in [0, *(d for k in range(1, slop + 1) for d in (-k, k))]:
            at = begin[:, None] + place + off
            inside = real & (at >= lo[:, None]) & (at < hi[:, None])
            found |= inside & (words.hashes[np.where(inside, at, 0)] == term)
            if off == 0:
                same = (found | ~real).all(1)
        near = (found.sum(1) >= np.ceil(size[c] * NEAR - 1e-9)) & (slop > 0)
        for k in np.flatnonzero(same | near).tolist():
            i, b = int(c[k]), int(begin[k])
            spans = zip(words.starts[b : b + size[i]], words.ends[b : b + size[i]]) if same[k] else ()
            exact = bool(same[k]) and b" ".join(words.raw[x:y].tobytes() for x, y in spans) == phrases[i].as_py().encode()
            if exact or near[k]:
                yield i, b, int(size[i]), exact


def hits(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    size: int = WINDOW,
    carry: tuple[str, ...] = (),
    slop: int = 0,
) -> DataFrame:
    """For every document its words, the spans of words that test windows cover, and the items they come from.

    The same for near matches, which the phrases are among: one of the four rarest words of a window that the corpus knows
    stands in its place, and at least 0.8 of all words of the window stand at most ``slop`` words off theirs. None of them
    is missed, as two of the four are then there. Without slop there are none but the phrases. ``contaminated`` heeds
    phrases alone.

    Null text has no words; null ids and repeated rows are documents of their own; an empty table on either side gives
    no hits. Columns that ``carry`` does not name are not read; a carried column must not have the name of a result.
    """
    known = test_items(items, item_id, text)
    terms = known.select(F.explode("terms").alias("term")).distinct()
    counts = term_counts(docs, [r[0] for r in terms.toLocalIterator()], text)
    sought = rarest(known, counts, size, NEAR_RAREST, NEAR) if slop else rarest(known, counts, size)
    chosen = scratch.written(sought, "chosen")
    found = _meetings(docs, chosen, slop, text).join(known.select("item", "id", "words"), "item")
    phrase = F.array_join(F.slice("words", F.col("offset") + 1, F.lit(size)), " ")
    phrases = found.select("k1", "k2", "start", phrase.alias("phrase"), "id")
    # A phrase is one candidate however many items it stands in.
    phrases = phrases.groupBy("k1", "k2", "start", "phrase").agg(F.collect_set("id").alias("ids"))
    by_text = scratch.written(
        phrases.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "phrase", "ids")).alias("candidates")), "candidates"
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), *carry, F.col(text).alias("_text"))
    # One way at every size: few candidates would be sent to all tasks, many would not, and the cost would jump between.
    joined = keyed(rows, "_text").join(by_text.hint("merge"), ["k1", "k2"], "left").drop("k1", "k2")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "_text"):
            words = streams.Words(part.column("_text"), SEPARATOR, FOLD)
            n = part.num_rows
            candidates = part.column("candidates")
            row = pc.list_parent_indices(candidates).to_numpy()
            each = candidates.flatten()
            start, phrase, ids = (pc.struct_field(each, f) for f in ("start", "phrase", "ids"))
            from_, to, exact, of = [], [], [], []
            named: list[tuple[set, set]] = [(set(), set()) for _ in range(n)]
            for i, at, length, same in _verified(words, row, start.to_numpy(), phrase, slop):
                from_.append(at)
                to.append(at + length)
                exact.append(same)
                of.append(int(row[i]))
                for kind in (0, 1) if same else (1,):
                    named[of[-1]][kind].update(ids[i].as_py())
            from_, to, exact, of = np.array(from_, np.int64), np.array(to, np.int64), np.array(exact, bool), np.array(of, np.int64)
            to = np.minimum(to, words.bounds[of + 1])  # the end of a near match may stand in words that the text lacks
            from_ = np.maximum(from_, words.bounds[of])
            covered = streams.cover(from_[exact], to[exact], len(words.starts))
            near = streams.cover(from_, to, len(words.starts))
            hit, n_near = (streams.per_row(x.astype(np.int64), words.bounds) for x in (covered, near))
            spans: list[list] = [[] for _ in range(n)]
            for r in np.flatnonzero(hit).tolist():
                edge = np.flatnonzero(np.diff(covered[words.bounds[r] : words.bounds[r + 1]].astype(np.int8), prepend=0, append=0))
                spans[r] = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]
            sorted_ = [[sorted(x, key=lambda s: s.encode()) for x in both] for both in named]
            digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x, _ in sorted_]
            kept = [part.column(c) for c in ("doc_id", *carry)]
            yield pa.RecordBatch.from_arrays(
                [
                    *kept,
                    pa.array(words.counts.astype(np.int64)),
                    pa.array(hit),
                    pa.array([len(x) for x, _ in sorted_], pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(hit > 0),
                    pa.array(n_near),
                    pa.array([len(x) for _, x in sorted_], pa.int64()),
                    pa.array([x for x, _ in sorted_], pa.list_(pa.string())),
                    pa.array([x for _, x in sorted_], pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["doc_id", *carry, *RESULTS],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return joined.mapInArrow(work, schema + "".join(f", {name} {kind}" for name, kind in RESULTS.items()))
