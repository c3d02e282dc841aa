"""Near-duplicates by order MinHash, with candidates verified by banded alignment.

A text is the sequence of its runs of five words, each labelled with how often the run stood before, so labels are
unique in it. A sketch takes, for each of several hash functions, the few labels with the smallest values and keeps
them in text order; texts agree on it the more, the more runs they share in the same order. Texts that agree on one are
candidates. Two texts are near-duplicates if at least 0.8 of their runs align: the runs in common that lie in one order
within the band that 0.8 allows, over all runs of both. As labels are unique, the longest alignment is a longest
increasing run of places. At a similarity of 0.8 a pair misses all 24 sketches of four with a chance below 5 in a million
if the longer text has 60 runs or more. Shorter texts miss them more often, so they also have as keys the smallest of their
runs, so many that texts that share 0.8 of their runs share one of these (a prefix filter): of such pairs none is missed.

Copies count once. In a bucket every text is first compared with the bucket's earliest text, one comparison for each
text. Buckets whose texts are then still of several classes are dealt out in pairs of blocks of bounded size; a task
counts the common runs of all texts of such a pair by one sparse product and aligns those that may link two classes. A
text travels once for each block it meets, not for each text. No bucket is cut or sampled.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import scratch, streams
from tidemark.llm.components import components
from tidemark.llm.streams import U

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 24
SAMPLED = 4
MEMBERS = 64  # texts compared with one leader in one group of rows
BLOCK = 512  # texts of one bucket that are compared among themselves, or with another such block, in one group of rows
COLUMNS = 4096  # runs counted at a time
SHORT = 75  # texts of up to so many runs have prefix keys: those like a text of up to 60 runs
LAST = (1 << 63) - 1

_SEEDS = streams.mix(np.arange(1, SKETCHES + 1, dtype=U) * U(streams.WORD_BASE)) | U(1)


def labels(hashes: np.ndarray) -> np.ndarray:
    """Runs of words, labelled by occurrence; a text of fewer words than a run is one run."""
    if not len(hashes):
        return hashes
    size = min(SHINGLE, len(hashes))
    at = np.arange(len(hashes) - size + 1)
    runs = streams.mix(streams.span_sums(hashes, streams.WORD_BASE, at, at + size) + U(size))
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    if fresh.all():
        return runs
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(runs)), 0))
    nth = np.empty(len(runs), U)
    nth[order] = (np.arange(len(runs)) - first).astype(U)
    return streams.mix(runs + nth * U(streams.BYTE_BASE))


def sketch(own: np.ndarray) -> np.ndarray:
    """One number for each hash function: its smallest labels in the order of the text."""
    values = own[:, None] * _SEEDS[None, :]
    columns = np.arange(SKETCHES)
    picked = []
    for _ in range(min(SAMPLED, len(own))):
        least = values.argmin(0)
        picked.append(least)
        values[least, columns] = np.iinfo(np.uint64).max
    places = np.sort(np.array(picked), axis=0)
    out = columns.astype(U)
    for row in places:
        out = streams.mix(out * U(streams.WORD_BASE) + own[row])
    return out


def prefix(own: np.ndarray) -> np.ndarray:
    """The smallest labels of a short text: one of them at least is among those of any text that is like it."""
    n = len(own) if len(own) <= SHORT else 0
    return np.sort(own)[: n - math.ceil(SIMILARITY * n - 1e-9) + 1] if n else own[:0]


def aligned(a: np.ndarray, b: np.ndarray, at_least: float = SIMILARITY) -> float:
    """Share of the runs of two texts that align, or 0 if it is below ``at_least``."""
    total = len(a) + len(b)
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(in_a) < at_least * (total - len(in_a)):
        return 0.0
    place = in_b[np.argsort(in_a)]
    where = np.sort(in_a)
    # Insertions or deletions before a run that the similarity allows; rounding must not lose a pair at the threshold.
    band = int(total * (1 - at_least) / (1 + at_least) + 1e-9 * total + 1e-9)
    place = place[np.abs(place - where) <= band]
    if len(place) > 1 and (np.diff(place) <= 0).any():
        tails: list[int] = []
        for p in place.tolist():
            i = bisect_left(tails, p)
            tails[i : i + 1] = [p]
        n = len(tails)
    else:
        n = len(place)
    share = n / max(total - n, 1)
    return share if share >= at_least else 0.0


def _node(text: str) -> Column:
    """128 bits that tell texts apart; null is empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _order(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def sketches(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """For each row its id, text node and sketches; texts without words have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            found, sizes = [], []
            for row in range(part.num_rows):
                own = labels(words.hashes[words.bounds[row] : words.bounds[row + 1]])
                found.append(streams.signed(np.concatenate([sketch(own), prefix(own)])) if len(own) else None)
                sizes.append(len(own))
            columns = [part.column("doc"), part.column("node"), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "node", "n", "keys"])

    rows = docs.select(_order(doc_id).alias("doc"), _node(text).alias("node"), F.col(text).alias("text"))
    return rows.mapInArrow(work, "doc long, node binary, n int, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose texts align; ``texts`` has a row or more for each node.

    A leader's text goes once to each group of at most about ``MEMBERS`` partners; a task holds one leader at a time.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("groups"))
    spread = pairs.join(groups, "a").withColumn("part", F.pmod(F.xxhash64("b"), "groups").cast("int"))
    lead = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    nobody = F.lit(None).cast("binary")
    led = lead.hint("merge").join(texts, lead["a"] == texts["node"]).select("a", "part", nobody.alias("b"), "text")
    members = spread.hint("merge").join(texts, spread["b"] == texts["node"]).select("a", "part", "b", "text")
    rows = led.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            out = []
            for row in range(part.num_rows):
                these = labels(words.hashes[words.bounds[row] : words.bounds[row + 1]])
                if b[row] is None:
                    leader, own = a[row], these
                elif leader == a[row] and aligned(own, these):
                    out.append((a[row], b[row]))
            columns = [pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return rows.mapInArrow(work, "a binary, b binary").distinct()


def common(texts: list[np.ndarray]) -> np.ndarray:
    """How many labels each two of the texts share."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    _, which, often = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    shared = often[which] > 1
    owner, which = owner[shared], which[shared]
    column = np.unique(which, return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(texts), len(texts)), np.float32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(texts), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held @ held.T
    return out


def links(nodes: list[bytes], roots: list[bytes], texts: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """Pairs of aligned texts that join the classes of the group; once two classes are joined, no more pairs of them."""
    parent = {r: r for r in roots}

    def top(r: bytes) -> bytes:
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    sizes = np.array([len(t) for t in texts], np.float32)
    met = common(texts)
    number = np.unique(np.array(roots, dtype=object), return_inverse=True)[1]
    likely = (met >= SIMILARITY * (sizes[:, None] + sizes[None, :] - met)) & (number[:, None] < number[None, :])
    out = []
    for i, j in np.argwhere(likely).tolist():
        a, b = top(roots[i]), top(roots[j])
        if a != b and aligned(texts[i], texts[j]):
            parent[max(a, b)] = min(a, b)
            out.append((nodes[i], nodes[j]))
    return out


def block_links(open_: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between texts of one bucket and different classes; ``open_`` has band, key, node and root."""
    bucket = ["band", "key"]
    blocks = open_.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    spread = open_.join(blocks, bucket).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = [*bucket, "low", "high"]
    placed = spread.select(*bucket, F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "node", "root")
    rows = placed.hint("merge").join(texts, "node").repartition(*group).sortWithinPartitions(*group)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, roots, own = None, [], [], []

        def found() -> pa.RecordBatch:
            out = links(nodes, roots, own) if len(set(roots)) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

        for part in streams.pieces(batches, "text"):
            words = streams.Words(part.column("text"))
            keys = list(zip(*(part.column(c).to_pylist() for c in group)))
            node, root = part.column("node").to_pylist(), part.column("root").to_pylist()
            for i, key in enumerate(keys):
                if key != current:
                    if nodes:
                        yield found()
                    current, nodes, roots, own = key, [], [], []
                nodes.append(node[i])
                roots.append(root[i])
                own.append(labels(words.hashes[words.bounds[i] : words.bounds[i + 1]]))
        if nodes:
            yield found()

    columns = [*group, "node", "root", "text"]
    return rows.select(*columns).mapInArrow(work, "a binary, b binary").distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For every distinct text its node, its earliest document, its class and the node that stands for the class.

    The class is the smallest id of a document in it, null only where no document of it has an id.
    """
    made = scratch.written(sketches(docs, doc_id, text), "sketches")
    nodes = scratch.written(
        made.groupBy("node").agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("keys").alias("keys")), "nodes"
    )
    places = nodes.where("keys IS NOT NULL").select("node", "doc", "n", F.posexplode("keys").alias("band", "key"))
    places = places.withColumn("band", F.least("band", F.lit(SKETCHES)))  # prefix keys meet whatever their places
    bucket = ["band", "key"]
    size = places.groupBy(*bucket).agg(F.min(F.struct("doc", "node")).alias("lead"), F.count("*").alias("members"))
    shared = scratch.written(places.join(size.where("members > 1"), bucket), "buckets")
    stars = (
        shared.where(F.col("lead.node") != F.col("node"))
        .groupBy("node")
        .agg(F.min("lead").alias("lead"))
        .select(F.col("lead.node").alias("a"), F.col("node").alias("b"))
    )
    needed = shared.select("node", "doc").distinct()
    keyed = docs.select(_order(doc_id).alias("doc"), _node(text).alias("node"), F.col(text).alias("text"))
    texts = scratch.written(keyed.join(needed.hint("merge"), ["doc", "node"], "left_semi").select("node", "text"), "texts")
    first = scratch.written(verified(stars, texts), "links")
    roots = components(first)
    rest = scratch.written(
        shared.select(*bucket, "node")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node")),
        "rest",
    )
    mixed = rest.groupBy(*bucket).agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    open_ = rest.join(mixed.select(*bucket), bucket).select(*bucket, "node", "root")
    second = scratch.written(block_links(open_, texts), "links")
    final = components(roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(second))
    labelled = nodes.select("node", "doc").join(final, "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = scratch.written(labelled, "labelled")
    lead = labelled.groupBy("root").agg(F.min(F.struct("doc", "node")).alias("lead"))
    return labelled.join(lead, "root").select(
        "node", "doc", F.when(F.col("lead.doc") < LAST, F.col("lead.doc")).alias("class_id"), F.col("lead.node").alias("stands")
    )


def class_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its class; a document that is like no other is a class of its own.

    Null text is empty text, and empty texts are copies of each other. Null ids come last in order. Repeated rows are
    copies. An empty table gives no rows; other columns are neither read nor returned.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), _node(text).alias("node"))
    return rows.join(classes(docs, doc_id, text).select("node", "class_id"), "node").drop("node")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stand for their classes, one row each, with all their columns."""
    kept = classes(docs, doc_id, text).where("node = stands").select(F.col("node").alias("_node"), F.col("doc").alias("_doc"))
    rows = docs.withColumn("_node", _node(text)).withColumn("_doc", _order(doc_id)).join(kept, ["_doc", "_node"], "left_semi")
    once = Window.partitionBy("_doc", "_node").orderBy(F.lit(0))  # rows alike in id and text
    return rows.withColumn("_nth", F.row_number().over(once)).where("_nth = 1").drop("_nth", "_node", "_doc")
