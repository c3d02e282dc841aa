"""Chat formatting of reply trees.

Messages form trees: each names the message it answers. The chosen leaves are followed to their roots by self-joins on
ancestors twice as far away at each round, so paths of any length take logarithmically many rounds and a conversation
of a third of all messages is spread like any other. Paths are formatted in segments of a bounded number of turns,
which are then put together; the text and its loss mask are what training reads.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import scratch

# The marks of the template, and strings that models take for marks.
OPEN, MIDDLE, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (OPEN, MIDDLE, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
SEGMENT = 64

_STARTS = "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL)


def escaped(text: Column) -> Column:
    """Without any control string: escapes are doubled, and one is put behind the first character of each control string."""
    doubled = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return F.regexp_replace(doubled, f"({_STARTS})", r"$1\\")


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a formatted conversation."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        role, _, text = piece.removeprefix(OPEN).partition(MIDDLE)
        turns.append((unescaped(role), unescaped(text)))
    return turns


def masked(formatted: str, spans: list[tuple[int, int]]) -> list[str]:
    """The texts under the loss mask, unescaped."""
    return [unescaped(formatted[a:b]) for a, b in spans]


def paths(messages: DataFrame, most: int = 1) -> DataFrame:
    """The chosen root-to-leaf paths: conv_id, path (0 is the best), message, depth from the leaf.

    ``messages`` has conv_id, message, parent (null or unknown: a root) and score. A path's score is the sum of its
    messages' scores; ties go to the longer path, then to the smaller leaf. Of several rows of one message the one with the
    smallest parent, then score, counts; a null message is one message that nothing answers. Where replies run in a circle,
    the smallest message of the circle is taken for a root, so every message stays on some path.
    """
    messages = messages.groupBy("conv_id", "message").agg(F.min(F.struct("parent", "score")).alias("first"))
    messages = scratch.written(messages.select("conv_id", "message", "first.parent", "first.score"), "tree")
    largest = messages.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    rounds = largest.bit_length()  # jumps of that many doublings are longer than any way to a root
    jumps, further = _jumps(messages, rounds)
    if not further.where("to IS NOT NULL").isEmpty():
        jumps, further = _jumps(_opened(messages, further, rounds), rounds)
    jump = jumps[0]
    total = further.select("conv_id", "message", "score")  # every way now ends at its root
    answered = jump.where("to IS NOT NULL").select("conv_id", F.col("to").alias("message")).distinct()
    is_answered = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.message") == F.col("r.message"))
    leaves = total.alias("l").join(answered.alias("r"), is_answered, "left_anti")
    rank = F.row_number().over(W.partitionBy("conv_id").orderBy(F.desc("score"), "message"))
    chosen = leaves.withColumn("path", rank - 1).where(F.col("path") < most)
    walk = chosen.select("conv_id", "path", "message", F.lit(0).cast("long").alias("up"))
    for k in reversed(range(len(jumps))):  # distances by their binary digits: each is reached once
        j = jumps[k].where("to IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("message").alias("via"), "to")
        met = walk.join(j, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("message") == F.col("via")))
        walk = scratch.written(
            walk.unionByName(met.select("conv_id", "path", F.col("to").alias("message"), (F.col("up") + (1 << k)).alias("up"))), "walk"
        )
    return walk


def _jumps(messages: DataFrame, rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """Who stands 1, 2, 4, ... messages above each, with the score on the way; last, where each ends and its whole score.

    A message that has reached its root is not joined again, so a few long conversations do not drag the others through
    their rounds. Without circles the last has no targets; with them it has some even after ``rounds`` doublings.
    """
    up = messages.alias("m").join(
        messages.select(F.col("conv_id").alias("c"), F.col("message").alias("p")),
        F.col("m.conv_id").eqNullSafe(F.col("c")) & (F.col("m.parent") == F.col("p")),
        "left",
    )
    score = F.coalesce("score", F.lit(0.0)).cast("double")
    links = scratch.written(up.select("conv_id", "message", F.col("p").alias("to"), score.alias("score")), "links")
    jumps, running, ended = [links], links.where("to IS NOT NULL"), links.where("to IS NULL")
    while len(jumps) <= rounds and not running.isEmpty():
        b = running.unionByName(ended).select(
            F.col("conv_id").alias("c"), F.col("message").alias("via"), F.col("to").alias("next"), F.col("score").alias("more")
        )
        joined = running.join(b, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("to") == F.col("via")))
        further = joined.select("conv_id", "message", F.col("next").alias("to"), (F.col("score") + F.col("more")).alias("score"))
        further = scratch.written(further, "jumps")
        ended = ended.unionByName(further.where("to IS NULL"))
        running = further.where("to IS NOT NULL")
        jumps.append(further)
    return jumps, running.unionByName(ended)


def _opened(messages: DataFrame, further: DataFrame, rounds: int) -> DataFrame:
    """The messages with one root in each circle: the smallest message there answers nothing.

    After jumps longer than any way, everything that leads into a circle stands on it, so the targets are the circles'
    members. Their least message is found by doubling too.
    """
    on = further.where("to IS NOT NULL").select(F.col("conv_id").alias("c"), F.col("to").alias("t")).distinct()
    member = F.col("m.conv_id").eqNullSafe(F.col("o.c")) & (F.col("m.message") == F.col("o.t"))
    ring = messages.alias("m").join(on.alias("o"), member, "left_semi")
    ring = scratch.written(ring.select("conv_id", "message", F.col("parent").alias("to"), F.col("message").alias("least")), "circles")
    for _ in range(rounds):
        b = ring.select(F.col("conv_id").alias("c"), F.col("message").alias("via"), F.col("to").alias("next"), F.col("least").alias("other"))
        met = ring.join(b, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("to") == F.col("via")))
        ring = scratch.written(met.select("conv_id", "message", F.col("next").alias("to"), F.least("least", "other").alias("least")), "circles")
    roots = ring.where("message = least").select(F.col("conv_id").alias("c"), F.col("message").alias("root"))
    opened = messages.join(roots, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("message") == F.col("root")), "left")
    return opened.select("conv_id", "message", F.when(F.col("root").isNull(), F.col("parent")).alias("parent"), "score")


def formatted(turns: DataFrame) -> DataFrame:
    """One row for each path: its text and the spans, in code points, of what the assistant says.

    ``turns`` has conv_id, path, up (distance from the leaf), role and text; null roles and texts are empty.
    """
    by_path = ["conv_id", "path"]
    far = turns.groupBy(*by_path).agg(F.max("up").alias("far"))
    same = F.col("t.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("t.path") == F.col("f.path"))
    placed = turns.alias("t").join(far.alias("f"), same).select("t.*", (F.col("f.far") - F.col("t.up")).alias("at"))
    role, text = escaped(F.coalesce("role", F.lit(""))), escaped(F.coalesce("text", F.lit("")))
    lines = placed.select(
        *by_path,
        "at",
        F.floor(F.col("at") / SEGMENT).alias("segment"),
        F.concat(F.lit(OPEN), role, F.lit(MIDDLE)).alias("head"),
        text.alias("body"),
        (F.coalesce("role", F.lit("")) == "assistant").alias("loss"),
    )
    segments = lines.groupBy(*by_path, "segment").agg(F.array_sort(F.collect_list(F.struct("at", "head", "body", "loss"))).alias("lines"))
    size = lambda x: F.length(x["head"]) + F.length(x["body"]) + len(CLOSE)
    segments = segments.withColumn("sizes", F.transform("lines", size))

    def span(x: Column, i: Column) -> Column:
        start = F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0), lambda s, n: s + n) + F.length(x["head"])
        return F.when(x["loss"], F.struct(start.alias("start"), (start + F.length(x["body"])).alias("end")))

    parts = segments.select(
        *by_path,
        "segment",
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "").alias("text"),
        F.filter(F.transform("lines", span), lambda s: s.isNotNull()).alias("spans"),
        F.aggregate("sizes", F.lit(0).cast("long"), lambda s, n: s + n).alias("size"),
    )
    earlier = W.partitionBy(*by_path).orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    moved = parts.withColumn("base", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    spans = F.transform("spans", lambda s: F.struct((s["start"] + F.col("base")).alias("start"), (s["end"] + F.col("base")).alias("end")))
    whole = moved.groupBy(*by_path).agg(F.array_sort(F.collect_list(F.struct("segment", "text", spans.alias("spans")))).alias("parts"))
    return whole.select(
        *by_path,
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.flatten(F.transform("parts", lambda p: p["spans"])).alias("loss_spans"),
    )


def chain(rows: DataFrame) -> DataFrame:
    """Conversations kept by turn as trees without branches: each message answers the one before it.

    Rows are numbered over a range partitioning by conversation and turn, from their place in the partition and the rows
    of the conversation in earlier ones, so that no conversation is sorted in one task. Rows of one turn are ordered by
    role and text.
    """
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ranged = rows.select("conv_id", "turn", "role", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = scratch.written(ranged.withColumn("place", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("place", 33)
    counts = fixed.groupBy("conv_id", part.alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")
    )
    numbered = fixed.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (part == F.col("p")))
    message = F.col("place") + F.col("shift")
    parent = F.when(message > 0, message - 1)
    return numbered.select("conv_id", message.alias("message"), parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def format_trees(messages: DataFrame, most: int = 1) -> DataFrame:
    """The best paths of every tree, formatted; ``messages`` as for ``paths``, with role and text.

    Null texts and roles are empty; a null conv_id is a conversation of its own; an empty table gives no rows; repeated
    messages and circles are treated as in ``paths``; other columns are not read.
    """
    kept = scratch.written(messages.select("conv_id", "message", "parent", "score", "role", "text"), "messages")
    said = kept.groupBy("conv_id", "message").agg(F.min(F.struct("parent", "score", "role", "text")).alias("first"))
    said = said.select("conv_id", "message", "first.role", "first.text")
    walk = paths(kept.select("conv_id", "message", "parent", "score"), most)
    same = F.col("w.conv_id").eqNullSafe(F.col("m.conv_id")) & F.col("w.message").eqNullSafe(F.col("m.message"))
    turns = walk.alias("w").join(said.alias("m"), same).select("w.conv_id", "path", "up", "role", "text")
    return formatted(turns)
