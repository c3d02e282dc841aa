"""The write modes as plain functions of DataFrames: ``mode(target, source) -> new target``.

``source`` is aligned to ``target``. Nothing here writes; the table store publishes the same results without
rewriting what a load does not touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import quoted
from tidemark.operators.chunks import chunk_index
from tidemark.operators.matching import all_present, key_counts, match, row_columns, usable_keys


def initial(target: DataFrame, source: DataFrame) -> DataFrame:
    """Everything there was plus everything read."""
    return target.unionByName(source)


append = initial


def full(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source alone; an empty source leaves the target as it was."""
    return target if source.isEmpty() else source


def merge(
    target: DataFrame, source: DataFrame, pk: Sequence[str], *, hot: Sequence[int] = (), small: bool = False
) -> DataFrame:
    """Target rows whose key the source lacks, plus all of the source.

    Copies of a key inside the source all stay, and a key with a NULL part matches nothing.
    """
    kept = match(target, usable_keys(source, pk, small), pk, "left_anti", hot=hot, small=small)
    return kept.unionByName(source)


def merge_counts(target: DataFrame, source: DataFrame, pk: Sequence[str], *, small: bool = False) -> DataFrame:
    """One row: target rows a merge deletes, source rows it inserts.

    The target is counted per key before it meets the source's keys, so a key that owns many of its rows is one row there;
    with few source keys they are broadcast and the target is not shuffled.
    """
    taken = key_counts(target, usable_keys(source, pk, small), pk, small=small)
    return (
        taken.select(F.col("__rows").alias("deleted"), F.lit(0).cast("long").alias("inserted"))
        .unionByName(source.select(F.lit(0).cast("long").alias("deleted"), F.lit(1).cast("long").alias("inserted")))
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("deleted", "inserted")])
    )


def last_chunk_rows(
    source: DataFrame, pk: Sequence[str], incr: str, bounds: Sequence[str], *, hot: Sequence[int] = ()
) -> DataFrame:
    """Source rows that survive when the chunks are merged one after another: those of each key's last chunk.

    Only keys found in several chunks are looked up, and they are gathered by an aggregate, so a key that
    owns many rows costs one row per task in the shuffle.
    """
    numbered = source.withColumn("__chunk", chunk_index(F.col(quoted(incr)), bounds, source.schema[incr].dataType))
    superseded = (
        numbered.where(all_present(pk))
        .groupBy(*map(quoted, pk))
        .agg(F.max("__chunk").alias("__last"), F.min("__chunk").alias("__first"))
        .where("__first < __last")
        .drop("__first")
    )
    return match(numbered, superseded, pk, "left_anti", hot=hot, also="l.__chunk < r.__last").drop("__chunk")


def chunked_merge(
    target: DataFrame,
    source: DataFrame,
    pk: Sequence[str],
    incr: str,
    bounds: Sequence[str],
    *,
    hot: Sequence[int] = (),
    small: bool = False,
) -> DataFrame:
    """Closed form of merging value-range chunks in ascending order.

    Every key of the source has rows in its last chunk, so the target is matched with the source's own keys.
    """
    kept = match(target, usable_keys(source, pk, small), pk, "left_anti", hot=hot, small=small)
    return kept.unionByName(last_chunk_rows(source, pk, incr, bounds, hot=hot))


def latest_per_key(source: DataFrame, pk: Sequence[str], incr: str) -> DataFrame:
    """One row per key, the one with the largest ``incr``; rows with a NULL in the key all stay.

    One scan; for a first place Spark keeps one candidate per key in each task before it shuffles. Equal ``incr`` is
    decided by the other columns, so a rerun picks the same row. Rows with a NULL in the key are groups of their own.
    """
    alone = F.when(~all_present(pk), F.monotonically_increasing_id())
    order = [F.desc_nulls_last(F.col(quoted(incr))), *[c.desc_nulls_last() for c in row_columns(source)]]
    first = F.row_number().over(Window.partitionBy(*map(quoted, pk), "__alone").orderBy(*order))
    return source.withColumn("__alone", alone).withColumn("__nth", first).where("__nth = 1").drop("__alone", "__nth")
