"""Key matching that holds up when one key, or NULL, owns a large share of the rows.

Matching only asks whether a row's key is among the source's keys, so the key side is made distinct first
(partial aggregation collapses copies before the shuffle). A key side of checked size is broadcast and the
other side is not shuffled at all. Beyond that size both sides are shuffled by key, but rows of hot keys go
apart: the hot keys are few, so the source's share of them is broadcast and their rows stay where they are.
Rows with a NULL in the key match nothing and bypass the join too. So do rows whose key is surely not among the
source's: a bit for each hash of a key, in blocks of a bounded size together, is broadcast and tells which they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted

HOT_SHARE = 0.005
BROADCAST_BYTES = 32 << 20
BLOCK_BITS = 15  # a block of a key filter has so many bits as a power of two, as bitmap_construct_agg makes them


def all_present(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(quoted(k)).isNotNull() for k in keys])


def usable_keys(df: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """The keys that can match anything, once each. ``small`` keys are broadcast, which needs no shuffle before it."""
    present = df.select(*map(quoted, keys)).where(all_present(keys))
    return present if small else present.distinct()


def key_bytes(df: DataFrame, keys: Sequence[str]) -> Column:
    """Aggregate: upper bound of the size of the key columns."""
    width = F.lit(16)
    for k in keys:
        variable = isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType))
        width = width + (F.coalesce(F.octet_length(F.col(quoted(k))), F.lit(0)) if variable else F.lit(16))
    return F.coalesce(F.sum(width.cast("long")), F.lit(0))


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys give equal hashes: adding zero turns -0.0 into 0.0, which joins take as the same."""
    floating = (T.FloatType, T.DoubleType)
    columns = [F.col(quoted(k)) for k in keys]
    return F.xxhash64(*[c + F.lit(0.0) if isinstance(df.schema[k].dataType, floating) else c for k, c in zip(keys, columns)])


def can_filter(df: DataFrame, keys: Sequence[str], size: int, limit: int) -> bool:
    """Whether key_filter helps: keys that hash alike where they are equal, and bits enough for keys of this ``size``."""
    plain = (T.IntegralType, T.FractionalType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)
    types = [df.schema[k].dataType for k in keys]
    return limit >> (BLOCK_BITS - 3) > 0 and size <= 256 * limit and all(isinstance(t, plain) or t == T.StringType() for t in types)


def key_filter(keys_df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Blocks of bits, of ``limit`` bytes together, where the hashes of keys are set; small enough to broadcast."""
    place = keys_df.where(all_present(keys)).select(_filter_place(keys_df, keys, limit).alias("__place"))
    block, bit = F.shiftright("__place", BLOCK_BITS).alias("__block"), F.col("__place").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return place.groupBy(block).agg(F.bitmap_construct_agg(bit).alias("__bits"))


def _filter_place(df: DataFrame, keys: Sequence[str], limit: int) -> Column:
    return F.pmod(key_hash(df, keys), F.lit(limit >> (BLOCK_BITS - 3) << BLOCK_BITS))


def marked(df: DataFrame, blocks: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """The rows with ``__may``: false where a key is surely not among those of the filter. Rows stay where they are."""
    rows = df.withColumn("__place", _filter_place(df, keys, limit)).withColumn("__at", F.shiftright("__place", BLOCK_BITS))
    rows = rows.join(F.broadcast(blocks), F.col("__at") == F.col("__block"), "left")
    bit = F.col("__place").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int")
    byte = F.ascii(F.decode(F.substring("__bits", F.shiftright(bit, 3) + 1, F.lit(1)), "ISO-8859-1"))
    may = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7))) == 1, F.lit(False))
    return rows.select(*map(quoted, df.columns), may.alias("__may"))


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of every key that owns more than ``share`` of the rows: at most 1/share numbers.

    They decide only how rows meet, never which rows match. One pass finds candidates in bounded memory; a second
    counts them, so a table without hot keys pays nothing later.
    """
    hashes = df.where(all_present(keys)).select(key_hash(df, keys).alias("h"))
    candidates = hashes.freqItems(["h"], share).first()[0] or []
    if not candidates:
        return []
    found = hashes.groupBy(F.when(F.col("h").isin(candidates), F.col("h")).alias("h")).count().collect()
    least = share * sum(r["count"] for r in found)
    return [r.h for r in found if r.h is not None and r["count"] > least]


def row_columns(df: DataFrame) -> list[Column]:
    """Columns that can be hashed and ordered, to tell rows apart; maps and variants cannot."""
    return [
        F.col(quoted(f.name)) for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ] or [F.lit(0)]


def match(
    df: DataFrame,
    keys_df: DataFrame,
    keys: Sequence[str],
    how: str,
    *,
    hot: Sequence[int] = (),
    small: bool = False,
    also: str = "",
    blocks: DataFrame | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``df`` against usable keys. ``also`` adds a condition over aliases l and r.

    Both sides hold the key in the same types. ``hot`` are hashes from ``hot_keys``; the keys that have them are
    at most as many, which bounds what is broadcast. ``df`` is read once more for the rows that go apart. With
    ``blocks``, a key filter of ``limit`` bytes, only rows whose key may be among the keys are shuffled.
    """

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        same = [F.col(f"l.{quoted(k)}") == F.col(f"r.{quoted(k)}") for k in keys]
        condition = reduce(and_, same + ([F.expr(also)] if also else []))
        return left.alias("l").join(right.alias("r"), condition, how).select(*map(quoted, df.columns))

    if small:
        return joined(df, F.broadcast(keys_df))
    if blocks is not None:
        rows = marked(df, blocks, keys, limit)
        met = match(rows.where("__may").drop("__may"), keys_df, keys, how, hot=hot, also=also)
        return met if how == "left_semi" else met.unionAll(rows.where("NOT __may").drop("__may"))
    present = df.where(all_present(keys))
    if hot:
        in_df, in_keys = (key_hash(side, keys).isin(list(hot)) for side in (df, keys_df))
        common = joined(present.where(~in_df), keys_df.where(~in_keys))
        matched = common.unionAll(joined(present.where(in_df), F.broadcast(keys_df.where(in_keys))))
    else:
        matched = joined(present, keys_df)
    return matched.unionAll(df.where(~all_present(keys))) if how == "left_anti" else matched


def key_counts(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], *, small: bool = False) -> DataFrame:
    """Each key that both sides hold, with how many rows of ``df`` have it, as ``__rows``.

    ``small`` keys are broadcast and ``df`` is cut down before it is counted. Else ``df`` is counted per key first, with
    partial aggregates, so each key is one row on either side when they meet, whatever share of the rows it owns.
    """
    names = [quoted(k) for k in keys]
    count = F.count(F.lit(1)).alias("__rows")
    present = df.select(*names).where(all_present(keys))
    if small:
        return match(present, keys_df, keys, "left_semi", small=True).groupBy(*names).agg(count)
    same = reduce(and_, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in names])
    met = present.groupBy(*names).agg(count).alias("l").join(keys_df.alias("r"), same)
    return met.select(*[F.col(f"l.{k}") for k in names], "__rows")


def plan_match(df: DataFrame, source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_BYTES) -> dict:
    """How to match ``df`` with the source's keys: measured as small enough to broadcast, or with hot keys found."""
    size = source.agg(key_bytes(source, keys).alias("size")).first().size
    return {"small": True} if size <= limit else {"hot": hot_keys(df, keys)}


def hot_on_either(df: DataFrame, source: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Keys that own a large share of the rows of either side: for joins of each side's own rows with one list of keys."""
    return sorted({*hot_keys(df, keys, share), *hot_keys(source, keys, share)})
