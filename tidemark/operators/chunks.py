"""Cut an extract into ranges of its incremental field. Equal values always share a chunk.

Bounds travel as text, like high-water marks, and are compared in the type of the field.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.operators.hwm import point_text, typed_point

# Types whose ranges Spark can estimate with percentile_approx.
_MEASURED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
GRID = 1000  # quantiles of a sketch


def sketch(c: Column, dtype: T.DataType) -> dict[str, Column]:
    """Aggregates that go along with a write and give the bounds of chunks afterwards; none for types without quantiles."""
    if not isinstance(dtype, _MEASURED):
        return {}
    shares = [i / GRID for i in range(1, GRID)]
    grid = F.transform(F.percentile_approx(c, shares, 10 * GRID), lambda x: point_text(x, dtype))
    return {"grid": grid, "top": point_text(F.max(c), dtype)}


def sketched_bounds(measured: dict, rows: int, rows_per_chunk: int) -> list[str] | None:
    """What ``chunk_bounds`` gives, from a measured sketch; None where it is too coarse for so many chunks."""
    chunks = math.ceil(rows / max(rows_per_chunk, 1))
    if chunks < 2:
        return []
    if "grid" not in measured or chunks > GRID // 10:
        return None
    grid = measured["grid"] or []
    cuts = [grid[round(i * GRID / chunks) - 1] for i in range(1, chunks)] if grid else []
    return [c for c in dict.fromkeys(cuts) if c != measured["top"]]


def chunk_bounds(source: DataFrame, incr: str, rows: int, rows_per_chunk: int) -> list[str]:
    """Inclusive upper bounds of every chunk but the last, ascending. One value per chunk reaches the driver."""
    chunks = math.ceil(rows / max(rows_per_chunk, 1))
    if chunks < 2:
        return []
    dtype = source.schema[incr].dataType
    values = source.select(F.col(quoted(incr)).alias("v")).where("v IS NOT NULL")
    if isinstance(dtype, _MEASURED):
        shares = [i / chunks for i in range(1, chunks)]
        cuts = values.agg(
            F.percentile_approx("v", shares, max(10_000, 10 * chunks)).alias("cuts"), F.max("v").alias("top")
        )
    else:
        # Spark's range partitioner finds the cuts; each partition gives its upper value.
        highs = values.repartitionByRange(chunks, "v").groupBy(F.spark_partition_id()).agg(F.max("v").alias("hi"))
        cuts = highs.agg(F.collect_set("hi").alias("cuts"), F.max("hi").alias("top"))
    ordered = F.array_sort(F.array_distinct("cuts"))
    below = F.filter(ordered, lambda x: x < F.col("top"))
    return cuts.select(F.transform(below, lambda x: point_text(x, dtype)).alias("b")).first().b or []


def chunk_index(c: Column, bounds: Sequence[str], dtype: T.DataType) -> Column:
    """Number of the chunk from 0: how many bounds lie below the value. NULLs belong to the last chunk."""
    if not bounds:
        return F.when(c.isNull() | c.isNotNull(), F.lit(0))
    typed = F.array(*[typed_point(b, dtype) for b in bounds])  # a constant; searched by halving
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def further(below: Column, step: Column) -> Column:
        there = below + step
        return F.when((there <= len(bounds)) & (F.get(typed, there - 1) < c), there).otherwise(below)

    return F.when(c.isNull(), F.lit(len(bounds))).otherwise(F.aggregate(steps, F.lit(0), further))


def chunks(source: DataFrame, incr: str, bounds: Sequence[str]) -> Iterator[DataFrame]:
    """The chunks in ascending order, each a range filter that reaches the scan."""
    c = F.col(quoted(incr))
    points = [typed_point(b, source.schema[incr].dataType) for b in bounds]
    if not points:
        yield source
        return
    yield source.where(c <= points[0])
    for low, high in zip(points, points[1:]):
        yield source.where((c > low) & (c <= high))
    yield source.where((c > points[-1]) | c.isNull())
