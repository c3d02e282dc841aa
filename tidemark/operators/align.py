"""Bring an extract into the shape of its target: by name, in target order, in target types."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.functions.text import encode, to_instant
from tidemark.spec import SpecError

FAULTS, ROW = "__faults", "__row"
FAULT_TYPE = "array<struct<field:string,text:string,reason:string>>"
# Text that names its own zone: an offset, Z or a region after the time of day.
OFFSET = r":\d\d(\.\d+)?\s*(Z|[+-]\d\d?(:?\d\d)?|[A-Za-z]+/[A-Za-z_]+)\s*$"


def align(
    source: DataFrame, target: T.StructType, defaults: Mapping[str, Any] | None = None, zone: str = ""
) -> DataFrame:
    """Names match ignoring case. A target column the source lacks gets its default, else NULL.

    A source column the target lacks is an error, and so is a value that the target type cannot hold. ``zone``
    is where zone-less times live when the target column has a zone; without it, the session's.
    """
    columns, _ = _aligned(source, target, defaults, zone)
    return source.select(*columns)


def align_marked(
    source: DataFrame, target: T.StructType, defaults: Mapping[str, Any] | None = None, zone: str = ""
) -> DataFrame:
    """Like ``align``, but a value that the target type cannot hold becomes NULL and its row says so.

    ``FAULTS`` lists field, text and reason of every such value, in target order; it is empty for good rows. ``ROW`` is the
    whole source row as JSON where there is a fault, so that it can be mended and loaded again.
    """
    columns, faults = _aligned(source, target, defaults, zone, mark=True)
    empty = F.array().cast(FAULT_TYPE)
    found = F.filter(F.array(*faults), lambda f: f.isNotNull()) if faults else empty
    whole = F.to_json(F.struct(*[F.col(quoted(c)) for c in source.columns]))
    return source.select(*columns, found.cast(FAULT_TYPE).alias(FAULTS), F.when(F.size(found) > 0, whole).alias(ROW))


def good_rows(marked: DataFrame) -> DataFrame:
    """The rows of a marked alignment that hold no bad value."""
    return marked.where(F.size(FAULTS) == 0).drop(FAULTS, ROW)


def rejected(marked: DataFrame) -> DataFrame:
    """One row for each bad value: its target column, its text, why it was refused, and the source row as JSON."""
    return marked.select(F.explode(FAULTS).alias("f"), F.col(ROW).alias("row")).select("f.*", "row")


def _aligned(
    source: DataFrame, target: T.StructType, defaults: Mapping[str, Any] | None, zone: str, mark: bool = False
) -> tuple[list[Column], list[Column]]:
    """The target's columns and, when values are marked instead of raised, the fault of each converted one."""
    folded = Counter(f.name.lower() for f in source.schema.fields)
    wanted = {f.name.lower() for f in target.fields}
    extra = sorted(name for name in folded if name not in wanted)
    twice = sorted(name for name, n in folded.items() if n > 1)
    if extra or twice:
        raise SpecError(f"columns not in the target: {extra}; columns given twice: {twice}")
    given = {f.name.lower(): f for f in source.schema.fields}
    default_of = {name.lower(): value for name, value in (defaults or {}).items()}

    columns, faults = [], []
    for f in target.fields:
        if f.name.lower() not in given:
            columns.append(F.lit(default_of.get(f.name.lower())).cast(f.dataType).alias(f.name))
            continue
        value, bad = _converted(given[f.name.lower()], f.dataType, zone)
        if bad is None:
            columns.append(value.alias(f.name))
            continue
        c, reason = F.col(quoted(given[f.name.lower()].name)), f"not a {f.dataType.simpleString()}"
        bad = c.isNotNull() & bad
        if mark:
            fault = F.struct(F.lit(f.name).alias("field"), c.cast("string").alias("text"), F.lit(reason).alias("reason"))
            columns.append(F.when(~bad, value).alias(f.name))
            faults.append(F.when(bad, fault))
        else:
            message = F.concat(F.lit(f"{given[f.name.lower()].name}: {reason}: "), c.cast("string"))
            columns.append(F.when(bad, F.raise_error(message).cast(f.dataType)).otherwise(value).alias(f.name))
    return columns, faults


def _converted(given: T.StructField, wanted: T.DataType, zone: str) -> tuple[Column, Column | None]:
    """The value in its new type and, where a value may not fit, whether it does not."""
    c = F.col(quoted(given.name))
    if given.dataType == wanted:
        return c, None
    if isinstance(wanted, T.StringType):
        return encode(c, given.dataType), None
    zoneless = isinstance(given.dataType, (T.TimestampNTZType, T.StringType))
    if zone and isinstance(wanted, T.TimestampType) and zoneless:
        value = to_instant(c.try_cast(T.TimestampNTZType()), zone)
        if isinstance(given.dataType, T.StringType):
            value = F.when(c.rlike(OFFSET), c.try_cast(wanted)).otherwise(value)
    else:
        value = c.try_cast(wanted)
    bad = value.isNull()
    if isinstance(wanted, T.IntegralType) and isinstance(given.dataType, T.FractionalType):
        bad = bad | (value.cast(given.dataType) != c)
    return value, bad
