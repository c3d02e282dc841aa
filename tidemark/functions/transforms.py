"""Field transforms named in a spec: ``(column, transform, arg1, arg2)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import is_blank, quoted
from tidemark.spec import SpecError


def transform_column(c: Column, name: str, arg1: str = "", arg2: str = "") -> Column:
    match name:
        case "trim":
            return F.trim(c)
        case "upper":
            return F.upper(c)
        case "lower":
            return F.lower(c)
        case "replace":
            return F.replace(c, F.lit(arg1), F.lit(arg2))
        case "default":
            return F.when(c.isNull() | is_blank(c), F.lit(arg1)).otherwise(c)
        case "prefix":
            return F.concat(F.lit(arg1), c)
        case "suffix":
            return F.concat(c, F.lit(arg1))
    raise SpecError(f"unknown field transform: {name!r}")


def field_transforms(df: DataFrame, rules: Sequence[tuple[str, ...]]) -> DataFrame:
    """Apply the rules in order, each to its own column."""
    for column, name, *args in rules:
        df = df.withColumn(column, transform_column(F.col(quoted(column)).cast("string"), name, *args))
    return df
