"""Value cleaning. Native column expressions only, so scans keep whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 25 Unicode white-space code points, and the control characters to drop
# (tab, line feed and carriage return stay).
WHITE_SPACE = r"[\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
CONTROL_CHARS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def is_blank(c: Column) -> Column:
    """True for empty text and text of white space only. Stops at the first other character."""
    return c.rlike(rf"\A{WHITE_SPACE}*\z")


def blank_to_empty(c: Column) -> Column:
    return F.when(is_blank(c), F.lit("")).otherwise(c)


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL_CHARS, "")


def clean_text(c: Column) -> Column:
    """Blank test first, on the raw text, then control characters; NULL stays NULL."""
    return F.when(is_blank(c), F.lit("")).otherwise(strip_control(c))


def clean(df: DataFrame) -> DataFrame:
    """Clean every text column; other types pass through natively."""
    return df.select(
        *[
            clean_text(F.col(quoted(f.name))).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def quoted(name: str) -> str:
    """A column name as one identifier, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"
