"""Text forms of typed values, as a text load into a database expects them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import is_blank, strip_control

# Text forms that the receiving database parses.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
GUID_BYTE_ORDER = ((4, 3, 2, 1), (6, 5), (8, 7), (9, 10), (11, 12, 13, 14, 15, 16))
NULL_TEXT = "__NULL__"


def timestamp_text(c: Column) -> Column:
    """Six digits of fraction, no zone; a date gets midnight."""
    return F.date_format(c, TIMESTAMP_FORMAT)


def to_instant(c: Column, zone: str) -> Column:
    """Read a zone-less timestamp as wall-clock time in ``zone``, whatever the session zone is."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), c.cast(T.TimestampNTZType()))
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, utc))


def guid_text(c: Column) -> Column:
    """16 bytes in mixed-endian order as an upper-case UUID; any other length gives empty text."""
    groups = [F.concat(*[F.substring(F.hex(c), 2 * b - 1, 2) for b in group]) for group in GUID_BYTE_ORDER]
    return F.when(F.octet_length(c) == 16, F.concat_ws("-", *groups)).when(c.isNotNull(), F.lit(""))


def guid_from_text(c: Column) -> Column:
    return F.upper(c)


def binary_text(c: Column) -> Column:
    return F.concat(F.lit("\\x"), F.lower(F.hex(c)))


def array_text(c: Column, element: T.DataType = T.LongType()) -> Column:
    """Array literal ``{1,NULL,3}``; text items are quoted where the literal needs it."""

    def item(x: Column) -> Column:
        if isinstance(element, T.ArrayType):
            return array_text(x, element.elementType)
        text = encode(x, element)
        if not isinstance(element, (T.StringType, T.TimestampType, T.TimestampNTZType, T.BinaryType)):
            return text
        escaped = F.concat(F.lit('"'), F.regexp_replace(text, r'(["\\])', r"\\$1"), F.lit('"'))
        plain = ~text.rlike(r'[,"{}\\\s]') & (text != "") & (F.upper(text) != "NULL")
        return F.when(plain, text).otherwise(F.when(text.isNotNull(), escaped))

    return F.when(
        c.isNotNull(), F.concat(F.lit("{"), F.array_join(F.transform(c, item), ",", "NULL"), F.lit("}"))
    )


def scalar_text(c: Column) -> Column:
    return c.cast("string")


def encode(c: Column, dtype: T.DataType) -> Column:
    """Text form of a value of any supported type; NULL stays NULL. Text itself is left alone."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return timestamp_text(c)
    if isinstance(dtype, T.BinaryType):
        return binary_text(c)
    if isinstance(dtype, T.ArrayType):
        return array_text(c, dtype.elementType)
    return scalar_text(c)


def csv_field(c: Column, null_text: str = NULL_TEXT) -> Column:
    """One CSV field. NULL becomes the bare marker; text equal to the marker is quoted to stay text."""
    stripped = strip_control(c)
    doubled = F.replace(stripped, F.lit('"'), F.lit('""'))
    needs_quotes = stripped.rlike(r'[,"\n\r]') | (stripped == null_text)
    return (
        F.when(c.isNull(), F.lit(null_text))
        .when(is_blank(c), F.lit(""))
        .when(needs_quotes, F.concat(F.lit('"'), doubled, F.lit('"')))
        .otherwise(stripped)
    )


__all__ = [
    "NULL_TEXT",
    "array_text",
    "binary_text",
    "csv_field",
    "encode",
    "guid_from_text",
    "guid_text",
    "scalar_text",
    "timestamp_text",
    "to_instant",
]
