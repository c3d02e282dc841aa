"""CSV text as a bulk load into a database reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.clean import quoted
from tidemark.functions.text import NULL_TEXT, csv_field, encode


def text_columns(df: DataFrame) -> DataFrame:
    """Every column in its text form; text is left as it is."""
    return df.select(
        *[
            F.col(quoted(f.name)) if isinstance(f.dataType, T.StringType) else encode(F.col(quoted(f.name)), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def csv_line(df: DataFrame, null_text: str = NULL_TEXT) -> Column:
    return F.concat_ws(",", *[csv_field(encode(F.col(quoted(f.name)), f.dataType), null_text) for f in df.schema.fields])


def csv_lines(df: DataFrame, null_text: str = NULL_TEXT) -> DataFrame:
    """One ``line`` per row: comma, double quote, NULL as the bare marker."""
    return df.select(csv_line(df, null_text).alias("line"))


def export_csv(df: DataFrame, path: str, null_text: str = NULL_TEXT) -> None:
    """Write the lines in parallel as text files."""
    csv_lines(df, null_text).write.mode("errorifexists").text(path)


def copy_statement(table: str, columns: list[str], null_text: str = NULL_TEXT) -> str:
    """The statement that loads the exported files into a PostgreSQL or Greenplum table."""
    names = f"({', '.join(columns)})" if columns else ""
    return f"COPY {table}{names} FROM STDIN WITH (FORMAT CSV, DELIMITER ',', QUOTE '\"', ESCAPE '\"', NULL '{null_text}')"
