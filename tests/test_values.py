import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tidemark.functions import text
from tidemark.functions.clean import clean, clean_text, is_blank
from tidemark.functions.transforms import field_transforms
from tidemark.sinks.export import copy_statement, csv_lines, export_csv, text_columns
from tidemark.spec import SpecError

BLANKS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def one(spark, value, form, type_="string"):
    return spark.createDataFrame([(value,)], f"v {type_}").select(form(F.col("v"))).first()[0]


def test_blank_is_exactly_unicode_white_space(spark):
    codes = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in codes], "code int, v string")
    assert sorted(r.code for r in df.where(is_blank(F.col("v"))).select("code").collect()) == BLANKS


@pytest.mark.parametrize(
    ("raw", "cleaned"),
    [
        (None, None),
        ("", ""),
        (" \t　  ", ""),
        ("\x00\x01", ""),
        ("a\x00b\x7f", "ab"),
        (" keep\t\r\n ", " keep\t\r\n "),
        ("　x", "　x"),
        ("a\x0b\x0c\x0e\x1f", "a"),
    ],
)
def test_clean_text(spark, raw, cleaned):
    assert one(spark, raw, clean_text) == cleaned


def test_clean_leaves_other_types_alone(spark):
    df = spark.createDataFrame([(1, b"\x00", " ", 1.5)], "a int, b binary, `c d` string, e double")
    cleaned = clean(df)
    assert cleaned.schema == df.schema or cleaned.dtypes == df.dtypes
    assert rows(cleaned) == [(1, bytearray(b"\x00"), "", 1.5)]


@pytest.mark.parametrize(
    ("raw", "field"),
    [
        (None, text.NULL_TEXT),
        ("", ""),
        ("   ", ""),
        (text.NULL_TEXT, f'"{text.NULL_TEXT}"'),
        ("\x00" + text.NULL_TEXT, f'"{text.NULL_TEXT}"'),
        ("a,b", '"a,b"'),
        ('say "hi"', '"say ""hi"""'),
        ("two\nlines", '"two\nlines"'),
        ("cr\rhere", '"cr\rhere"'),
        ("plain\x01", "plain"),
        ("{1,2,3}", '"{1,2,3}"'),
    ],
)
def test_csv_field(spark, raw, field):
    assert one(spark, raw, text.csv_field) == field


@pytest.mark.parametrize(
    ("items", "literal"),
    [
        (None, None),
        ([], "{}"),
        (["a", None, "b c", "", "null", 'q"\\', "{x}"], '{a,NULL,"b c","","null","q\\"\\\\","{x}"}'),
    ],
)
def test_array_text(spark, items, literal):
    assert one(spark, items, lambda c: text.array_text(c, T.StringType()), "array<string>") == literal


def test_nested_and_number_arrays(spark):
    assert one(spark, [[1, None], [3]], lambda c: text.array_text(c, T.ArrayType(T.IntegerType())), "array<array<int>>") == "{{1,NULL},{3}}"


def test_guid(spark):
    known = bytes.fromhex("33221100554477668899aabbccddeeff")
    assert one(spark, known, text.guid_text, "binary") == "00112233-4455-6677-8899-AABBCCDDEEFF"
    assert one(spark, known[:15], text.guid_text, "binary") == ""
    assert one(spark, None, text.guid_text, "binary") is None


def test_binary(spark):
    assert one(spark, b"\x00\xff", text.binary_text, "binary") == "\\x00ff"
    assert one(spark, b"", text.binary_text, "binary") == "\\x"
    assert one(spark, None, text.binary_text, "binary") is None


def test_timestamp_text(spark):
    assert one(spark, dt.datetime(2024, 1, 2, 3, 4, 5, 60), text.timestamp_text, "timestamp_ntz") == "2024-01-02 03:04:05.000060"
    assert one(spark, dt.date(2024, 1, 2), text.timestamp_text, "date") == "2024-01-02 00:00:00.000000"


def test_instants_do_not_depend_on_the_session_zone(spark):
    def micros(zone):
        return one(spark, dt.datetime(2024, 1, 1), lambda c: F.unix_micros(text.to_instant(c, zone)), "timestamp_ntz")

    utc, mexico = micros("UTC"), micros("America/Mexico_City")
    assert mexico - utc == 6 * 3600 * 1_000_000
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert micros("America/Mexico_City") == mexico
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_transforms(spark):
    df = spark.createDataFrame([(" a ", None, "x-y")], "t string, d string, r string")
    rules = [("t", "trim"), ("t", "upper"), ("d", "default", "none"), ("r", "replace", "-", "+"), ("r", "prefix", "<"), ("r", "suffix", ">")]
    assert rows(field_transforms(df, rules)) == [("A", "none", "<x+y>")]
    with pytest.raises(SpecError):
        field_transforms(df, [("t", "reverse")])


def test_export(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb", True, [1, None], b"\x01", None)], "i int, s string, b boolean, a array<int>, x binary, n string")
    line = f'1,"a\nb",true,"{{1,NULL}}",\\x01,{text.NULL_TEXT}'
    assert csv_lines(df).first().line == line
    export_csv(df, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out"), wholetext=True).where("value <> ''").first().value.rstrip("\n") == line
    assert {t for _, t in text_columns(df).dtypes} == {"string"}
    assert copy_statement("ods.a", ["i", "s"]).endswith(f"NULL '{text.NULL_TEXT}')")
