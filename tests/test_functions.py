import datetime as dt
import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    coercion_failed,
    http_date_to_stamp,
    row_digest,
    row_fingerprint,
    squeeze_whitespace,
    to_date_lenient,
    to_date_strict,
    to_int_lenient,
)
from tidemark.operators.clean import align_to_schema, column_differences, harmonize_layout, normalize_whitespace
from tidemark import schemas


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_whitespace_equals_python_split(spark):
    blanks = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f", " ", "\x85", "\xa0", " ", "　"]
    texts = ["", " ", "plain", "a b", "caf\xe9  x", "a​b"]
    texts += [f"{x}a{x}{y}b{y}" for x, y in itertools.product(blanks, blanks)]
    texts += [f"a{x}b c" for x in blanks]
    assert values(spark, texts, squeeze_whitespace("s")) == [" ".join(t.split()) for t in texts]


def test_whitespace_keeps_null_and_other_types(spark):
    df = spark.createDataFrame([(1, None, " a ")], "n int, s string, t string")
    assert normalize_whitespace(df).first() == (1, None, "a")


@pytest.mark.parametrize("text, number", [
    ("1980", 1980), ("1980.0", 1980), ("1e3", 1000), ("+5", 5), ("-7", -7), ("007", 7), ("5.", 5),
    ("", None), ("19x0", None), ("0x10", None), ("1,000", None), ("1980.5", None), ("99999999999", None),
    ("19d", None), ("19f", None), ("inf", None), ("nan", None), ("1 2", None), (None, None),
    ("2147483647", 2147483647), ("2147483648", None), ("-2147483648", -2147483648),
])
def test_int_lenient(spark, text, number):
    assert values(spark, [text], to_int_lenient("s")) == [number]


@pytest.mark.parametrize("text, date", [
    ("11/03/2020", dt.date(2020, 11, 3)), ("1/3/2020", dt.date(2020, 1, 3)),
    ("11/3/20", None), ("02/30/2021", None), ("##/##/####", None), ("", None), ("11/03/0020", None),
    ("11/03/2020 x", None), ("13/01/2020", None), (None, None), ("01/01/1600", None), ("01/01/2300", None),
])
def test_date_lenient(spark, text, date):
    assert values(spark, [text], to_date_lenient("s")) == [date]


def test_coercion_counter_ignores_empty_text(spark):
    assert values(spark, ["", None, "x", "1"], coercion_failed("s", to_int_lenient("s"))) == [False, False, True, False]


def test_snapshot_date_is_strict(spark):
    assert values(spark, ["20240131"], to_date_strict("s")) == [dt.date(2024, 1, 31)]
    for bad in ("20240231", "2024-01-31", "", None):
        with pytest.raises(Exception, match="not a snapshot date"):
            values(spark, [bad], to_date_strict("s"))


def test_http_date(spark):
    texts = ["Mon, 20 Apr 2026 00:10:13 GMT", "20 Apr 2026 00:10:13 GMT", "", "yesterday", None, "Mon, 31 Feb 2026 00:10:13 GMT"]
    assert values(spark, texts, http_date_to_stamp("s")) == ["20260420", "20260420", None, None, None, None]


def test_fingerprint_is_the_documented_text(spark):
    df = spark.createDataFrame([("a", None, dt.date(2020, 11, 3), 5), ("a", "", dt.date(2020, 11, 3), 5)], "a string, b string, d date, n int")
    expected = hashlib.md5(b"a||||737731||5").hexdigest()
    assert [r[0] for r in df.select(row_fingerprint(df.columns, ["d"])).collect()] == [expected, expected]


def test_fingerprint_of_a_null_date_keeps_its_separator(spark):
    df = spark.createDataFrame([(None, "x")], "d date, s string")
    assert df.select(row_fingerprint(["d", "s"], ["d"])).first()[0] == hashlib.md5(b"||x").hexdigest()


def test_fingerprint_collides_on_the_separator_but_the_digest_does_not(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string")
    assert df.select(row_fingerprint(df.columns)).distinct().count() == 1
    assert df.select(row_digest(df.columns)).distinct().count() == 2


def test_digest_separates_null_empty_and_neighbours(spark):
    rows = [(None, None), ("", None), (None, ""), ("", ""), ("-", ""), ("1:a", ""), ("1", "a"), ("", "1:a"), ("\xe9", "a"), ("a", "\xe9")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(row_digest(df.columns)).distinct().count() == len(rows)


def test_align_adds_drops_and_orders(spark):
    df = spark.createDataFrame([("x", "1", "extra")], "b string, a string, z string")
    target = schemas.T.StructType.fromDDL("a string, n int, b string")
    aligned = align_to_schema(df, target)
    assert aligned.schema.simpleString() == target.simpleString()
    assert aligned.first() == ("1", None, "x")
    assert column_differences(df, target) == (["n"], ["z"])


def test_layouts_agree_with_each_other():
    current, previous = set(schemas.REGISTRATION_COLUMNS), set(schemas.PREVIOUS_REGISTRATION_COLUMNS)
    assert len(schemas.REGISTRATION_COLUMNS) == len(current) == 67
    assert len(schemas.PREVIOUS_REGISTRATION_COLUMNS) == len(previous) == 71
    assert len(schemas.PARTICIPATION_COLUMNS) == 15
    assert previous - current == {"absent_ind", "name_prefx_cd", "birth_age", "dist_2_abbrv", "dist_2_desc"}
    assert current - previous == {"age_at_year_end"}
    assert len(schemas.REGISTRATION_TABLE.names) == 68
    assert len(schemas.COUNTY_CODES) == 100
    assert schemas.COUNTY_CODES["00"] == "YANCEY" and schemas.COUNTY_CODES["26"] == "CUMBERLAND" and schemas.COUNTY_CODES["99"] == "YADKIN"
    assert ("munic_dist_abbrv", "munic_dist_desc") in schemas.CODE_PAIRS and len(schemas.CODE_PAIRS) == 14


def test_previous_layout_is_harmonized(spark):
    df = spark.createDataFrame([tuple(schemas.PREVIOUS_REGISTRATION_COLUMNS)], schemas.PREVIOUS_REGISTRATION_COLUMNS)
    done = harmonize_layout(df, version_column="layout_version")
    assert set(done.columns) == set(schemas.REGISTRATION_COLUMNS) | {"layout_version"}
    assert done.select("age_at_year_end", "layout_version").first() == ("birth_age", "previous")
    current = spark.createDataFrame([tuple(schemas.REGISTRATION_COLUMNS)], schemas.REGISTRATION_COLUMNS)
    assert harmonize_layout(current).columns == schemas.REGISTRATION_COLUMNS
    assert harmonize_layout(current, version_column="v").select("v").first()[0] == "current"
