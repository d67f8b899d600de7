from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.functions import scalars as S


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12), (" 12 ", 12), ("12.5", 13), ("1e3", 1000), ("-0.5", -1), ("abc", None),
     ("", None), (None, None), ("9999999999", None), (".5", 1)],
)
def test_cast_int(spark, text, expected):
    assert one(spark, text, S.cast_int("v")) == expected


def test_cast_bigint_keeps_large_values(spark):
    assert one(spark, "9999999999", S.cast_bigint("v")) == 9999999999


@pytest.mark.parametrize("text, expected", [("1.5", 1.5), ("1.5d", None), ("1f", None), ("x", None), (" 7 ", 7.0)])
def test_cast_double(spark, text, expected):
    assert one(spark, text, S.cast_double("v")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2013-07-09", date(2013, 7, 9)),
        (" 2013-7-9 ", date(2013, 7, 9)),
        ("2013/07/09", date(2013, 7, 9)),
        ("2013-07-09 10:00:00", date(2013, 7, 9)),
        ("2013-07/09", None),
        ("2013", None),
        ("2013-07", None),
        ("213-08-24", None),
        ("7436-02-12", None),
        ("2013-02-30", None),
        ("1799-12-31", None),
        (None, None),
    ],
)
def test_safe_date(spark, text, expected):
    assert one(spark, text, S.safe_date("v")) == expected


def test_safe_date_window(spark):
    assert one(spark, "1985-01-01", S.safe_date("v")) == date(1985, 1, 1)
    assert one(spark, "1985-01-01", S.safe_date("v", 1990)) is None


def test_normalize_and_flags(spark):
    assert one(spark, "  a b ", S.normalize_string("v")) == "a b"
    assert one(spark, "  a b ", S.normalize_string("v", upper=True)) == "A B"
    assert one(spark, "   ", S.normalize_string("v")) is None
    assert one(spark, " S ", S.decode_flag("v", "S")) is True
    assert one(spark, "s", S.decode_flag("v", "S")) is False
    assert one(spark, None, S.decode_flag("v", "S")) is False


@pytest.mark.parametrize("value, digits, expected", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (1.25, 1, 1.3), (0.0, 2, 0.0), (1.005, 2, 1.0)])
def test_rounded(spark, value, digits, expected):
    assert one(spark, value, S.rounded("v", digits), "double") == expected


def test_ratio_by_zero_is_null(spark):
    assert one(spark, 0.0, S.ratio(F.lit(1), "v"), "double") is None
    assert one(spark, 0.0, S.pct(F.lit(1), "v", 1), "double") is None


@pytest.mark.parametrize(
    "lot, tender, expected",
    [(1e9, None, True), (999.0, 100.0, False), (1001.0, 100.0, True), (1000.0, 100.0, False),
     (None, 100.0, False), (5.0, 0.0, False)],
)
def test_suspect_amount(spark, lot, tender, expected):
    df = spark.createDataFrame([(lot, tender)], "lot double, tender double")
    assert df.select(S.suspect_amount("lot", "tender")).first()[0] is expected


def test_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 31))], "a date, b date")
    got = df.select(
        S.days_between("a", "b"), S.guarded_days("a", "b", 0, 30), S.guarded_days("a", "b", 0, 29)
    ).first()
    assert tuple(got) == (30, 30, None)


def test_series_key_and_prefix(spark):
    df = spark.createDataFrame([(7, "C"), (None, "C")], "id int, cig string")
    assert [r[0] for r in df.select(S.series_key("id", "cig")).collect()] == ["agg:7", "cig:C"]
    assert one(spark, "SEZIONE REGIONALE LAZIO", S.strip_prefix("v", "SEZIONE REGIONALE")) == "LAZIO"
