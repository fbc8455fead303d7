"""Scalar functions (C1-C18) and rounding."""

import pytest
from pyspark.sql import functions as F

from sparkfolio.functions import (
    accounting_number, multi_format_timestamp, python_float, round_half, try_num,
    weekday_name, weekday_ord, yes_no_flag, zero_pad)
from sparkfolio.functions.synonyms import map_label


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize("text,exp", [("1", 1.0), ("1.5", 1.5), (" 5 ", 5.0), ("1_000", 1000.0),
                                      ("1e5", None), ("1.5e3", 1500.0), ("abc", None), ("", None),
                                      ("nan", None), ("-3", -3.0)])
def test_try_num(spark, text, exp):
    assert one(spark, try_num, text) == exp


@pytest.mark.parametrize("text,exp", [("1e5", 1e5), ("inf", float("inf")), ("nan", None), (" 2 ", 2.0),
                                      ("5d", None), ("1.", 1.0), (".5", 0.5), ("Infinity", float("inf")), ("x", None)])
def test_python_float(spark, text, exp):
    assert one(spark, python_float, text) == exp


@pytest.mark.parametrize("text,exp", [("1,234", 1234.0), ("(567)", -567.0), (" 12 ", 12.0), ("", None),
                                      ("garbage", None), ("(1,234.5)", -1234.5), (None, None)])
def test_accounting_number(spark, text, exp):
    assert one(spark, accounting_number, text) == exp


def test_unit_scaling(spark):
    assert one(spark, lambda c: accounting_number(c, 1e8), "150,000,000") == 1.5


def test_multi_format_timestamp(spark):
    df = spark.createDataFrame([("4/12/2016 1:00:00 PM",), ("2016-04-12 13:00:00",), ("bad",)], "v string")
    out = [r.o for r in df.select(multi_format_timestamp("v").alias("o")).collect()]
    assert out[0] == out[1] and out[0].hour == 13 and out[2] is None


def test_zero_pad_and_flags(spark):
    assert one(spark, zero_pad, "51900") == "051900"
    assert one(spark, zero_pad, "") is None
    assert one(spark, zero_pad, None) is None
    assert one(spark, yes_no_flag, "Yes") == 1 and one(spark, yes_no_flag, "No") == 0
    assert one(spark, yes_no_flag, "maybe") is None


@pytest.mark.parametrize("x,d,exp", [(2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (12.25, 1, 12.3),
                                     (1234.5678125, 4, 1234.5678)])
def test_round_half(spark, x, d, exp):
    assert one(spark, lambda c: round_half(c, d), x, "double") == exp


def test_weekday(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-07",)], "d string").select(
        F.to_date("d").alias("d"))
    out = [(r.n, r.o) for r in df.select(weekday_name("d").alias("n"), weekday_ord("d").alias("o")).collect()]
    assert out == [("Monday", 1), ("Sunday", 7)]


def test_substring_map_first_wins(spark):
    df = spark.createDataFrame([("매출원가",), ("비유동자산",), ("영업이익",), ("기타",)], "v string")
    sub = [r.o for r in df.select(map_label("v").alias("o")).collect()]
    assert sub == ["Sales", "CurrentAssets", "OperatingIncome", None]
    ex = [r.o for r in df.select(map_label("v", mode="exact").alias("o")).collect()]
    assert ex == ["CostOfSales", None, "OperatingIncome", None]


def test_date_coerce(spark):
    from sparkfolio.functions.coerce import to_date_safe
    df = spark.createDataFrame([("4/12/2016",), ("2016-04-13",), ("junk",)], "v string")
    got = [r.d for r in df.select(to_date_safe("v", "M/d/yyyy").alias("d")).collect()]
    assert got[0].day == 12 and got[1] is None and got[2] is None
    got2 = [r.d for r in df.select(to_date_safe("v").alias("d")).collect()]
    assert got2[1].day == 13 and got2[2] is None
