"""Scalar expressions (F1-F19) on hand-made rows."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidewater.functions import exprs as X


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("r")).collect()]


def test_round_half_even_matches_float_rounding(spark):
    # 2.0005 sits just above the tie in binary, 0.0125 is a tie.
    got = one(spark, X.round_half_even("x", 3), [(2.0005,), (0.0125,), (1.0,)], "x double")
    assert got == [2.001, 0.012, 1.0]


def test_round_half_up(spark):
    got = one(spark, X.round_half_up("x", 2), [(1.005,), (75.125,), (-2.345,)], "x double")
    assert got == [1.01, 75.13, -2.35]


def test_label_null_takes_else(spark):
    # a NULL test takes the else branch.
    got = one(spark, X.label(F.col("x") > 50, "hi", "lo"), [(50.0,), (50.01,), (None,)], "x double")
    assert got == ["lo", "hi", "lo"]


def test_try_number_bad_text_is_null(spark):
    got = one(spark, X.try_number("x"), [("12.5",), ("abc",), ("NaN",), ("-1",), (None,)], "x string")
    assert got == [decimal.Decimal("12.50"), None, None, decimal.Decimal("-1.00"), None]


def test_try_timestamp_and_parse(spark):
    got = one(spark, X.try_timestamp("x"), [("2024-03-01 10:20:30",), ("not a date",)], "x string")
    assert got == [dt.datetime(2024, 3, 1, 10, 20, 30), None]
    got = one(spark, X.parse_ts("x"), [("08-12-2018 09:30",)], "x string")
    assert got == [dt.datetime(2018, 12, 8, 9, 30)]


def test_parse_ts_bad_text_raises(spark):
    with pytest.raises(Exception):
        spark.createDataFrame([("2018-12-08",)], "x string").select(X.parse_ts("x")).collect()


def test_flag_and_absolute(spark):
    # F16 + F5: trim 10 -> false, -10.1 -> true, NULL -> false.
    expr = X.flag(F.col("t").isNotNull() & (X.absolute("t") > 10))
    assert one(spark, expr, [(10.0,), (-10.1,), (None,)], "t double") == [False, True, False]


def test_key_default_lower_text_and_ids(spark):
    rows = [(None, 5), ("x", None)]
    assert one(spark, X.key_default("a"), rows, "a string, b int") == ["unknown", "x"]
    assert one(spark, X.lower_text("b"), [("AbC", 12)], "a string, b int") == ["12"]
    ids = one(spark, X.surrogate_id("a"), [("x",), ("x",), ("y",)], "a string")
    assert ids[0] == ids[1] != ids[2]


def test_days_before_and_dates(spark):
    as_of = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    got = one(spark, X.days_before(3, as_of), [(1,)], "a int")
    assert got == [dt.datetime(2024, 1, 7, 12, 0)]
    got = spark.createDataFrame([(dt.datetime(2019, 5, 6, 7, 8),)], "t timestamp_ntz").select(
        X.day_of("t"), X.year_of("t")
    ).first()
    assert tuple(got) == (dt.date(2019, 5, 6), 2019)


def test_first_match_order_and_per_hundred(spark):
    expr = X.first_match([(F.col("x") > 10, "big"), (F.col("x") > 5, "mid")], "small")
    assert one(spark, expr, [(11,), (7,), (1,)], "x int") == ["big", "mid", "small"]
    assert one(spark, X.per_hundred("a", "b"), [(1.0, 4.0)], "a double, b double") == [25.0]
    assert one(spark, X.per_hundred("a", "b", safe=True), [(1.0, 0.0)], "a double, b double") == [None]


def test_casts(spark):
    assert one(spark, X.to_int("b"), [(True,), (False,)], "b boolean") == [1, 0]
    assert one(spark, X.to_text(F.encode("s", "UTF-8")), [("héllo",)], "s string") == ["héllo"]
    assert one(spark, X.upper_text("s"), [("ab",)], "s string") == ["AB"]
