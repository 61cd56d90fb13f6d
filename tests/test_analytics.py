"""Percentiles, band, top-n, daily extremes."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import analytics as A
from tidewater.plans.weather import daily_extremes


def test_quantiles_of_squares(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(11)], "t double")
    assert A.exact_quantiles(df, "t", [0.05, 0.95]) == [0.5, 90.5]


def test_quantiles_skip_null_nan_and_empty(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "t double")
    assert A.exact_quantiles(df, "t", [0.0, 0.5, 1.0]) == [1.0, 2.0, 3.0]
    assert A.exact_quantiles(df.where("t > 100"), "t", [0.5]) == [None]


@settings(max_examples=15, deadline=None)
@given(
    values=st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=300),
    probs=st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=4),
    accuracy=st.sampled_from([2, 10, 10_000]),
)
def test_quantiles_match_numpy(spark, values, probs, accuracy):
    # Heavy duplicates (a few dozen distinct values) and any sketch size.
    df = spark.createDataFrame([(float(v),) for v in values], "t double")
    got = A.exact_quantiles(df, "t", probs, accuracy=accuracy)
    want = [float(np.quantile(np.array(values, dtype=float), p)) for p in probs]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


@settings(max_examples=12, deadline=None)
@given(
    values=st.lists(st.integers(min_value=-1000, max_value=1000), min_size=1, max_size=400),
    probs=st.lists(st.floats(min_value=0, max_value=1), min_size=1, max_size=3),
    accuracy=st.integers(min_value=2, max_value=20),
    pick=st.integers(min_value=1, max_value=8),
)
def test_quantiles_narrow_large_brackets(spark, values, probs, accuracy, pick):
    # Coarse sketches and a tiny last bracket force several narrowing rounds.
    df = spark.createDataFrame([(float(v),) for v in values], "t double")
    got = A.exact_quantiles(df, "t", probs, accuracy=accuracy, pick_rows=pick)
    want = [float(np.quantile(np.array(values, dtype=float), p)) for p in probs]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_band_keeps_both_ends(spark):
    df = spark.createDataFrame([(float(i),) for i in range(21)], "t double")
    kept = sorted(r.t for r in A.percentile_band(df, "t", 0.05, 0.95).collect())
    assert kept[0] == 1.0 and kept[-1] == 19.0 and len(kept) == 19


def test_top_n_ties_by_later_key(spark):
    df = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0), (1, "c", 1.0), (2, "z", 0.0)], "g int, d string, v double")
    top = A.top_n(df, ["g"], [F.col("v").desc(), F.col("d").asc()], 1)
    assert sorted((r.g, r.d) for r in top.collect()) == [(1, "a"), (2, "z")]


def readings(spark, rows):
    return spark.createDataFrame(rows, "noted_date string, temp double, `out/in` string")


def test_daily_extremes_edge_rows(spark):
    rows = [
        # year 2018: 3 days -> each day appears in both lists
        ("01-01-2018 10:00", 10.0, "In"),
        ("02-01-2018 10:00", 20.0, "In"),
        ("03-01-2018 10:00", 20.0, "In"),
        ("03-01-2018 11:00", 20.0, "Out"),
        ("04-01-2018 10:00", None, "In"),
    ]
    out = daily_extremes(readings(spark, rows), lo=0.0, hi=1.0)
    got = [(r.noted_date, r.temp) for r in out.collect()]
    assert len(got) == 6
    assert sorted(set(got)) == [(dt.date(2018, 1, 1), 10.0), (dt.date(2018, 1, 2), 20.0), (dt.date(2018, 1, 3), 20.0)]
    assert out.columns == ["noted_date", "temp", "out_in"]


def test_daily_extremes_ranks_equal_means_by_date(spark):
    rows = [(f"{d:02d}-03-2019 08:00", 30.0 if d in (4, 9) else float(d), "In") for d in range(1, 13)]
    out = daily_extremes(readings(spark, rows), lo=0.0, hi=1.0, n=1)
    hottest = [r for r in out.collect() if r.temp == 30.0]
    assert [r.noted_date for r in hottest] == [dt.date(2019, 3, 4)]


def test_daily_mean_rounds_half_even(spark):
    rows = [("05-05-2020 01:00", 2.0005, "In"), ("06-05-2020 01:00", 0.0125, "In")]
    out = daily_extremes(readings(spark, rows), lo=0.0, hi=1.0)
    assert {r.temp for r in out.collect()} == {2.001, 0.012}


def test_recent_window_with_old_data_is_empty(spark):
    rows = [("01-01-2018 10:00", 1.0, "In"), ("02-01-2018 10:00", 2.0, "In")]
    out = daily_extremes(readings(spark, rows), days=3)  # now = the clock
    assert out.count() == 0


def test_bad_date_text_raises(spark):
    with pytest.raises(Exception):
        daily_extremes(readings(spark, [("2018/01/01", 1.0, "In")])).collect()


def test_union_all_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    assert A.union_all(a, a.select("v", "k")).count() == 2


def test_approx_band_is_close_to_exact(spark):
    df = spark.range(0, 10001).selectExpr("CAST(id AS DOUBLE) AS t")
    exact = A.exact_quantiles(df, "t", [0.05, 0.95])
    approx = A.approx_quantiles(df, "t", [0.05, 0.95], accuracy=10000)
    assert all(abs(a - e) <= 10001 / 10000 + 1 for a, e in zip(approx, exact))
    kept = A.percentile_band(df, "t", method="approx").count()
    assert abs(kept - A.percentile_band(df, "t").count()) <= 4
    assert A.approx_quantiles(df.where("t < 0"), "t", [0.5]) == [None]
    with pytest.raises(ValueError):
        A.percentile_band(df, "t", method="nearest")


def test_daily_extremes_with_approx_band(spark):
    # 101 distinct readings: the 5 % and 95 % points are exact values, so
    # the approximate band keeps the same rows and the days agree.
    rows = [(f"{(i % 28) + 1:02d}-0{(i // 28) % 3 + 1}-2020 10:00", float(i), "In") for i in range(101)]
    df = spark.createDataFrame(rows, "noted_date string, temp double, `out/in` string")
    exact = sorted(tuple(r) for r in daily_extremes(df).collect())
    approx = sorted(tuple(r) for r in daily_extremes(df, band_method="approx").collect())
    assert exact and approx == exact
