"""Order-free sums and means of doubles."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tidewater.operators.sums import SteadySums


def bits(x):
    return None if x is None else float(x).hex()


def means(df, key="k", column="x"):
    sums = SteadySums(df, [column])
    rows = sums.frame.groupBy(key).agg(sums.mean(column).alias("m"), sums.sum(column).alias("s")).collect()
    return {r[key]: (r["m"], r["s"]) for r in rows}


@pytest.mark.parametrize("width", [0, 6, 40, 290])
def test_same_bits_under_any_partitioning_and_close_to_exact(spark, width):
    rng = random.Random(width)
    rows = [(i % 3, rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-width, width)) for i in range(3000)]
    seen = []
    for n in (1, 2, 3, 7, 16):
        rng.shuffle(rows)
        got = means(spark.createDataFrame(rows, "k int, x double").repartition(n))
        seen.append({k: (bits(m), bits(s)) for k, (m, s) in got.items()})
    assert all(s == seen[0] for s in seen)
    for k, (m, s) in got.items():
        values = [Fraction(x) for j, x in rows if j == k]
        assert s == float(sum(values)) and m == float(sum(values) / len(values))


@pytest.mark.parametrize(
    ("values", "mean"),
    [
        ([float("nan"), 1.0], math.nan),
        ([float("inf"), 1.0], math.inf),
        ([float("-inf"), 1.0, None], -math.inf),
        ([float("inf"), float("-inf")], math.nan),
        ([1e-10, 3e-10], 2e-10),
        ([1e30], 1e30),
        ([1e30, 1.0, -1e30], 1.0 / 3),
        ([1.7e308, 1.7e308], 1.7e308),
        ([5e-324, 5e-324], 5e-324),
        ([5e-324, -1.7e308, 1.7e308], 0.0),
        ([0.0, -0.0], 0.0),
        ([0.1, 0.2, 0.3, None], 0.2),
        ([None, None], None),
    ],
)
def test_special_and_wide_values(spark, values, mean):
    got = means(spark.createDataFrame([(1, v) for v in values], "k int, x double"))[1][0]
    assert got == mean or (mean != mean and math.isnan(got))


def test_small_values_beside_large_ones_keep_their_digits(spark):
    """Groups of one column differ by 40 orders of magnitude."""
    rows = [("large", 1e30), ("large", 3e30), ("small", 1e-10), ("small", 3e-10), ("odd", float("nan")), ("none", None)]
    got = means(spark.createDataFrame(rows, "k string, x double"))
    assert got["large"][0] == 2e30 and got["small"][0] == 2e-10 and math.isnan(got["odd"][0]) and got["none"] == (None, None)


def test_empty_input_many_columns_and_clashing_names(spark):
    schema = "k int, x double, steady_0 double, `a b` int"
    empty = SteadySums(spark.createDataFrame([], schema), ["x", "a b"])
    assert empty.frame.agg(empty.mean("x").alias("m"), empty.sum("a b").alias("s")).first() == (None, None)
    df = spark.createDataFrame([(1, 0.5, 7.0, 3), (1, 1.5, 8.0, 4)], schema)
    sums = SteadySums(df, ["x", "steady_0", "a b"])
    assert tuple(sums.frame.agg(*[sums.mean(c) for c in ("x", "steady_0", "a b")]).first()) == (1.0, 7.5, 3.5)
    assert sums.frame.columns[:4] == df.columns


def test_plan_stays_in_the_jvm_with_one_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), (F.col("id") / 7).alias("x"))
    sums = SteadySums(df, ["x"])
    plan = sums.frame.groupBy("k").agg(sums.mean("x"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan and "decimal" not in plan
