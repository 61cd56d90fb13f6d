"""Aggregates, percentiles, top-n per group, sorts and unions
(A1-A13, P11, W1, W2, O1-O4, U1)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Exact percentiles without gathering the column in one task
# --------------------------------------------------------------------------


# Rows of a bracket that are counted by value on the driver.
PICK_ROWS = 10_000


def _aside(v: Column, lo: float, hi: float) -> tuple[Column, Column]:
    """Rows below a bracket, and rows in it."""
    return F.count(F.when(v < F.lit(lo), 1)), F.count(F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), 1))


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10_000, pick_rows: int = PICK_ROWS) -> list[float | None]:
    """Exact percentiles of ``column`` with linear interpolation; NULL and
    NaN are skipped (the same definition as ``quantile_cont`` /
    ``percentile`` / a data-frame ``quantile``).

    No pass shuffles the column or gathers it in one task:

    1. one pass counts the rows and takes ``percentile_approx`` sketches just
       below and above each wanted rank: a bracket for each;
    2. one pass counts, for every bracket, the rows below and inside it (a
       bracket that misses its rank is opened on that side);
    3. a bracket with more than ``pick_rows`` rows is narrowed by sketches of
       its own rows, which divides them by about ``accuracy`` each time, so
       two or three passes do for any size; one whose ends are equal is done;
    4. the few rows inside are counted by value and the ranks are picked.

    Returns one float (or None for an empty input) per probability.
    """
    probs = [float(p) for p in probs]
    if any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must be in [0, 1]")
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    v = F.col("v")
    margin = 2.0 / accuracy
    edges = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    first = values.agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.percentile_approx(v, edges, accuracy).alias("q")).first()
    total = int(first["n"])
    if not total:
        return [None for _ in probs]
    at = dict(zip(edges, first["q"], strict=True))
    ranks = {p: ((total - 1) * p) for p in probs}
    found: dict[int, float] = {}
    wanted = sorted({r for pos in ranks.values() for r in (math.floor(pos), math.ceil(pos))})
    # Rank -> its bracket.
    open_ = {}
    for p, pos in ranks.items():
        for r in (math.floor(pos), math.ceil(pos)):
            open_[r] = (at[min(1.0, max(0.0, p - margin))], at[min(1.0, max(0.0, p + margin))])
    while open_:
        brackets = sorted(set(open_.values()))
        counts = values.agg(*[c.alias(f"{k}{i}") for i, (lo, hi) in enumerate(brackets) for k, c in zip("bi", _aside(v, lo, hi), strict=True)]).first()
        below = {x: (int(counts[f"b{i}"]), int(counts[f"i{i}"])) for i, x in enumerate(brackets)}
        narrow: dict[tuple[float, float], list[int]] = {}
        for r, (lo, hi) in list(open_.items()):
            before, inside = below[lo, hi]
            if r < before:
                open_[r] = (first["lo"], lo)
            elif r >= before + inside:
                open_[r] = (hi, first["hi"])
            elif lo == hi:
                found[r] = lo
                del open_[r]
            elif inside <= pick_rows:
                narrow.setdefault((lo, hi), []).append(r)
            else:
                part = values.where((v >= F.lit(lo)) & (v <= F.lit(hi)))
                share = (r - before) / max(1, inside - 1)
                q = part.agg(F.percentile_approx(v, [max(0.0, share - margin), min(1.0, share + margin)], accuracy).alias("q")).first()["q"]
                open_[r] = (q[0], q[1]) if (q[0], q[1]) != (lo, hi) else _halved(part, r - before, lo, hi)
        for (lo, hi), some in narrow.items():
            before = below[lo, hi][0]
            steps = values.where((v >= F.lit(lo)) & (v <= F.lit(hi))).groupBy("v").count().collect()
            for value, n in sorted((x["v"], x["count"]) for x in steps):
                for r in some:
                    if before <= r < before + n:
                        found[r] = value
                        open_.pop(r)
                before += n
    assert all(r in found for r in wanted)
    out = []
    for p in probs:
        lo_rank, hi_rank = math.floor(ranks[p]), math.ceil(ranks[p])
        lo_v, hi_v = found[lo_rank], found[hi_rank]
        out.append(lo_v if lo_rank == hi_rank else lo_v + (hi_v - lo_v) * (ranks[p] - lo_rank))
    return out


def _halved(part: DataFrame, rank: int, lo: float, hi: float) -> tuple[float, float]:
    """Half of a bracket that its sketch could not narrow (values in few
    clumps): the ends move to values that are there."""
    v, middle = F.col("v"), lo / 2 + hi / 2
    got = part.agg(F.count(F.when(v <= middle, 1)).alias("n"), F.max(F.when(v <= middle, v)).alias("under"), F.min(F.when(v > middle, v)).alias("over")).first()
    return (lo, got["under"]) if rank < got["n"] else (got["over"], hi)


def approx_quantiles(df: DataFrame, column: str, probs: Sequence[float], accuracy: int = 10000) -> list[float | None]:
    """Percentiles from ``approx_percentile`` (one aggregate job, a bounded
    sketch per task): each result is a value of the column whose rank is
    within about ``1 / accuracy`` of the wanted one.  NULL and NaN are
    skipped."""
    v = F.col(column).cast("double")
    row = (
        df.select(v.alias("v"))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
        .agg(F.percentile_approx("v", [float(p) for p in probs], accuracy).alias("q"))
        .first()
    )
    if row is None or row["q"] is None:
        return [None for _ in probs]
    return [float(x) for x in row["q"]]


def percentile_band(df: DataFrame, column: str, lo: float = 0.05, hi: float = 0.95, method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Keep rows whose ``column`` lies between its ``lo`` and ``hi``
    percentiles, both ends kept; NULLs drop out.

    The two cut points are computed by a separate, small job and enter the
    plan as literals, so the filter is pushed into the scan like any other
    comparison.  ``method="exact"`` (the default) interpolates like the
    job's data-frame quantile (:func:`exact_quantiles`); ``"approx"`` is the
    opt-in for very large inputs (:func:`approx_quantiles`: one pass, no
    interpolation, rank error about ``1 / accuracy``).
    """
    if method == "exact":
        p_lo, p_hi = exact_quantiles(df, column, [lo, hi])
    elif method == "approx":
        p_lo, p_hi = approx_quantiles(df, column, [lo, hi], accuracy)
    else:
        raise ValueError(f"unknown percentile method {method!r}")
    if p_lo is None:
        return df.where(F.lit(False))
    c = F.col(column)
    return df.where((c >= F.lit(p_lo)) & (c <= F.lit(p_hi)))


# --------------------------------------------------------------------------
# W1 / W2 / U1 / O*
# --------------------------------------------------------------------------


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """Exactly ``n`` rows per group by ``order`` (ties cut by the
    order's later keys, so give a total order).  ``row_number <= n`` lets
    Catalyst insert a per-task group limit before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Concatenate by column name, duplicates kept."""
    out = dfs[0]
    for other in dfs[1:]:
        out = out.unionByName(other)
    return out


def money_mean(col: Column | str, kind: str = "decimal(22,6)") -> Column:
    """A8 for money: exact decimal sum over the count, as a decimal (the
    default is Spark's type for the mean of ``decimal(18,2)``)."""
    c = _col(col)
    return (F.sum(c) / F.count(c)).cast(kind)


def count_where(cond: Column) -> Column:
    """A5: count of rows where ``cond`` holds."""
    return F.count(F.when(cond, F.lit(1)))


def sum_flag(col: Column | str) -> Column:
    """Sum of a boolean as int."""
    return F.sum(_col(col).cast("int"))
