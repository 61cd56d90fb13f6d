"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_splits(df: DataFrame) -> int | None:
    """Number of input splits of a plain scan (planning only, no job), or
    None when it cannot be known without running the plan."""
    try:
        return df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - e.g. Spark Connect
        return None


def spread(df: DataFrame, min_partitions: int | None = None, idle_share: float = 0.75) -> DataFrame:
    """Spread a scan that would leave most task slots idle.

    A file written as one row group is read by one task, and every row-wise
    step after it (JSON/XML building and parsing, casts) then runs on one
    core.  When the scan has at most ``1 - idle_share`` of ``min_partitions``
    splits (default: a quarter of the default parallelism) its rows are
    redistributed over ``min_partitions`` partitions.  A scan with more
    splits than that is left as it is: big tables on a cluster already have
    thousands of splits, and a moderately split one does not pay for a full
    shuffle.  Rows go by a hash of all their columns: balanced, repeatable on
    a task retry, and without the local sort a round-robin repartition needs
    for that.

    Call it on a freshly read source only: on a plan with shuffles, counting
    partitions would execute the plan.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = scan_splits(df)
    if n is None or n > target * (1 - idle_share):
        return df
    return df.repartition(target, F.xxhash64(*[F.col(c) for c in df.columns]))
