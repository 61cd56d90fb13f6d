"""Spreading under-split scans (and leaving well-split ones alone)."""

from __future__ import annotations

from tidewater.operators.partitioning import scan_splits, spread


def test_single_split_scan_is_spread(spark, tmp_dir):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_dir}/one")
    df = spark.read.parquet(f"{tmp_dir}/one")
    assert scan_splits(df) == 1
    out = spread(df, min_partitions=16)
    assert out.rdd.getNumPartitions() == 16
    assert sorted(r.id for r in out.collect()) == list(range(1000))


def test_well_split_scan_is_left_alone(spark, tmp_dir):
    spark.range(1000).repartition(8).write.parquet(f"{tmp_dir}/eight")
    df = spark.read.parquet(f"{tmp_dir}/eight")
    n = scan_splits(df)
    assert n is not None and n > 1
    # half the slots busy already: no shuffle for the other half
    assert spread(df, min_partitions=2 * n) is df
