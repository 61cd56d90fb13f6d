"""File sinks (K1, K2, K3, K13, K16).  All writes go through Spark's commit
protocol: a failed or lost task is retried and its partial files dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """K1: Parquet, overwrite by default."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True, **options: str) -> None:
    """K2: CSV with a header, overwrite by default."""
    writer = df.write.mode(mode).option("header", str(header).lower())
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)


def write_text(df: DataFrame, path: str, mode: str = "error") -> None:
    """K3: one line per row from a single string column; by default the
    write fails if ``path`` exists."""
    df.write.mode(mode).text(path)


def year_bucket(ts: Column | str, years: Sequence[int], default: str = "default") -> Column:
    """Partition value for K13: the year when it has its own partition,
    else ``default`` (also for NULL timestamps)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    y = F.year(c)
    return F.when(y.isin(list(years)), y.cast("string")).otherwise(F.lit(default))


def write_by_year(df: DataFrame, ts: str, years: Sequence[int], path: str, column: str = "order_year", default: str = "default") -> None:
    """A table range-partitioned by year, with a default partition.

    Dynamic partition overwrite: a rerun replaces only the years it writes.
    Readers that filter on ``column`` prune whole folders.
    """
    out = df.withColumn(column, year_bucket(ts, years, default))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def peek(df: DataFrame, n: int = 5) -> None:
    """Print the schema and the first ``n`` rows."""
    df.printSchema()
    df.show(n, truncate=False)
