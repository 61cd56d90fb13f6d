"""Daily extremes of sensor readings (M3, M4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewater.functions.exprs import day_of, parse_ts, round_half_even, year_of
from tidewater.operators.analytics import percentile_band, top_n, union_all
from tidewater.operators.cleaning import since
from tidewater.operators.sums import SteadySums
from tidewater.sinks.tables import append_incremental, append_table, full_refresh, replace_table, table_exists
from tidewater.sources.files import read_csv_by_name, rejected_csv

# Reading format and defaults of the job.
READING_FORMAT = "dd-MM-yyyy HH:mm"
INSIDE = "In"

# The columns of a sensor reading file, and of the target table.
READINGS_SCHEMA = "id STRING, `room_id/id` STRING, noted_date STRING, temp DOUBLE, `out/in` STRING"
TARGET_COLUMNS = ("noted_date", "temp", "out_in")


def daily_extremes(
    df: DataFrame,
    ts: str = "noted_date",
    temp: str = "temp",
    side: str = "out/in",
    keep: str = INSIDE,
    lo: float = 0.05,
    hi: float = 0.95,
    n: int = 5,
    digits: int = 3,
    days: int | None = None,
    as_of: Column | None = None,
    out_side: str = "out_in",
    band_method: str = "exact",
) -> DataFrame:
    """M3 (and M4 with ``days``): the ``n`` hottest and ``n`` coldest days
    of every year.

    Steps: keep ``side == keep``; parse text timestamps; (M4) keep the last
    ``days`` before ``as_of`` - the band below is then computed on that
    window only; drop readings outside the [lo, hi] percentile band (both
    ends kept); mean per day, rounded half-to-even to ``digits``; per year
    the top and bottom ``n`` days (equal means: earlier day first), hottest
    list then coldest list, a day kept twice when in both.  ``band_method``
    "approx" computes the band in one pass for very large inputs.

    Output: ``noted_date`` DATE, ``temp`` DOUBLE, ``out_side`` STRING.
    """
    ts_col = F.col(ts)
    if isinstance(df.schema[ts].dataType, StringType):
        ts_col = parse_ts(ts, READING_FORMAT)
    x = df.where(F.col(side) == F.lit(keep)).select(
        ts_col.alias("_ts"), F.col(temp).cast("double").alias("temp"), F.col(side).alias(out_side)
    )
    if days is not None:
        x = since(x, "_ts", days, as_of)
    x = percentile_band(x, "temp", lo, hi, method=band_method)
    sums = SteadySums(x, ["temp"])
    daily = sums.frame.groupBy(day_of("_ts").alias("noted_date"), out_side).agg(
        round_half_even(sums.mean("temp"), digits).alias("temp")
    )
    daily = daily.withColumn("_year", year_of("noted_date"))
    hottest = top_n(daily, ["_year"], [F.col("temp").desc(), F.col("noted_date").asc()], n)
    coldest = top_n(daily, ["_year"], [F.col("temp").asc(), F.col("noted_date").asc()], n)
    return union_all(hottest, coldest).select("noted_date", "temp", out_side)


def read_readings(spark: SparkSession, path: str, schema: str = READINGS_SCHEMA, rejects: str | None = None) -> DataFrame:
    """A sensor reading CSV with a header, read by the header's names;
    ``noted_date`` stays text and is parsed by :func:`daily_extremes`.  A bad
    row raises; with ``rejects`` the bad rows are that table's rows."""
    if rejects is None:
        return read_csv_by_name(spark, path, schema)
    replace_table(rejected_csv(spark, path, schema), rejects)
    return read_csv_by_name(spark, path, schema, bad="reject")


def run_daily_extremes(spark: SparkSession, csv_path: str, table: str, path: str | None = None, rejects: str | None = None) -> DataFrame:
    """M3 end to end: readings file -> daily extremes -> appended to
    ``table`` (a rerun appends again, as the job does; D4)."""
    out = daily_extremes(read_readings(spark, csv_path, rejects=rejects))
    append_table(out, table, list(TARGET_COLUMNS), path)
    return out


def run_full_or_incremental(
    spark: SparkSession,
    csv_path: str,
    full_table: str,
    incremental_table: str,
    days: int = 3,
    as_of: Column | None = None,
    keys: list[str] | None = None,
    full_path: str | None = None,
    incremental_path: str | None = None,
    rejects: str | None = None,
) -> str:
    """M5 with M3 / M4: the first run (``full_table`` absent or empty)
    replaces ``full_table`` with the extremes of all readings; later runs
    append the extremes of the last ``days`` days before ``as_of`` to
    ``incremental_table`` (the band is computed on that window only, D5).
    ``keys`` makes the append idempotent.  Returns "full" or "incremental".
    """
    readings = read_readings(spark, csv_path, rejects=rejects)
    cols = list(TARGET_COLUMNS)
    if not table_exists(spark, full_table) or spark.table(full_table).isEmpty():
        full_refresh(daily_extremes(readings), full_table, cols, full_path)
        return "full"
    recent = daily_extremes(readings, days=days, as_of=as_of)
    append_incremental(recent, incremental_table, cols, keys, incremental_path)
    return "incremental"
