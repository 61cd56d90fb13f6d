"""Engine readings profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.exprs import absolute, first_match, flag, per_hundred, round_half_up
from tidewater.operators.analytics import sum_flag
from tidewater.operators.cleaning import keep_positive
from tidewater.operators.sums import SteadySums
from tidewater.session import legacy_parquet_conf
from tidewater.sinks.tables import save_external
from tidewater.sources.files import read_parquet

RPM = "Engine_RPM_RPM"
SPEED = "Vehicle_Speed_km_per_h"
LOAD = "Absolute_Load_pct"
MAF = "MAF_g_per_sec"
STFT1 = "Short_Term_Fuel_Trim_Bank_1_pct"

GROUP_KEYS = ("EngineType", "Generalized_Weight", "driving_mode")

# Mode thresholds (km/h, %), the trim limit (%), and each
# output column as (name, aggregate, input column, rounding digits).
AGGRESSIVE_SPEED, AGGRESSIVE_LOAD = 100, 60
CRUISE_SPEED = (60, 100)
CRUISE_LOAD = (20, 60)
URBAN_SPEED = 30
TRIM_LIMIT = 10
PROFILE_COLUMNS = (
    ("avg_rpm", "avg", "Engine_RPM_RPM", 1),
    ("max_rpm", "max", "Engine_RPM_RPM", 1),
    ("avg_speed_kmh", "avg", "Vehicle_Speed_km_per_h", 2),
    ("max_speed_kmh", "max", "Vehicle_Speed_km_per_h", 2),
    ("avg_maf", "avg", "MAF_g_per_sec", 4),
    ("avg_log_maf", "avg", "log_MAF", 4),
    ("avg_load_pct", "avg", "Absolute_Load_pct", 2),
    ("avg_oat_c", "avg", "OAT_DegC", 2),
    ("avg_stft_b1", "avg", "Short_Term_Fuel_Trim_Bank_1_pct", 4),
    ("avg_ltft_b1", "avg", "Long_Term_Fuel_Trim_Bank_1_pct", 4),
    ("avg_stft_b2", "avg", "Short_Term_Fuel_Trim_Bank_2_pct", 4),
    ("avg_ltft_b2", "avg", "Long_Term_Fuel_Trim_Bank_2_pct", 4),
    ("avg_fuel_consumption_proxy", "avg", "fuel_consumption_proxy", 4),
)



def driving_mode(speed: str = SPEED, load: str = LOAD):
    """aggressive / cruising / urban, else mixed (first match wins)."""
    s, l = F.col(speed), F.col(load)
    return first_match(
        [
            ((s > AGGRESSIVE_SPEED) & (l > AGGRESSIVE_LOAD), "aggressive"),
            (s.between(*CRUISE_SPEED) & l.between(*CRUISE_LOAD), "cruising"),
            (s < URBAN_SPEED, "urban"),
        ],
        "mixed",
    )


def enrich(df: DataFrame) -> DataFrame:
    """Valid readings (RPM and speed present and > 0) with the three derived
    columns: fuel proxy, driving mode, trim anomaly flag."""
    clean = keep_positive(df, [RPM, SPEED])
    return clean.withColumns(
        {
            "fuel_consumption_proxy": per_hundred(MAF, SPEED),
            "driving_mode": driving_mode(),
            "fuel_trim_anomaly": flag(F.col(STFT1).isNotNull() & (absolute(STFT1) > TRIM_LIMIT)),
        }
    )


def engine_profile(df: DataFrame, sort: bool = True) -> DataFrame:
    """Per engine type, weight and driving mode: row count, rounded
    averages and maxima, and the count of trim anomalies.

    One hash aggregate with partial aggregation: every task reduces its
    rows to one buffer per group before the (tiny) shuffle.  A first pass
    fixes the units in which the averages are summed (:class:`SteadySums`).
    Columns absent from the input (e.g. a merged schema without bank 2) read
    as NULL.
    """
    enriched = enrich(df)
    have = set(enriched.columns)
    sums = SteadySums(enriched, [col for _, fn, col, _ in PROFILE_COLUMNS if fn == "avg" and col in have])
    aggs = [F.count(F.lit(1)).alias("record_count")]
    for name, fn, col, digits in PROFILE_COLUMNS:
        if col not in have:
            value = F.lit(None).cast("double")
        else:
            value = sums.mean(col) if fn == "avg" else F.max(col)
        aggs.append(round_half_up(value, digits).alias(name))
    aggs.append(sum_flag("fuel_trim_anomaly").alias("fuel_trim_anomaly_count"))
    out = sums.frame.groupBy(*GROUP_KEYS).agg(*aggs)
    return out.orderBy(*GROUP_KEYS) if sort else out


def run_engine_profile(spark: SparkSession, input_path: str, table: str, output_path: str) -> DataFrame:
    """M12 end to end: legacy Parquet read rules (S5), all files under
    ``input_path`` with their schemas merged (S4), the profile, saved as an
    external table at ``output_path`` (K6).  Returns the saved table."""
    legacy_parquet_conf(spark)
    out = engine_profile(read_parquet(spark, input_path, merge_schema=True))
    save_external(out, table, output_path)
    return spark.table(table)
