"""Passenger table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.functions.exprs import label, upper_text
from tidewater.sinks.files import write_parquet
from tidewater.sources.files import read_csv, read_parquet

# Labels and limits of the passenger job.
SURVIVED_YES = "Выжил"
SURVIVED_NO = "Погиб"
FARE_HIGH = "Дорогой"
FARE_LOW = "Дешёвый"
MIN_AGE = 18
FARE_LIMIT = 50


def adults(df: DataFrame) -> DataFrame:
    """Passengers older than 18, with the upper-cased name, a survival
    label and a fare category (NULL fare -> low); exact repeats removed;
    rows without an age or a port dropped."""
    out = df.where(F.col("Age") > MIN_AGE).withColumns(
        {
            "Name_Upper": upper_text("Name"),
            "Survived_Label": label(F.col("Survived") == 1, SURVIVED_YES, SURVIVED_NO),
            "Fare_Category": label(F.col("Fare") > FARE_LIMIT, FARE_HIGH, FARE_LOW),
        }
    )
    return out.dropDuplicates().na.drop(subset=["Age", "Embarked"])


def run_passengers(spark: SparkSession, csv_path: str, out_path: str, schema: StructType | str | None = None) -> DataFrame:
    """M11 end to end: passenger CSV (types inferred when no ``schema`` is
    given, S1), the adult table, overwritten as Parquet (K1) and read back
    (S3)."""
    write_parquet(adults(read_csv(spark, csv_path, schema=schema)), out_path)
    return read_parquet(spark, out_path)
