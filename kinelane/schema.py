"""Column types of readings and the parameters of the analyses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The eight fields of a payload, in wire order.
SENSOR = T.StructType([
    T.StructField("road", T.StringType()),
    T.StructField("road_speed", T.IntegerType()),
    T.StructField("road_size", T.IntegerType()),
    T.StructField("x", T.IntegerType()),
    T.StructField("y", T.IntegerType()),
    T.StructField("plate", T.StringType()),
    T.StructField("time", T.DoubleType()),
    T.StructField("direction", T.IntegerType()),
])

# A stored reading: the payload and a stable id that breaks ties in time.
READING = T.StructType([T.StructField("_id", T.LongType()), *SENSOR.fields])

FIELDS = SENSOR.fieldNames()

# What every "per vehicle, in time" window is built on.
VEHICLE = ["plate"]
IN_TIME = ["time", "_id"]


@dataclass(frozen=True)
class Params:
    """Thresholds of the analyses; the defaults are fixed values, the stock settings."""

    live_seconds: float = 60.0        # a plate is active if seen this recently
    lookback_seconds: float = 240.0   # how much further back the live scan reads
    latest: int = 3                   # readings kept per active plate
    top_vehicles: int = 100
    min_infractions: int = 1
    retention_seconds: float = 2_500_000_000.0
    band_start: float = 1_680_000_000.0
    band_end: float = 1_690_000_000.0
    harsh_acc: int = 40
    score_window_seconds: int = 60
    min_score: int = 7


def complete(df: DataFrame) -> DataFrame:
    """Readings with no null (or NaN) in any sensor column."""
    return df.dropna(subset=FIELDS)


def create_history_table(spark: SparkSession, name: str, location: str) -> None:
    """Declare the raw history as a table partitioned by day."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READING.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, event_date DATE) "
        f"USING parquet PARTITIONED BY (event_date) LOCATION '{location}'"
    )


def with_event_date(df: DataFrame) -> DataFrame:
    """Add the partition column: days since the epoch as a date, zone-free.

    Null for a time that no date can hold.
    """
    return df.withColumn(
        "event_date", F.date_from_unix_date(F.floor(F.col("time") / 86400).try_cast("int"))
    )
