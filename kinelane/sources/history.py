"""The raw history of readings: scans and appends, by format and options."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelane.functions.payload import impose_types
from kinelane.schema import FIELDS, READING, with_event_date

STORED = T.StructType([*READING.fields, T.StructField("event_date", T.DateType())])

# Documents as text, whatever a store makes of their numbers.
DOCUMENT = T.StructType([T.StructField(c, T.StringType()) for c in ("_id", *FIELDS)])


def read_history(
    spark: SparkSession,
    path: str | None = None,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    schema: T.StructType = DOCUMENT,
) -> DataFrame:
    """All readings, in a stated schema; nothing is inferred.

    A document store (its format and options, no path) takes anything, so its fields are
    read as text, or by ``schema``, and cast. Incomplete readings stay, from any source:
    they count for the speed of the next one, and the analyses drop them afterwards.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if path is None:
        return impose_types(_with_id(reader.schema(schema).load()))
    return reader.schema(STORED).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    column: str = "x",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Readings from a warehouse table, in parallel slices of an integer column.

    Secrets and the driver class go in ``options``, from the caller.
    """
    options = jdbc_options(url, table, lower, upper, partitions, column, options)
    return impose_types(_with_id(spark.read.format("jdbc").options(**options).load()))


def jdbc_options(
    url: str,
    table: str,
    lower: int,
    upper: int,
    partitions: int,
    column: str,
    options: Mapping[str, str] | None = None,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
        **(options or {}),
    }


def _with_id(df: DataFrame) -> DataFrame:
    """A numeric id: the store's own, or a hash of it, or of the fields in wire order."""
    if dict(df.dtypes).get("_id") == "bigint":
        return df
    source = ["_id"] if "_id" in df.columns else [c for c in FIELDS if c in df.columns]
    return df.withColumn("_id", F.xxhash64(*[F.col(c).cast("string") for c in source]))


def since(history: DataFrame, time: float) -> DataFrame:
    """Readings after ``time``, with the folders of earlier days pruned."""
    if "event_date" in history.columns:
        first_day = F.date_from_unix_date(F.lit(math.floor(time / 86400)))
        history = history.filter(F.col("event_date") >= first_day)
    return history.filter(F.col("time") > F.lit(float(time)))


def append_history(rows: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append readings to the history, in one folder per day."""
    _by_day(rows).write.format(fmt).mode("append").partitionBy("event_date").save(path)


def append_jdbc(rows: DataFrame, url: str, table: str, options: Mapping[str, str]) -> None:
    """Append a batch to a warehouse table; each task commits its own slice."""
    writer = rows.write.format("jdbc").mode("append")
    writer.options(**{"url": url, "dbtable": table, "batchsize": "10000", **options}).save()


def compact_history(history: DataFrame, path: str, files: int, file_rows: int = 50_000_000) -> None:
    """Rewrite a history to a new path: a few big files per day, sorted by vehicle.

    ``files`` is about the bytes of the history by the bytes of a file; none gets more
    than ``file_rows`` rows.

    Range bounds over the whole sort key spread a busy day or plate over as many
    files as it needs, and leave tight min/max statistics for scans by plate.
    """
    keys = ["event_date", "plate", "time", "_id"]
    (
        _by_day(history)
        .repartitionByRange(max(1, files), *keys)
        .sortWithinPartitions(*keys)
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", file_rows)
        .partitionBy("event_date")
        .parquet(path)
    )


def _by_day(rows: DataFrame) -> DataFrame:
    return with_event_date(rows).select(*STORED.fieldNames())
