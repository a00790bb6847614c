"""Structured Streaming ingestion: payloads -> raw history and quarantine.

Decoding is stateless, so late readings are never dropped: how far back a late
reading still counts is decided by the time filters of the analyses. Repeats can be
dropped by a state of what arrived lately, which drops nothing late either.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinelane.functions.payload import accepted, decode, encode, rejected
from kinelane.schema import READING, with_event_date
from kinelane.sources.history import STORED

EVERY = {"processingTime": "500 milliseconds"}
BATCH_MESSAGES = 100_000

INGESTED = T.StructType([
    *READING.fields,
    T.StructField("payload", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("event_date", T.DateType()),
])


def kafka_payloads(
    spark: SparkSession,
    servers: str,
    topic: str = "sensor-data",
    max_messages: int = BATCH_MESSAGES,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Payloads of a topic; the id is the message's place in it."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_messages)
        .options(**(options or {}))
        .load()
    )
    place = F.shiftleft(F.col("partition").cast("bigint"), 44) + F.col("offset")
    return stream.select(place.alias("_id"), "value")


def file_payloads(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Payload lines of text files as they arrive.

    Lines have no place of their own in a stream of files, and equal lines of a file are
    different readings, so the id is drawn once and stored with the reading.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    place = F.xxhash64("_metadata.file_path", "value", F.uuid())
    return reader.load(path).select(place.alias("_id"), "value")


def publish(readings: DataFrame, fmt: str, options: Mapping[str, str]) -> None:
    """Send readings as payloads to a topic, or to text files without the newline."""
    lines = encode(readings)
    if fmt == "text":
        lines = lines.select(F.rtrim("value", F.lit("\n")).alias("value"))
    lines.write.format(fmt).options(**options).mode("append").save()


def without_repeats(decoded: DataFrame, within: str) -> DataFrame:
    """Drop readings that were sent before, at most ``within`` ago.

    The same reading is one of the same plate, time and place. What counts is when it
    arrives, not the reading's own time, so nothing is dropped for being late; a repeat
    that comes later than ``within`` is kept. The state holds one key for each reading
    that arrived within that time. Bad lines are all kept.
    """
    arrived = decoded.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    # Bad lines have no fields to compare; their ids differ.
    bad = arrived.withColumn("_bad", F.when(F.col("reason").isNotNull(), F.col("_id")))
    once = bad.dropDuplicatesWithinWatermark(["plate", "time", "x", "y", "_bad"])
    return once.drop("_arrived", "_bad")


def start_ingest(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping = EVERY,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Append payloads to a history folder, each exactly once.

    One pass over the source writes both parts: good readings by day, and bad
    lines with the reason in a part of their own. With ``repeats_within`` a reading that
    is sent again within that time is dropped.
    """
    decoded = decode(payloads, keep=("_id",))
    if repeats_within is not None:
        decoded = without_repeats(decoded, repeats_within)
    good = F.col("reason").isNull()
    rows = with_event_date(decoded).withColumns({
        "accepted": good,
        "payload": F.when(~good, F.col("payload")),
        "event_date": F.when(good, F.col("event_date")),
    })
    return (
        rows.select(*INGESTED.fieldNames())
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("accepted", "event_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """The good readings, as the history the analyses read."""
    rows = spark.read.schema(INGESTED).parquet(path).filter("accepted")
    return rows.select(*STORED.fieldNames())


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(INGESTED).parquet(path).filter("not accepted")
    return rows.select("_id", "payload", "reason")


def start_batches(
    payloads: DataFrame,
    write_good: Callable[[DataFrame], None],
    write_bad: Callable[[DataFrame], None],
    checkpoint: str,
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Hand each non-empty batch to sinks of the caller, such as a warehouse append.

    A batch counts as done after both writes, so one that failed halfway comes
    again: such sinks get each reading at least once.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        decoded = decode(batch, keep=("_id",)).persist()
        try:
            write_good(accepted(decoded))
            write_bad(rejected(decoded))
        finally:
            decoded.unpersist()

    writer = payloads.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
