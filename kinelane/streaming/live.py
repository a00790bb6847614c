"""Live answers kept up on the stream, each with its bound against the exact analysis.

* Numbers of plates and roads as mergeable sketches by bucket of time. Nothing is dropped
  for being late: a batch adds its sketches, and a count unions those of its buckets.
* Vehicles whose scores add up, as sliding windows with a watermark on a grid.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kinelane.operators.history import in_band
from kinelane.schema import FIELDS, Params
from kinelane.sources.files import exists, names, remove
from kinelane.streaming.ingest import EVERY

#: A sketch has two to this power registers.
PRECISION = 14
#: Relative error that a count of sketches keeps in 997 of 1,000 cases: three times the
#: standard error of 1.04 by the root of the registers.
SKETCH_ERROR = 3 * 1.04 / 2 ** (PRECISION / 2)
BUCKET_SECONDS = 10

SKETCHES = "bucket bigint, plates binary, roads binary"


# --- counts ----------------------------------------------------------------------------


def sketches(readings: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """bucket, plates, roads: sketches of the readings of each bucket of time."""
    bucket = F.floor(F.col("time") / bucket_seconds).cast("bigint").alias("bucket")
    return readings.dropna(subset=["time"]).groupBy(bucket).agg(
        F.hll_sketch_agg("plate", PRECISION).alias("plates"),
        F.hll_sketch_agg("road", PRECISION).alias("roads"),
    )


def start_sketches(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    bucket_seconds: int = BUCKET_SECONDS,
    trigger: Mapping = EVERY,
) -> StreamingQuery:
    """Add the sketches of each batch to ``path``; a batch that comes again replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        rows = sketches(batch, bucket_seconds)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = readings.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _numbers(spark: SparkSession, path: str, label: str) -> list[int]:
    found = (name.partition("=") for name in names(spark, path))
    numbers = sorted(int(number) for kind, _, number in found if kind == label)
    return [n for n in numbers if exists(spark, f"{path}/{label}={n}/_SUCCESS")]


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The newest merged table, and the tables of the batches after it."""
    merged = _numbers(spark, path, "merged")[-1:]
    after = merged[0] if merged else -1
    batches = [f"{path}/batch={n}" for n in _numbers(spark, path, "batch") if n > after]
    return [*[f"{path}/merged={n}" for n in merged], *batches]


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    folders = _folders(spark, path)
    if not folders:
        return spark.createDataFrame([], SKETCHES)
    return spark.read.schema(SKETCHES).parquet(*folders)


def merge_sketches(
    spark: SparkSession, path: str, since: float, bucket_seconds: int = BUCKET_SECONDS
) -> None:
    """One table for all batches so far, without the buckets before a time.

    Readers switch to it when it is whole. The tables it replaces are deleted by the
    next merge, so a reader has until then.
    """
    batches = _numbers(spark, path, "batch")
    merged = _numbers(spark, path, "merged")
    if not batches or (merged and batches[-1] <= merged[-1]):
        return
    young = read_sketches(spark, path).filter(F.col("bucket") >= int(since // bucket_seconds))
    table = young.groupBy("bucket").agg(
        F.hll_union_agg("plates").alias("plates"), F.hll_union_agg("roads").alias("roads")
    )
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/merged={batches[-1]}")
    for number in merged[:-1]:
        remove(spark, f"{path}/merged={number}")
    for number in batches:
        if merged and number <= merged[-1]:
            remove(spark, f"{path}/batch={number}")


def live_counts(sketched: DataFrame, cut: float, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """n_cars and n_roads seen after ``cut``, by the buckets that lie wholly after it.

    ``most_cars`` and ``most_roads`` take in the bucket that the cut lies in. The exact
    numbers lie between the two, give or take ``SKETCH_ERROR``.
    """
    inside = int(cut // bucket_seconds)
    recent = sketched.filter(F.col("bucket") >= inside)
    whole = F.col("bucket") > inside

    def count(column: str, condition=None):
        value = F.col(column) if condition is None else F.when(condition, F.col(column))
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(value)), F.lit(0).cast("bigint"))

    return recent.agg(
        count("plates", whole).alias("n_cars"), count("roads", whole).alias("n_roads"),
        count("plates").alias("most_cars"), count("roads").alias("most_roads"),
    )


# --- scores ----------------------------------------------------------------------------

_STATE = "x1 long, x2 long, lane int"
SCORED = "plate string, time double, total int"


def scored_stream(readings: DataFrame, params: Params = Params()) -> DataFrame:
    """plate, time, total: readings of a stream as they score, one state for each plate.

    The state is the plate's last two places and its last lane in the band. A plate's
    readings are taken in order of time within a batch and in order of arrival beyond it:
    a reading that comes in after later ones of its plate is scored by those, which the
    exact analysis does not do. Incomplete readings score nothing themselves.
    """
    low, high, harsh = params.band_start, params.band_end, params.harsh_acc

    def score(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["time", "_id"], kind="stable")
        x1, x2, lane = state.get if state.exists else (None, None, None)
        places = pd.Series([x2, x1, *rows["x"]], dtype="float64")
        speed = places.diff().abs()
        acc = speed.diff()[2:].to_numpy()
        speed = speed[2:].to_numpy()
        moving = rows["complete"].to_numpy() & ~pd.isna(acc)
        band = moving & (rows["time"] > low).to_numpy() & (rows["time"] < high).to_numpy()
        inside = rows[band]
        lanes = pd.Series([lane, *inside["y"]], dtype="float64")
        changed = (lanes.diff().fillna(0) != 0)[1:].to_numpy()
        fast = speed[band] > inside["road_speed"].to_numpy()
        rough = abs(acc[band]) > harsh
        total = changed.astype("int32") + 3 * fast.astype("int32") + 3 * rough.astype("int32")
        kept = [None if pd.isna(v) else int(v) for v in (*places.tail(2), lanes.iloc[-1])]
        state.update((kept[1], kept[0], kept[2]))
        yield pd.DataFrame({
            "plate": key[0], "time": inside["time"].to_numpy()[total > 0], "total": total[total > 0],
        })

    missing = F.lit(False)
    for name in FIELDS:
        missing = missing | F.col(name).isNull()
    rows = readings.dropna(subset=["plate", "time"]).select(
        "_id", "plate", "time", "x", "y", "road_speed", (~missing).alias("complete")
    )
    return rows.groupBy("plate").applyInPandasWithState(
        score, SCORED, _STATE, "append", GroupStateTimeout.NoTimeout
    )


class Grid(NamedTuple):
    """Windows on a grid of ``slide`` seconds, closed ``delay`` behind the latest score."""

    slide: int = 10
    delay: str = "10 minutes"


def sliding_scores(scored: DataFrame, params: Params = Params(), grid: Grid = Grid()) -> DataFrame:
    """plate, start, sure, possible: sums of scores in windows on a grid.

    An approximation of the exact analysis, where a window starts at each reading. For the
    readings that came in time, with windows of w seconds and a grid of s seconds:

    * ``sure`` adds up w seconds from a grid point on. If it reaches the limit, so does
      the window of the first reading in it: a plate so found is found exactly as well.
    * ``possible`` adds up w + s seconds and so holds each window that starts in its first
      s: a plate found exactly is found so as well.

    Scores older than the watermark are dropped, which can only lower both.
    """
    width = params.score_window_seconds
    at = F.timestamp_micros((F.col("time") * 1_000_000).cast("bigint"))
    timed = scored.withColumn("at", at).withWatermark("at", grid.delay)
    window = F.window("at", f"{width + grid.slide} seconds", f"{grid.slide} seconds")
    begin = F.unix_micros(F.col("window.start")) / 1_000_000
    near = F.col("time") <= begin + width
    return (
        timed.withColumn("window", window)
        .withColumn("_near", F.when(near, F.col("total")))
        .groupBy("plate", "window")
        .agg(
            F.coalesce(F.sum("_near"), F.lit(0)).alias("sure"), F.sum("total").alias("possible")
        )
        .select("plate", begin.alias("start"), "sure", "possible")
    )


def dangerous(sums: DataFrame, params: Params = Params()) -> DataFrame:
    """plate, sure: plates with a window that may reach the limit, and whether it surely does."""
    found = sums.filter(F.col("possible") >= params.min_score)
    return found.groupBy("plate").agg(F.max(F.col("sure") >= params.min_score).alias("sure"))
