"""Sensor readings derived from the ``events`` table.

One user is one vehicle; time is compressed 600 times so that a minute holds
several readings of a vehicle.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelane.operators.kinematics import LOOKS_BACK
from kinelane.operators.ordered import (
    COPY,
    SEG,
    SEGMENT_ROWS,
    own,
    running_total,
    split_hot_keys,
)
from kinelane.schema import READING

# Fixed values of the derivation.
EPOCH = "timestamp_ntz'2024-01-01 00:00:00'"
START = 1_685_000_000
ROADS = 8
#: Time is compressed so many times, so this many microseconds become one millisecond.
MICROS_OF_MS = 600_000

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_after(events: DataFrame, time: float) -> DataFrame:
    """Events whose readings can be after ``time``, as a bound that reaches the scan.

    The bound may let a few more events through; the exact filter follows on readings.
    """
    micros = max(0, math.floor((float(time) - START) * 1000) - 1) * 600_000
    since = datetime.datetime(2024, 1, 1) + datetime.timedelta(microseconds=micros)
    return events.filter(F.col("ts") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))


def readings(
    events: DataFrame,
    clustered: bool = True,
    at_most: int | None = None,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Events -> readings.

    ``clustered`` lays the rows out by plate, cutting plates that are too big for
    a task, so that this derivation and the windows that follow share one
    shuffle. Leave it out for queries that need neither x nor such a window.
    ``at_most`` bounds the number of events, if the caller knows it.
    """
    # Microseconds since the epoch above, independent of the session zone.
    micros = f"cast(cast(cast(ts - {EPOCH} as interval second) as decimal(20,6)) * 1000000 as bigint)"
    # Stated as text: each call that builds a column costs the driver several round trips.
    base = events.selectExpr(
        "event_id as _id",
        "user_id",
        "concat(chr(65 + (user_id div 1000) % 26), 'A', lpad(user_id % 1000, 3, '0')) as plate",
        "cast(regexp_extract(props, '([0-9]+)', 1) as int) as _k",
        "if(user_id % 2 = 0, 1, -1) as direction",
        "if(event_type <=> 'error', 0, cast(floor(value * 2) as int)) as _step",
        f"{micros} div {MICROS_OF_MS} as _ms",
    )

    vehicle, in_time = ["plate", "user_id"], ["_ms", "_id"]
    if clustered:
        at_most = events.count() if at_most is None else at_most
        base = split_hot_keys(
            base, ["plate"], in_time, segment_rows, at_most, before=LOOKS_BACK
        )
    layout = ["plate"] if clustered else []
    base = running_total(base, vehicle, in_time, F.col("_step"), "_dist", layout)

    derived = base.selectExpr(
        "*", f"cast((user_id * 7 + _ms div (600000 * (1 + user_id % 5))) % {ROADS} as int) as _road"
    ).selectExpr("*", "50000 + 2500 * _road as road_size")
    x, y = mirrored(F.expr("cast(_dist as int)"), F.expr("_k % 2"), F.lit(2))
    return derived.select(
        "_id",
        F.expr("concat('road', _road) as road"),
        F.expr("120 + 10 * _road as road_speed"),
        "road_size",
        x,
        y,
        "plate",
        F.expr(f"cast({START} as double) + cast(_ms as double) / 1000 as time"),
        "direction",
        *[c for c in base.columns if c in (SEG, COPY)],
    )


def extent(events: DataFrame) -> tuple[int, float | None]:
    """How many readings the events give and the latest time, without deriving them."""
    since = f"cast(cast(max(ts) - {EPOCH} as interval second) as decimal(20,6))"
    ms = f"cast({since} * 1000000 as bigint) div {MICROS_OF_MS}"
    return tuple(events.selectExpr("count(1)", f"cast({START} as double) + cast({ms} as double) / 1000").first())


def mirrored(x, y, lanes):
    """Backward traffic counts x from the far end and uses the lanes past ``lanes``."""
    forward = F.col("direction") == 1
    return (
        F.when(forward, x).otherwise(F.col("road_size") - x).alias("x"),
        F.when(forward, y).otherwise(y + lanes).alias("y"),
    )


def plain(rows: DataFrame) -> DataFrame:
    """The stored columns only, in their order."""
    return own(rows).select(*READING.fieldNames())
