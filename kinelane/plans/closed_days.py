"""Historical analyses that read only the days that can still change.

Days well behind the latest reading are closed once: what the analyses need of
them is added up in small tables (sums per road, plate-road pairs, infractions,
severe windows), with each plate's last readings to carry on from. A refresh
then computes the open days and merges. The results are those of a full pass;
readings that come in for a closed day make the tables be built anew.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelane.functions import rules
from kinelane.operators import history as past
from kinelane.operators.cursor import scalar
from kinelane.operators.kinematics import LOOKS_BACK, with_kinematics
from kinelane.operators.ordered import SEGMENT_ROWS, split_hot_keys
from kinelane.operators.snapshot import latest_readings
from kinelane.plans.shared import kept, together
from kinelane.schema import IN_TIME, READING, VEHICLE, Params, with_event_date
from kinelane.sources.files import exists, remove
from kinelane.sources.results import literal_rows

DAY = 86400

# The last readings of a plate, which speed and acceleration of its next ones need.
CARRIED = LOOKS_BACK

# A day this far ahead of the clock closes nothing: some clocks run wrong.
AHEAD_DAYS = 1

ADDED_UP = ("roads", "pairs", "infractions", "severe")
LATEST_ONLY = ("tails", "open_scores", "last")
EMPTY = {
    "roads": "road string, n bigint, speeds bigint, sizes bigint, still bigint",
    "pairs": "plate string, road string",
    "infractions": "plate string, time double",
    "severe": "plate string",
    "tails": READING,
    "open_scores": "plate string, _id bigint, time double, total int",
    "last": "plate string, last_speed int, last_lane int",
}

LOG = T.StructType([
    T.StructField("generation", T.IntegerType()),
    T.StructField("through", T.IntegerType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("settings", T.StringType()),
])


class Closed(NamedTuple):
    """The closed days: steps in order, by their last day (days since the epoch)."""

    generation: int
    steps: tuple[int, ...] = ()
    n_rows: int = 0
    settings: str = ""

    @property
    def through(self) -> int | None:
        return self.steps[-1] if self.steps else None


def _settings(params: Params) -> str:
    """What the tables of closed days depend on."""
    if params.min_infractions < 1:
        raise ValueError("plates without infractions are not kept for closed days")
    return repr((
        params.band_start, params.band_end, params.harsh_acc,
        params.score_window_seconds, params.min_score,
    ))


def _day(number: int):
    return F.lit(datetime.date(1970, 1, 1) + datetime.timedelta(days=number))


def _upto(history: DataFrame, through: int | None) -> DataFrame:
    return history.filter(F.lit(False) if through is None else F.col("event_date") <= _day(through))


def _after(history: DataFrame, through: int | None) -> DataFrame:
    return history if through is None else history.filter(F.col("event_date") > _day(through))


def load(spark: SparkSession, base: str) -> Closed | None:
    """The newest generation of closed days."""
    if not exists(spark, f"{base}/log"):
        return None
    log = spark.read.schema(LOG).parquet(f"{base}/log")
    newest = log.agg(F.max("generation")).first()[0]
    if newest is None:
        return None
    # One row per closing, about one a day.
    steps = log.filter(F.col("generation") == newest).orderBy("through").collect()
    last = steps[-1]
    return Closed(newest, tuple(s.through for s in steps), last.n_rows, last.settings)


def _valid(spark: SparkSession, history: DataFrame, base: str, params: Params) -> Closed:
    """The closed days, or a new start if they no longer hold."""
    closed = load(spark, base)
    if closed is None:
        return Closed(0)
    unchanged = _upto(history, closed.through).count() == closed.n_rows
    if unchanged and closed.settings == _settings(params):
        return closed
    return Closed(closed.generation + 1)


def _folder(base: str, generation: int, part: str, step: int) -> str:
    return f"{base}/generation={generation}/{part}/through={step}"


def _read(spark: SparkSession, base: str, closed: Closed, part: str) -> DataFrame:
    steps = closed.steps[-1:] if part in LATEST_ONLY else closed.steps
    if not steps:
        return spark.createDataFrame([], EMPTY[part])
    folders = [_folder(base, closed.generation, part, step) for step in steps]
    return spark.read.schema(EMPTY[part]).parquet(*folders)


@contextmanager
def _parts(
    spark: SparkSession,
    days: DataFrame,
    base: str,
    closed: Closed,
    params: Params,
    segment_rows: int,
    n_rows: int,
) -> Iterator[dict[str, DataFrame]]:
    """The tables for the days, of ``n_rows`` rows, that follow the closed ones."""
    names = READING.fieldNames()
    carried = _read(spark, base, closed, "tails").select(*names)
    fresh = days.select(*names)
    line = carried.withColumn("_new", F.lit(False)).union(fresh.withColumn("_new", F.lit(True)))
    bound = n_rows + carried.count()
    split = split_hot_keys(line, VEHICLE, IN_TIME, segment_rows, bound, before=LOOKS_BACK)
    moving = with_kinematics(split)
    with kept(moving.drop("x", "direction").filter("_new").drop("_new")) as moving:
        # Readings that lack a value are dropped, so what a plate last did in the closed
        # days may lie any number of readings back. It is carried on by itself.
        last = _read(spark, base, closed, "last")
        known = moving.join(last, "plate", "left") if closed.steps else moving.withColumns(
            {c: F.lit(None).cast("int") for c in ("last_speed", "last_lane")}
        )
        flags = past.infraction_flags(known, F.col("last_speed"))
        starts = flags.filter(F.col("change_in_speed") == 1)
        scored = past.driving_scores(known, params, F.col("last_lane"))
        scores = ["plate", "_id", "time", "total"]
        waiting = _read(spark, base, closed, "open_scores").select(*scores)
        with kept(waiting.unionByName(scored.select(*scores))) as line_scores:
            few = bound + waiting.count()
            few = few if few <= segment_rows else None
            far = past.reach(params)
            windows = split_hot_keys(
                line_scores, VEHICLE, IN_TIME, segment_rows, few, before=far, after=far
            )
            yield {
                "roads": moving.groupBy("road").agg(
                    F.count(F.lit(1)).alias("n"),
                    F.sum(F.col("speed").cast("bigint")).alias("speeds"),
                    F.sum(F.col("road_size").cast("bigint")).alias("sizes"),
                    F.count_if(rules.standing_still()).alias("still"),
                ),
                "pairs": fresh.select("plate", "road").distinct(),
                "infractions": starts.select("plate", "time"),
                "severe": past.severe_windows(windows, params).select("plate", "time"),
                "open_scores": line_scores,
                "tails": latest_readings(line.drop("_new"), CARRIED).select(*names),
                "last": _last(last, moving, params),
            }


def _last(before: DataFrame, moving: DataFrame, params: Params) -> DataFrame:
    """Each plate's last speed, and its last lane within the time band."""
    when = F.struct("time", "_id")
    lane = F.when(past.in_band(params), when)
    now = moving.groupBy("plate").agg(
        F.max_by("speed", when).alias("last_speed"),
        F.max_by(F.when(past.in_band(params), F.col("y")), lane).alias("last_lane"),
    )
    both = before.withColumn("_new", F.lit(0)).unionByName(now.withColumn("_new", F.lit(1)))
    # The newer one where there is one; a plate may not have been in the band lately.
    return both.groupBy("plate").agg(
        *(
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_new"))).alias(c)
            for c in ("last_speed", "last_lane")
        )
    )


def close(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    through: int,
    params: Params = Params(),
    segment_rows: int = SEGMENT_ROWS,
) -> Closed:
    """Close all days up to ``through``; the log entry at the end makes it count."""
    closed = _valid(spark, history, base, params)
    if closed.through is not None and through <= closed.through:
        return closed
    days = _upto(_after(history, closed.through), through)
    # A window that starts this late may still get readings of the next day.
    settled = F.col("time") < (through + 1) * DAY - params.score_window_seconds
    added = days.count()  # from file footers, like all row counts of a history
    if not added:
        return closed
    with _parts(spark, days, base, closed, params, segment_rows, added) as parts:
        parts["severe"] = parts["severe"].filter(settled).select("plate")
        parts["open_scores"] = parts["open_scores"].filter(~settled)

        def write(part: str) -> None:
            folder = _folder(base, closed.generation, part, through)
            parts[part].write.mode("overwrite").parquet(folder)

        write("roads")
        rest = [p for p in parts if p != "roads"]
        together(spark, [lambda p=p: write(p) for p in rest])
    n_rows = closed.n_rows + added
    entry = (closed.generation, through, n_rows, _settings(params))
    literal_rows(spark, [entry], LOG).write.mode("append").parquet(f"{base}/log")
    if not closed.steps and closed.generation:
        remove(spark, f"{base}/generation={closed.generation - 1}")
    return Closed(closed.generation, (*closed.steps, through), n_rows, _settings(params))


@contextmanager
def past_analyses(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    params: Params = Params(),
    as_of: float | None = None,
    segment_rows: int = SEGMENT_ROWS,
    open_days: int = 2,
) -> Iterator[tuple[dict[str, DataFrame], int]]:
    """The historical result tables, from closed and open days together.

    Closes first what has fallen behind the last ``open_days`` days. Also tells the
    rows of the whole history.
    """
    if "event_date" not in history.columns:
        history = with_event_date(history)
    # A reading from the future must not close the days that are still coming in.
    plausible = F.col("event_date") <= F.date_add(F.current_date(), AHEAD_DAYS)
    last_day = scalar(history.filter(plausible).agg(F.unix_date(F.max("event_date"))))
    closed = Closed(0)
    if last_day is not None:
        closed = close(spark, history, base, last_day - open_days, params, segment_rows)
    days = _after(history, closed.through)
    n_rows = days.count()
    with _parts(spark, days, base, closed, params, segment_rows, n_rows) as parts:
        parts["severe"] = parts["severe"].select("plate")
        whole = {
            part: _read(spark, base, closed, part).unionByName(parts[part]) for part in ADDED_UP
        }
        tables = {
            "historical2": past.merged_road_stats(whole["roads"]),
            "historical1": past.top_vehicles(whole["pairs"], params),
            "historical3": past.count_infractions(
                whole["infractions"].withColumn("change_in_speed", F.lit(1)), params, as_of
            ),
            "alternative": whole["severe"],
        }
        yield tables, closed.n_rows + n_rows
