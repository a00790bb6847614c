"""One refresh: every analysis from one read of the live and historical data."""

from __future__ import annotations

import time as clock
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kinelane.operators import cursor as cut_off
from kinelane.operators import history as past
from kinelane.operators import live
from kinelane.operators.cursor import Cursor
from kinelane.operators.kinematics import LOOKS_BACK, with_kinematics
from kinelane.operators.ordered import SEGMENT_ROWS, scratch_tables, split_hot_keys
from kinelane.operators.snapshot import snapshot, with_collision_risk
from kinelane.plans import closed_days
from kinelane.plans.shared import kept, together
from kinelane.schema import FIELDS, IN_TIME, VEHICLE, Params
from kinelane.sources import results
from kinelane.sources.history import since

# Result tables by analysis, in the order a run writes them: risk has priority. The names
# are fixed values that readers of the tables know.
LIVE = ("analysis6", "analysis4", "analysis1", "analysis2", "analysis5", "analysis3")
PAST = ("historical1", "historical2", "historical3", "alternative")
TABLES = (*LIVE, *PAST, "times", "lasttimestamp")
TIMED = (*sorted(LIVE), *PAST)


def live_analyses(snap: DataFrame, vehicles: DataFrame) -> dict[str, DataFrame]:
    return {
        "analysis6": live.collision_list(vehicles),
        "analysis4": live.collision_count(vehicles),
        "analysis1": live.road_count(snap),
        "analysis2": live.vehicle_count(snap),
        "analysis5": live.overspeed_list(vehicles),
        "analysis3": live.overspeed_count(vehicles),
    }


def moving_history(
    history: DataFrame, segment_rows: int = SEGMENT_ROWS, at_most: int | None = None
) -> DataFrame:
    """Kinematics of the whole history, with plates too big for a task cut up."""
    rows = history.select("_id", *FIELDS)
    rows = split_hot_keys(rows, VEHICLE, IN_TIME, segment_rows, at_most, before=LOOKS_BACK)
    return with_kinematics(rows).drop("x", "direction")


def past_analyses(
    moving: DataFrame, history: DataFrame, params: Params, as_of: float | None = None
) -> dict[str, DataFrame]:
    return {
        "historical2": past.road_stats(moving),
        "historical1": past.top_vehicles(history, params),
        "historical3": past.banned_vehicles(moving, params, as_of),
        "alternative": past.dangerous_driving(moving, params),
    }


def _observed(observation: Observation) -> dict:
    """What was observed on the way; nothing if there was no row.

    A part of a plan that turns out empty is left out, and what observes it with it.
    """
    try:
        return observation.get
    except Py4JJavaError:
        return {}


@contextmanager
def whole_history(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    params: Params,
    as_of: float | None,
    segment_rows: int,
) -> Iterator[tuple[dict[str, DataFrame], int]]:
    """The historical tables from a full pass over the history, and its rows."""
    n_rows = history.count()
    with kept(moving_history(history, segment_rows, n_rows)) as moving:
        yield past_analyses(moving, history, params, as_of), n_rows


@contextmanager
def open_days(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    params: Params,
    as_of: float | None,
    segment_rows: int,
) -> Iterator[tuple[dict[str, DataFrame], int]]:
    """The same from closed days and a pass over the open ones."""
    closed = f"{base}/closed_days"
    with closed_days.past_analyses(spark, history, closed, params, as_of, segment_rows) as found:
        yield found


def run_once(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    run_id: int,
    cursor: Cursor,
    params: Params = Params(),
    as_of: float | None = None,
    segment_rows: int = SEGMENT_ROWS,
    historical=whole_history,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    newest: DataFrame | None = None,
) -> Cursor:
    """Compute and commit all result tables; returns the cut-off of the next run.

    ``historical`` is ``whole_history``, or ``open_days`` or ``day_chain.chained_days`` for
    a history that is too long to read on every run. ``fmt`` and ``options`` say where the
    tables go. ``newest`` has at least the newest three readings of each plate, as
    ``carried`` keeps them; without it the lookback is scanned. The times reported are
    those of each table's own action; the first of a group also fills what the others
    share, and the sizes are observed on the way.
    """
    seconds: dict[str, float] = {}
    cut = cursor.cut

    def put(table: DataFrame, name: str) -> None:
        results.write_result(table, base, name, run_id, fmt, options)

    def write(name: str, table: DataFrame, begun: float | None = None) -> None:
        begun = clock.monotonic() if begun is None else begun
        put(table, name)
        seconds[name] = clock.monotonic() - begun

    def write_all(tables: dict[str, DataFrame], begun: float) -> None:
        """The first table alone, so that it fills the shared intermediate; then the rest."""
        (first, table), *others = tables.items()
        write(first, table, begun)
        together(spark, [partial(write, n, t) for n, t in others])

    window = since(history if newest is None else newest, cut - params.lookback_seconds)
    begun = clock.monotonic()
    read, seen = Observation(), Observation()
    if newest is None:
        window = window.observe(read, F.count_if(F.col("time") > F.lit(float(cut))).alias("n"))
    # At most `latest` rows per active plate are kept, then one per plate.
    # The latest reading of each active plate is in the snapshot.
    snap = snapshot(window, cut, params).observe(
        seen, F.max("time").alias("latest"), F.count(F.lit(1)).alias("n")
    )
    with scratch_tables(spark), kept(snap) as snap:
        with kept(with_collision_risk(with_kinematics(snap))) as vehicles:
            write_all(live_analyses(snap, vehicles), begun)
        sizes = _observed(seen)
        latest, batch_rows = sizes.get("latest"), sizes.get("n") or 0

    # What is carried along does not hold every recent reading.
    recent_rows = (
        _observed(read).get("n") or 0 if newest is None else since(history, cut).count()
    )
    begun = clock.monotonic()
    with scratch_tables(spark):
        with historical(spark, history, base, params, as_of, segment_rows) as found:
            tables, history_rows = found
            write_all(tables, begun)

    report = [(name, seconds[name]) for name in TIMED]
    times = results.literal_rows(spark, report, results.TIMES)
    put(times, "times")
    stamp = spark.range(1).select(F.lit(float(cut)).alias("LastTimeStamp"))
    put(stamp, "lasttimestamp")
    following = cut_off.next_cut(cursor, latest, params.live_seconds)
    sizes = (history_rows, recent_rows, batch_rows)
    results.commit_run(spark, base, run_id, cut, following, sizes)
    return following
