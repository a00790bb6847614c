"""The registered queries, each over all readings of the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelane.functions import payload, rules
from kinelane.operators import cursor, history, live, snapshot, views
from kinelane.operators.kinematics import numbered, with_kinematics
from kinelane.operators.ordered import own, pinned
from kinelane.plans import carried, closed_days, day_chain
from kinelane.schema import FIELDS, Params, with_event_date
from kinelane.sources.events import START, events_after, extent, load_events, plain, readings
from kinelane.sources.files import new_table_path

Query = Callable[[SparkSession, str], DataFrame]

STOCK = Params()


class Source(NamedTuple):
    """The events of a query, with what one pass over them tells."""

    events: DataFrame
    n_rows: int
    max_time: float

    def rows(self) -> DataFrame:
        return readings(self.events, at_most=self.n_rows)

    def loose(self, after: float | None = None) -> DataFrame:
        """Readings without x; the scan is bounded where only those after a time count."""
        events = self.events if after is None else events_after(self.events, after)
        return readings(events, clustered=False)

    def looked_back(self, cut: float) -> DataFrame:
        return self.loose(cut - STOCK.lookback_seconds)

    @property
    def steady(self) -> float:
        """The cut-off a minute behind the latest reading."""
        return self.max_time - STOCK.live_seconds


def _measured(spark: SparkSession, sf_dir: str) -> Source:
    events = load_events(spark, sf_dir)
    return Source(events, *extent(events))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings laid out by plate, for windows over each vehicle."""
    return readings(load_events(spark, sf_dir))


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings for queries without such a window; no shuffle unless x is used."""
    return readings(load_events(spark, sf_dir), clustered=False)


def _moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_kinematics(_rows(spark, sf_dir))


def _steady(source: Source) -> float:
    return source.steady


def _idle(source: Source) -> float:
    return source.max_time


def _first(_source: Source) -> float:
    return cursor.start().cut


def _snapshot(source: Source, cut=_steady) -> DataFrame:
    return snapshot.snapshot(source.looked_back(cut(source)), cut(source))


def _vehicles(source: Source, cut=_steady) -> DataFrame:
    return snapshot.live_vehicles(source.rows(), cut(source), at_most=source.n_rows)


# --- wire and scan ---------------------------------------------------------------


def all_readings(spark, sf_dir):
    return plain(_rows(spark, sf_dir))


def payload_lines(spark, sf_dir):
    return payload.encode(plain(_rows(spark, sf_dir)))


def payload_roundtrip(spark, sf_dir):
    lines = payload.encode(plain(_rows(spark, sf_dir)))
    return payload.accepted(payload.decode(lines)).select(*FIELDS)


def payload_rejects(spark, sf_dir):
    """Lines damaged in one of many ways each, by the number of the reading."""
    rows = plain(_rows(spark, sf_dir))
    lines = payload.encode(rows.withColumn("road", F.concat("road", F.lit(":"), "_id")))
    line_id = F.split_part(F.split_part("value", F.lit(","), F.lit(1)), F.lit(":"), F.lit(2))
    damaged = (
        F.when(line_id.cast("bigint") % 97 == 0, F.substring_index("value", ",", 5))
        .when(line_id.cast("bigint") % 89 == 0, F.regexp_replace("value", ",[0-9]+,", ",?,"))
        .when(line_id.cast("bigint") % 83 == 0, _with_field("time", "1685000000000000"))
        .when(line_id.cast("bigint") % 79 == 0, _with_field("time", "1e400"))
        .when(line_id.cast("bigint") % 73 == 0, _with_field("x", "2147483647"))
        .when(line_id.cast("bigint") % 71 == 0, _with_field("direction", "7"))
        .when(line_id.cast("bigint") % 67 == 0, _with_field("plate", " "))
        .otherwise(F.col("value"))
    )
    spoilt = line_id.cast("bigint") % 61 == 0
    bytes_ = F.concat(damaged.cast("binary"), F.when(spoilt, F.lit(b"\xff\n")).otherwise(F.lit(b"")))
    bad = payload.rejected(payload.decode(lines.select(bytes_.alias("value"))))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _with_field(name: str, value: str):
    """The line with another value in one of its fields."""
    parts = F.split("value", ",", -1)
    end = "\n" if name == FIELDS[-1] else ""
    new = [F.lit(value + end) if c == name else F.get(parts, i) for i, c in enumerate(FIELDS)]
    return F.concat_ws(",", *new)


def imposed_types(spark, sf_dir):
    """Text columns, blank padded as in a warehouse, cast back to sensor types."""
    rows = plain(_rows(spark, sf_dir))
    padded = rows.select(
        "_id", *[F.rpad(F.col(c).cast("string"), 40, " ").alias(c) for c in FIELDS]
    )
    return payload.impose_types(padded)


# --- live ------------------------------------------------------------------------


def recent_readings(spark, sf_dir):
    source = _measured(spark, sf_dir)
    rows = snapshot.recent(source.loose(source.steady), source.steady)
    return rows.select("_id", "plate", "time")


def lookback_readings(spark, sf_dir):
    source = _measured(spark, sf_dir)
    rows = snapshot.lookback(source.looked_back(source.steady), source.steady)
    return rows.select("_id", "plate", "time")


def reading_counts(spark, sf_dir):
    """Sizes of the whole history, its recent part and the snapshot's input."""
    source = _measured(spark, sf_dir)
    cut, time = source.steady, F.col("time")
    return source.loose().agg(
        F.count(F.lit(1)).alias("history_rows"),
        F.count_if(time > cut).alias("recent_rows"),
        F.count_if(time > cut - STOCK.lookback_seconds).alias("lookback_rows"),
    )


def active_plates(spark, sf_dir):
    source = _measured(spark, sf_dir)
    return snapshot.active_plates(source.loose(source.steady), source.steady)


def _active_history(how: str) -> Query:
    def query(spark, sf_dir):
        source = _measured(spark, sf_dir)
        rows = snapshot.active_history(source.looked_back(source.steady), source.steady, how=how)
        return rows.select("plate", "_id")

    return query


def latest_three(spark, sf_dir):
    """The newest three readings of each active plate."""
    return _snapshot(_measured(spark, sf_dir)).select("plate", "_id", "row")


def snapshot_kinematics(spark, sf_dir):
    source = _measured(spark, sf_dir)
    snap = snapshot.snapshot(source.rows(), source.steady)
    return with_kinematics(snap).select("plate", "_id", "speed", "acc")


def collision_risk_flags(spark, sf_dir):
    return _vehicles(_measured(spark, sf_dir)).select(
        "plate", "road", "y", "x", "speed", "acc", "collision_risk"
    )


def live_idle_counts(spark, sf_dir):
    """All four counts at a cut-off nothing is newer than."""
    source = _measured(spark, sf_dir)
    snap, vehicles = _snapshot(source, _idle), _vehicles(source, _idle)
    seen = snap.agg(
        F.count_distinct("road").alias("n_roads"), F.count_distinct("plate").alias("n_cars")
    )
    flagged = vehicles.agg(
        F.count_if(rules.over_limit()).alias("cars_over_speed_limit"),
        F.count_if(F.col("collision_risk") == 1).alias("cars_collision_risk"),
    )
    named = [c.unpivot([], c.columns, "analysis", "n") for c in (seen, flagged)]
    return named[0].union(named[1])


def _on_snapshot(analysis, cut=_steady) -> Query:
    return lambda spark, sf_dir: analysis(_snapshot(_measured(spark, sf_dir), cut))


def _on_vehicles(analysis, cut=_steady) -> Query:
    return lambda spark, sf_dir: analysis(_vehicles(_measured(spark, sf_dir), cut))


# --- history ---------------------------------------------------------------------


def history_kinematics(spark, sf_dir):
    return own(_moving(spark, sf_dir)).select("_id", "plate", "speed", "acc")


def history_speed_per_second(spark, sf_dir):
    moving = with_kinematics(_rows(spark, sf_dir), per_second=True)
    return own(moving).select("_id", "plate", "speed")


def reading_numbers(spark, sf_dir):
    """Oldest-first numbers of the readings that have a speed and acceleration."""
    return numbered(_moving(spark, sf_dir)).select("_id", "plate", "row")


def top_road_vehicles(spark, sf_dir):
    return history.top_vehicles(_loose(spark, sf_dir))


def _on_moving(analysis, **options) -> Query:
    return lambda spark, sf_dir: analysis(_moving(spark, sf_dir), **options)


def infraction_flags(spark, sf_dir):
    flags = history.infraction_flags(_moving(spark, sf_dir))
    return flags.select("_id", "plate", "change_in_speed")


def banned_vehicles_retention(spark, sf_dir):
    params = Params(retention_seconds=1800)
    source = _measured(spark, sf_dir)
    moving = with_kinematics(source.rows())
    return history.banned_vehicles(moving, params, as_of=source.max_time)


def driving_scores(spark, sf_dir):
    return history.driving_scores(_moving(spark, sf_dir)).select(
        "_id", "plate", "changed_lane", "over_road_speed", "over_acc", "total"
    )


def window_scores(spark, sf_dir):
    scored = history.driving_scores(_moving(spark, sf_dir))
    return history.window_scores(scored)


BAND = Params(band_start=1_685_001_000, band_end=1_685_002_000)


# --- bookkeeping and views -------------------------------------------------------


def latest_time(spark, sf_dir):
    return cursor.latest_time(_loose(spark, sf_dir))


def _cutoffs(pass_seconds: float) -> Query:
    def query(spark, sf_dir):
        log = cursor.replay(_loose(spark, sf_dir), pass_seconds)
        return cursor.changes(log).select("cut")

    return query


def view_overspeed(spark, sf_dir):
    return views.overspeed(live.overspeed_list(_vehicles(_measured(spark, sf_dir))))


def view_road_stats(spark, sf_dir):
    return views.road_stats(history.road_stats(_moving(spark, sf_dir)))


# --- split keys ------------------------------------------------------------------


def _just_below_biggest(df: DataFrame, keys: list[str]) -> int:
    """A segment size that splits the biggest keys of ``df`` and leaves the others."""
    biggest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return max(1, int(biggest * 0.95) - 1)


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose busiest plates are cut into segments, as big ones would be."""
    size = _just_below_biggest(_loose(spark, sf_dir), ["plate"])
    return readings(load_events(spark, sf_dir), segment_rows=size)


def readings_split(spark, sf_dir):
    return plain(_split_rows(spark, sf_dir))


def infraction_flags_split(spark, sf_dir):
    flags = history.infraction_flags(with_kinematics(_split_rows(spark, sf_dir)))
    return flags.select("_id", "plate", "change_in_speed")


def dangerous_driving_split(spark, sf_dir):
    return history.dangerous_driving(with_kinematics(_split_rows(spark, sf_dir)))


def window_scores_split(spark, sf_dir):
    return history.window_scores(
        history.driving_scores(with_kinematics(_split_rows(spark, sf_dir)))
    )


def collision_risk_split(spark, sf_dir):
    source = _measured(spark, sf_dir)
    moving = pinned(with_kinematics(snapshot.snapshot(source.rows(), source.steady)))
    size = _just_below_biggest(moving, ["road", "y"])
    return snapshot.with_collision_risk(moving, segment_rows=size).select(
        "plate", "road", "y", "x", "speed", "acc", "collision_risk"
    )


# --- closed days -----------------------------------------------------------------

# A day holds 144 s of the events' compressed time, and a 60 s window ten hours.
REAL_TIME = Params(score_window_seconds=36_000)


def _from_closed_days(name: str, change: Callable[[DataFrame], DataFrame] = plain) -> Query:
    """A historical result of readings spread over the month their events span.

    All days but the last ones are closed, then merged with the open ones.
    """

    def query(spark, sf_dir):
        spread = F.lit(float(START)) + (F.col("time") - START) * 600
        rows = change(plain(_rows(spark, sf_dir)))
        rows = with_event_date(rows.withColumn("time", spread))
        base = new_table_path(spark)
        with closed_days.past_analyses(spark, pinned(rows), base, REAL_TIME) as (tables, _):
            return tables[name]

    return query


# --- chained days ------------------------------------------------------------------


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings spread over the month that their events span."""
    slow = F.lit(float(START)) + (F.col("time") - START) * 600
    return pinned(with_event_date(plain(_rows(spark, sf_dir)).withColumn("time", slow)))


def _from_chain(name: str, params: Params = REAL_TIME) -> Query:
    """A historical result after three refreshes of the chain.

    The first sees every third reading of the first half, and the second the first half,
    so closed days are replayed; the third sees all.
    """

    def query(spark, sf_dir):
        rows = _spread(spark, sf_dir)
        first, last = rows.agg(F.min("time"), F.max("time")).first()
        half = rows.filter(F.col("time") < (first + last) / 2)
        base = new_table_path(spark)
        for seen in (half.filter("_id % 3 = 0"), half):
            with day_chain.past_analyses(spark, seen, base, params, last):
                pass
        with day_chain.past_analyses(spark, rows, base, params, last) as (tables, _):
            return tables[name]

    return query


#: Ten days: some closed days fall out wholly, and one in part.
SHORT_MEMORY = Params(score_window_seconds=36_000, retention_seconds=864_000.0)


def latest_three_carried(spark, sf_dir):
    """The newest three readings of each active plate, carried along over five ticks."""
    rows = pinned(plain(_rows(spark, sf_dir)))
    latest = rows.agg(F.max("time")).first()[0]
    base, before = new_table_path(spark), None
    for tick in range(5):
        # Readings come in out of order.
        new = rows.filter(F.pmod("_id", F.lit(5)) == tick)
        newest = new.agg(F.max("time")).first()[0]
        before = carried.advance(spark, base, new, tick, before, STOCK, newest)
    return snapshot.snapshot(before.rows, latest - STOCK.live_seconds).select("plate", "_id", "row")


# --- incomplete readings -----------------------------------------------------------


def _gappy(rows: DataFrame) -> DataFrame:
    """Every 13th reading lacks its road's length, and so counts for nothing itself."""
    return rows.withColumn(
        "road_size", F.when(F.col("_id") % 13 != 0, F.col("road_size"))
    )


def infraction_flags_gaps(spark, sf_dir):
    flags = history.infraction_flags(with_kinematics(_gappy(_rows(spark, sf_dir))))
    return flags.select("_id", "plate", "change_in_speed")


def infraction_flags_gaps_split(spark, sf_dir):
    flags = history.infraction_flags(with_kinematics(_gappy(_split_rows(spark, sf_dir))))
    return flags.select("_id", "plate", "change_in_speed")


def driving_scores_gaps_split(spark, sf_dir):
    scored = history.driving_scores(with_kinematics(_gappy(_split_rows(spark, sf_dir))))
    return scored.select("_id", "plate", "changed_lane", "over_road_speed", "over_acc", "total")


QUERIES: dict[str, Query] = {
    "readings": all_readings,
    "payload_lines": payload_lines,
    "payload_roundtrip": payload_roundtrip,
    "payload_rejects": payload_rejects,
    "imposed_types": imposed_types,
    "recent_readings": recent_readings,
    "lookback_readings": lookback_readings,
    "reading_counts": reading_counts,
    "active_plates": active_plates,
    "active_history_inner": _active_history("inner"),
    "active_history_semi": _active_history("left_semi"),
    "latest_three": latest_three,
    "snapshot_kinematics": snapshot_kinematics,
    "collision_risk_flags": collision_risk_flags,
    "live_road_count": _on_snapshot(live.road_count),
    "live_vehicle_count": _on_snapshot(live.vehicle_count),
    "live_overspeed_count": _on_vehicles(live.overspeed_count),
    "live_collision_count": _on_vehicles(live.collision_count),
    "live_overspeed_list": _on_vehicles(live.overspeed_list),
    "live_collision_list": _on_vehicles(live.collision_list),
    "live_first_run_overspeed": _on_vehicles(live.overspeed_list, _first),
    "live_first_run_collision": _on_vehicles(live.collision_list, _first),
    "live_idle_counts": live_idle_counts,
    "history_kinematics": history_kinematics,
    "history_speed_per_second": history_speed_per_second,
    "reading_numbers": reading_numbers,
    "top_road_vehicles": top_road_vehicles,
    "road_mean_speed": _on_moving(history.road_means),
    "road_collisions": _on_moving(history.road_collisions),
    "road_stats": _on_moving(history.road_stats_joined),
    "road_stats_single_pass": _on_moving(history.road_stats),
    "infraction_flags": infraction_flags,
    "banned_vehicles": _on_moving(history.banned_vehicles),
    "banned_vehicles_min10": _on_moving(
        history.banned_vehicles, params=Params(min_infractions=10)
    ),
    "banned_vehicles_retention": banned_vehicles_retention,
    "driving_scores": driving_scores,
    "window_scores": window_scores,
    "dangerous_driving": _on_moving(history.dangerous_driving),
    "dangerous_driving_band": _on_moving(history.dangerous_driving, params=BAND),
    "dangerous_driving_min20": _on_moving(
        history.dangerous_driving, params=Params(min_score=20)
    ),
    "dangerous_vehicles": _on_moving(history.dangerous_driving, distinct=True),
    "latest_time": latest_time,
    "cutoff_changes": _cutoffs(60),
    "cutoff_changes_idle": _cutoffs(0.5),
    "view_overspeed": view_overspeed,
    "view_road_stats": view_road_stats,
    "top_road_vehicles_closed_days": _from_closed_days("historical1"),
    "road_stats_closed_days": _from_closed_days("historical2"),
    "banned_vehicles_closed_days": _from_closed_days("historical3"),
    "dangerous_driving_closed_days": _from_closed_days("alternative"),
    "banned_vehicles_gaps_closed_days": _from_closed_days("historical3", lambda df: _gappy(df)),
    "dangerous_driving_gaps_closed_days": _from_closed_days("alternative", lambda df: _gappy(df)),
    "top_road_vehicles_chained": _from_chain("historical1"),
    "road_stats_chained": _from_chain("historical2"),
    "banned_vehicles_chained": _from_chain("historical3"),
    "banned_vehicles_retention_chained": _from_chain("historical3", SHORT_MEMORY),
    "dangerous_driving_chained": _from_chain("alternative"),
    "latest_three_carried": latest_three_carried,
    "infraction_flags_gaps": infraction_flags_gaps,
    "infraction_flags_gaps_split": infraction_flags_gaps_split,
    "driving_scores_gaps_split": driving_scores_gaps_split,
    "readings_split": readings_split,
    "infraction_flags_split": infraction_flags_split,
    "dangerous_driving_split": dangerous_driving_split,
    "window_scores_split": window_scores_split,
    "collision_risk_split": collision_risk_split,
}
