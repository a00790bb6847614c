"""The live state: active plates and their latest readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinelane.functions import rules
from kinelane.operators.kinematics import with_kinematics
from kinelane.operators.ordered import (
    SEG,
    SEGMENT_ROWS,
    own,
    partition_keys,
    pinned,
    split_hot_keys,
)
from kinelane.schema import VEHICLE, Params


def recent(df: DataFrame, cut: float) -> DataFrame:
    """Readings after the cut-off."""
    return df.filter(F.col("time") > F.lit(float(cut)))


def lookback(df: DataFrame, cut: float, params: Params = Params()) -> DataFrame:
    """Readings the latest ones of an active plate are taken from."""
    return recent(df, cut - params.lookback_seconds)


def active_plates(df: DataFrame, cut: float) -> DataFrame:
    return recent(df, cut).select("plate").distinct()


def active_history(
    df: DataFrame, cut: float, params: Params = Params(), how: str = "left_semi"
) -> DataFrame:
    """Lookback readings of active plates, as a semi join or an inner join.

    The right side is distinct, so both give the same rows; the semi join needs
    no column of it. No broadcast hint: the plates grow with the fleet, and AQE
    broadcasts them when they turn out small or splits a plate that is skewed.
    """
    return lookback(df, cut, params).join(active_plates(df, cut), "plate", how)


def latest_readings(df: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` readings of each plate, numbered in ``row`` from the newest.

    The limit is pushed below the shuffle, so a task sends on at most ``n`` rows
    per plate however many that plate has.
    """
    newest_first = Window.partitionBy(*VEHICLE).orderBy(F.desc("time"), F.desc("_id"))
    numbered = own(df).drop(SEG).withColumn("row", F.row_number().over(newest_first))
    return numbered.filter(F.col("row") <= n)


def snapshot(df: DataFrame, cut: float, params: Params = Params()) -> DataFrame:
    """The newest readings of every active plate.

    A plate is active when its newest reading is after the cut-off. That reading
    is among those kept, so no join back to the active plates is needed.
    """
    kept = latest_readings(lookback(df, cut, params), params.latest)
    newest = F.max("time").over(Window.partitionBy(*VEHICLE))
    return (
        kept.withColumn("_newest", newest)
        .filter(F.col("_newest") > F.lit(float(cut)))
        .drop("_newest")
    )


def with_collision_risk(
    moving: DataFrame, at_most: int | None = None, segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """Flag vehicles about to pass the expected spot of the one ahead in their lane.

    ``moving`` is the snapshot with kinematics: one row per vehicle. ``at_most``
    is a known bound on its rows.
    """
    lane, along = ["road", "y"], ["x", "plate"]
    lanes = split_hot_keys(moving, lane, along, segment_rows, at_most, before=1, after=1)
    window = Window.partitionBy(*partition_keys(lanes, lane)).orderBy(*along)
    x = F.col("x").cast("bigint")
    spot, mirrored = x + F.col("speed") + F.col("acc"), x - F.col("speed") - F.col("acc")
    risk = rules.reaches(F.lead(spot).over(window), F.lag(mirrored).over(window))
    flagged = own(lanes.withColumn("collision_risk", rules.flag(risk)))
    return flagged.select(*moving.columns, "collision_risk")


def live_vehicles(
    df: DataFrame, cut: float, params: Params = Params(), at_most: int | None = None
) -> DataFrame:
    """Active vehicles with speed, acceleration and collision risk.

    ``at_most`` bounds the rows of ``df``. If it does not rule out a crowded lane,
    the vehicles (one row each) are written out before the lanes are measured.
    """
    moving = with_kinematics(snapshot(df, cut, params))
    if at_most is None or at_most > SEGMENT_ROWS:
        moving, at_most = pinned(moving), None
    return with_collision_risk(moving, at_most)
