"""Column rules: the flags and scores the analyses are made of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column, score: int = 1) -> Column:
    """``score`` where the condition holds; 0 where it does not or is null."""
    return F.when(condition, score).otherwise(0)


def over_limit() -> Column:
    return F.col("speed") > F.col("road_speed")


def standing_still() -> Column:
    return (F.col("speed") == 0) & (F.col("acc") == 0)


def starts_infraction(previous_speed: Column) -> Column:
    """Over the limit now, and not over *this* limit before (or no reading before)."""
    was_over = F.coalesce(previous_speed > F.col("road_speed"), F.lit(False))
    return over_limit() & ~was_over


def harsh(limit: int) -> Column:
    return F.abs("acc") > limit


def reaches(ahead: Column, behind: Column) -> Column:
    """Does the vehicle pass the expected spot of the one in front of it?

    ``ahead`` is that spot for forward traffic, ``behind`` for backward traffic,
    where the vehicle in front has the smaller x.
    """
    x = F.col("x").cast("bigint")
    forward = x + F.col("speed") + F.col("acc") > ahead
    backward = x - F.col("speed") - F.col("acc") < behind
    return F.when(F.col("direction") == 1, forward).otherwise(backward)


def recent_enough(as_of: Column, seconds: float) -> Column:
    return as_of - F.col("time") < seconds


def now_seconds() -> Column:
    return F.unix_timestamp(F.current_timestamp()).cast("double")


def yes_no(column: str) -> Column:
    return F.when(F.col(column) == 1, "Yes").when(F.col(column) == 0, "No")


def two_decimals(column: str) -> Column:
    """Half-even rounding of the shown digits."""
    return F.bround(F.col(column), 2)
