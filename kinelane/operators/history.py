"""The historical analyses, on all readings or on all readings with kinematics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinelane.functions import rules
from kinelane.operators.ordered import (
    SEG,
    SEGMENT_ROWS,
    own,
    pad,
    partition_keys,
    pinned,
    running_total,
    split_hot_keys,
)
from kinelane.schema import IN_TIME, VEHICLE, Params


def top_vehicles(df: DataFrame, params: Params = Params()) -> DataFrame:
    """The plates seen on the most roads."""
    roads = df.groupBy("plate").agg(F.count_distinct("road").alias("road_count"))
    return roads.orderBy(F.desc("road_count"), "plate").limit(params.top_vehicles)


def _mean(column: str) -> Column:
    """Exact whatever the order of rows: the sum is an integer until divided."""
    return F.sum(F.col(column).cast("bigint")).cast("double") / F.count(column)


def road_means(moving: DataFrame) -> DataFrame:
    means = own(moving).groupBy("road").agg(
        _mean("speed").alias("avg_speed"), _mean("road_size").alias("_size")
    )
    return means.select("road", "avg_speed", _time_to_cross().alias("avg_time_to_cross"))


def _time_to_cross() -> Column:
    """Null where nothing moves on the road."""
    return F.try_divide("_size", "avg_speed")


def road_collisions(moving: DataFrame) -> DataFrame:
    return (
        own(moving).filter(rules.standing_still())
        .groupBy("road")
        .agg(F.count(F.lit(1)).alias("total_collisions"))
    )


def road_stats_joined(moving: DataFrame) -> DataFrame:
    """Means and collisions per road as two aggregates and a left join."""
    return road_means(moving).join(road_collisions(moving), "road", "left")


def road_stats(moving: DataFrame) -> DataFrame:
    """The same in one pass; null where a road has no collision."""
    stats = own(moving).groupBy("road").agg(
        _mean("speed").alias("avg_speed"),
        _mean("road_size").alias("_size"),
        F.nullif(F.count_if(rules.standing_still()), F.lit(0)).alias("total_collisions"),
    )
    return stats.select(
        "road", "avg_speed", _time_to_cross().alias("avg_time_to_cross"), "total_collisions"
    )


def merged_road_stats(sums: DataFrame) -> DataFrame:
    """The same from sums per road and part: ``n, speeds, sizes, still``."""
    stats = sums.groupBy("road").agg(
        (F.sum("speeds").cast("double") / F.sum("n")).alias("avg_speed"),
        (F.sum("sizes").cast("double") / F.sum("n")).alias("_size"),
        F.nullif(F.sum("still"), F.lit(0)).alias("total_collisions"),
    )
    return stats.select(
        "road", "avg_speed", _time_to_cross().alias("avg_time_to_cross"), "total_collisions"
    )


def infraction_flags(moving: DataFrame, earlier: Column | None = None) -> DataFrame:
    """Add ``change_in_speed``: 1 where a vehicle starts to break the limit.

    A plate's first row has no speed before it, and counts if it is too fast;
    ``earlier`` is the speed of a row before it that is not part of ``moving``.
    """
    moving = pad(moving, VEHICLE, IN_TIME, before=1)
    along = Window.partitionBy(*partition_keys(moving, VEHICLE)).orderBy(*IN_TIME)
    before = F.lag("speed").over(along)
    starts = rules.starts_infraction(before if earlier is None else F.coalesce(before, earlier))
    return own(moving.withColumn("change_in_speed", rules.flag(starts)))


def banned_vehicles(
    moving: DataFrame, params: Params = Params(), as_of: float | None = None
) -> DataFrame:
    """Plates with enough infractions that are young enough at ``as_of`` (now)."""
    return count_infractions(infraction_flags(moving), params, as_of)


def count_infractions(
    flags: DataFrame, params: Params = Params(), as_of: float | None = None
) -> DataFrame:
    # The age filter comes after the flags, so the first row kept still sees the
    # speed of the row before it.
    clock = rules.now_seconds() if as_of is None else F.lit(float(as_of))
    return (
        flags.filter(rules.recent_enough(clock, params.retention_seconds))
        .groupBy("plate")
        .agg(F.sum("change_in_speed").alias("total_infractions"))
        .filter(F.col("total_infractions") >= params.min_infractions)
    )


def in_band(params: Params) -> Column:
    return (F.col("time") > params.band_start) & (F.col("time") < params.band_end)


def driving_scores(
    moving: DataFrame, params: Params = Params(), earlier: Column | None = None
) -> DataFrame:
    """Score each reading of the time band; readings that score 0 are dropped.

    The band comes first, so its first reading never counts as a lane change, unless
    ``earlier`` tells the lane of one in the band that is not part of ``moving``.
    """
    inside = pad(moving.filter(in_band(params)), VEHICLE, IN_TIME, before=1)
    along = Window.partitionBy(*partition_keys(inside, VEHICLE)).orderBy(*IN_TIME)
    before = F.lag("y").over(along)
    changed = F.col("y") != (before if earlier is None else F.coalesce(before, earlier))
    banded = own(inside.withColumn("changed_lane", rules.flag(changed)))
    scored = banded.withColumns({
        "over_road_speed": rules.flag(rules.over_limit(), 3),
        "over_acc": rules.flag(rules.harsh(params.harsh_acc), 3),
    })
    total = F.col("changed_lane") + F.col("over_road_speed") + F.col("over_acc")
    return scored.withColumn("total", total).filter(F.col("total") > 0)


def dangerous_driving(
    moving: DataFrame, params: Params = Params(), distinct: bool = False
) -> DataFrame:
    """Plates whose scores add up within a window that starts at a reading.

    One row per such reading, or one per plate with ``distinct``.
    """
    plates = severe_windows(driving_scores(moving, params), params).select("plate")
    return plates.distinct() if distinct else plates


def reach(params: Params) -> int:
    """Scored readings around one that settle whether its window reaches the limit."""
    return max(0, params.min_score - 1)


def severe_windows(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """Scored readings from which the next 60 s, both ends included, reach the limit.

    Every scored reading adds at least 1, so ``min_score`` readings settle it: the
    frame stays that short however dense the readings are. Readings at the same
    time belong to the window too, also those sorted before the current one.
    """
    far = reach(params)
    scored = pad(scored, VEHICLE, IN_TIME, before=far, after=far)
    along = Window.partitionBy(*partition_keys(scored, VEHICLE)).orderBy(*IN_TIME)
    near = F.collect_list(F.struct("time", "total")).over(along.rowsBetween(-far, far))
    time, until = F.col("time"), F.col("time") + params.score_window_seconds
    score = F.aggregate(
        "_near",
        F.lit(0),
        lambda so_far, at: so_far
        + F.when(at["time"].between(time, until), at["total"]).otherwise(0),
    )
    flagged = scored.withColumn("_near", near).withColumn(
        "several_infractions", score >= params.min_score
    )
    return own(flagged.drop("_near")).filter("several_infractions")


def window_scores(
    scored: DataFrame, params: Params = Params(), segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """The sum of each 60 s window itself: ``_id, plate, window_total``.

    Unlike the flag, this costs more the more readings a window holds.
    """
    if SEG in scored.columns:
        return _window_scores_split(scored, params, segment_rows)
    ahead = (
        Window.partitionBy(*VEHICLE)
        .orderBy("time")
        .rangeBetween(Window.currentRow, params.score_window_seconds)
    )
    return scored.select("_id", "plate", F.sum("total").over(ahead).alias("window_total"))


def _window_scores_split(
    scored: DataFrame, params: Params, segment_rows: int
) -> DataFrame:
    """The same where a plate has too many readings for one task.

    A window may span many segments, so its sum is taken as the difference of two
    running totals: at the end of the window, and just before its start.
    """

    def mark(at: Column, kind: int, add: Column) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), add.alias("add"))

    # At one time: window starts, then readings, then window ends.
    time, nothing = F.col("time"), F.lit(0)
    marks = F.array(
        mark(time, 0, nothing),
        mark(time, 1, F.col("total")),
        mark(time + params.score_window_seconds, 2, nothing),
    )
    along = ["at", "kind", "_id", "_row"]
    # Ids need not be unique; the numbers are written out, so they stay.
    rows = pinned(scored.withColumn("_row", F.monotonically_increasing_id()))
    line = rows.select("_id", "_row", "plate", F.inline(marks))
    line = split_hot_keys(line, VEHICLE, along, segment_rows)
    sums = running_total(line, VEHICLE, along, F.col("add"), "_sum")
    sign = F.when(F.col("kind") == 2, F.col("_sum")).when(F.col("kind") == 0, -F.col("_sum"))
    totals = sums.groupBy("plate", "_id", "_row").agg(F.sum(sign).alias("window_total"))
    return totals.select("_id", "plate", "window_total")
