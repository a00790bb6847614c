"""Results as they are shown: labelled, rounded, without the technical id."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kinelane.functions import rules


def overspeed(listed: DataFrame) -> DataFrame:
    return _shown(listed).withColumn("collision_risk", rules.yes_no("collision_risk"))


def road_stats(stats: DataFrame) -> DataFrame:
    return _shown(stats).withColumns({
        "avg_speed": rules.two_decimals("avg_speed"),
        "avg_time_to_cross": rules.two_decimals("avg_time_to_cross"),
    })


def run_times(times: DataFrame) -> DataFrame:
    return _shown(times).withColumn("time", rules.two_decimals("time"))


def _shown(result: DataFrame) -> DataFrame:
    return result.drop("_id")
