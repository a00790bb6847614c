"""The live analyses, on the snapshot or on the live vehicles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.functions import rules


def road_count(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count_distinct("road").alias("n_roads"))


def vehicle_count(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(F.count_distinct("plate").alias("n_cars"))


def overspeed_list(vehicles: DataFrame) -> DataFrame:
    flagged = vehicles.withColumn("over_speed_limit", rules.flag(rules.over_limit()))
    return flagged.filter(F.col("over_speed_limit") == 1).select(
        "plate", "speed", "collision_risk"
    )


def collision_list(vehicles: DataFrame) -> DataFrame:
    return vehicles.filter(F.col("collision_risk") == 1).select("plate", "speed")


def overspeed_count(vehicles: DataFrame) -> DataFrame:
    return overspeed_list(vehicles).agg(F.count(F.lit(1)).alias("cars_over_speed_limit"))


def collision_count(vehicles: DataFrame) -> DataFrame:
    return collision_list(vehicles).agg(F.count(F.lit(1)).alias("cars_collision_risk"))
