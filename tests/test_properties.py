"""Results against brute force, and independence of the physical layout."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.operators import history, snapshot
from kinelane.operators.kinematics import with_kinematics
from kinelane.operators.ordered import SEG
from kinelane.schema import Params
from kinelane.sources.events import load_events, plain, readings


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("split", [False, True])
def test_score_windows_against_all_pairs(spark, seed, split):
    rng = random.Random(seed)
    scored = [
        (i, rng.choice("ABC"), float(rng.choice([0, 5, 30, 60, 61, 90, 120, 400])) + rng.random() // 0.6,
         rng.choice([1, 1, 1, 3, 4]))
        for i in range(120)
    ]
    params = Params(min_score=rng.choice([2, 7, 25]))
    expected = sorted(
        i for i, plate, time, _ in scored
        if sum(t for _, p, at, t in scored if p == plate and time <= at <= time + 60)
        >= params.min_score
    )
    df = spark.createDataFrame(scored, "_id long, plate string, time double, total int")
    if split:
        # Segments must rise with the order of a plate's rows, as range bounds do.
        df = df.withColumn(SEG, (F.col("time") / 25).cast("int"))
    assert [i for (i,) in rows(history.severe_windows(df, params), "_id")] == expected


def test_kinematics_against_a_loop(spark):
    rng = random.Random(3)
    path = [r for p in "ABC" for r in track(p, [rng.randrange(500) for _ in range(30)])]
    rng.shuffle(path)
    expected = []
    for plate in "ABC":
        xs = [r["x"] for r in sorted(path, key=lambda r: r["time"]) if r["plate"] == plate]
        speeds = [abs(b - a) for a, b in zip(xs, xs[1:])]
        expected += [(plate, s, s - before) for before, s in zip(speeds, speeds[1:])]
    moving = with_kinematics(frame(spark, path))
    assert rows(moving, "plate", "speed", "acc") == sorted(expected)


def test_number_of_partitions_does_not_matter(spark):
    df = plain(readings(load_events(spark, "/root/testdata/sf0.001"))).cache()
    results = []
    for n in ("3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        moving = with_kinematics(df.repartition(int(n)))
        results.append([
            rows(history.road_stats(moving), "road", "avg_speed", "avg_time_to_cross"),
            rows(history.dangerous_driving(moving), "plate"),
            rows(history.top_vehicles(df), "plate", "road_count"),
            rows(snapshot.live_vehicles(df, -60, at_most=0), "plate", "speed", "collision_risk"),
        ])
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    df.unpersist()
    assert results[0] == results[1]


def test_joins_and_window_find_the_same_snapshot(spark):
    df = plain(readings(load_events(spark, "/root/testdata/sf0.001"))).cache()
    cut = df.agg(F.max("time")).first()[0] - 60
    windowed = rows(snapshot.snapshot(df, cut), "plate", "_id", "row")
    for how in ("inner", "left_semi"):
        joined = snapshot.latest_readings(snapshot.active_history(df, cut, how=how), 3)
        assert rows(joined, "plate", "_id", "row") == windowed
    df.unpersist()
