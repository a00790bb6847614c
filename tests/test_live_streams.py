"""Sketches and sliding scores on a stream, against the exact analyses."""

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows
from kinelane.operators import history as past
from kinelane.operators.kinematics import with_kinematics
from kinelane.schema import READING, Params
from kinelane.sources.events import load_events, plain, readings
from kinelane.streaming import live

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def sent(spark):
    df = plain(readings(load_events(spark, "/root/testdata/sf0.01"))).cache()
    yield df
    df.unpersist()


def stream(spark, folder):
    return spark.readStream.schema(READING).option("maxFilesPerTrigger", 1).parquet(folder)


def put(df, folder):
    df.select(*READING.fieldNames()).coalesce(1).write.mode("append").parquet(folder)


def test_counts_from_sketches(spark, sent, tmp_path):
    """Late readings and a restart; the exact numbers lie within the stated bound."""
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (2, 0, 1):
        put(sent.filter(F.pmod("_id", F.lit(3)) == part), inbox)
        query = live.start_sketches(stream(spark, inbox), out, state, trigger=ONCE)
        query.awaitTermination(120)
        if part == 0:
            live.merge_sketches(spark, out, since=0.0)
    top = sent.agg(F.max("time")).first()[0]
    for merged in (False, True, True):
        if merged:
            live.merge_sketches(spark, out, since=top - 1000)
        sketched = live.read_sketches(spark, out)
        for cut in (top - 60, top - 33.3, top - 600, top):
            found = live.live_counts(sketched, cut).first()
            exact = sent.filter(F.col("time") > cut).agg(
                F.count_distinct("plate").alias("cars"), F.count_distinct("road").alias("roads")
            ).first()
            slack = live.SKETCH_ERROR
            assert found.n_cars * (1 - slack) <= exact.cars <= found.most_cars * (1 + slack)
            assert found.n_roads * (1 - slack) <= exact.roads <= found.most_roads * (1 + slack)
    assert live.live_counts(live.read_sketches(spark, str(tmp_path / "none")), 0.0).first().n_cars == 0


def test_error_of_many_plates(spark):
    many = spark.range(60_000).select(
        F.concat(F.lit("P"), F.col("id") % 20_000).alias("plate"), F.lit("r").alias("road"),
        (F.col("id") % 50).cast("double").alias("time"),
    )
    found = live.live_counts(live.sketches(many), -1.0).first()
    assert abs(found.n_cars - 20_000) <= 20_000 * live.SKETCH_ERROR and found.n_roads == 1


def scores(spark, inbox, state, params, name):
    scored = live.scored_stream(stream(spark, inbox), params)
    sums = live.sliding_scores(scored, params, live.Grid(10, "1 hour"))
    query = (
        sums.writeStream.format("memory").queryName(name).outputMode("complete")
        .option("checkpointLocation", state).trigger(**ONCE).start()
    )
    query.awaitTermination(240)
    return spark.table(name)


def test_sliding_scores_bound_the_exact_flag(spark, sent, tmp_path):
    """Surely found are found exactly, exactly found are possibly found; none of it is empty."""
    inbox = str(tmp_path / "in")
    params = Params(min_score=20)
    middle = sent.agg(F.expr("percentile(time, 0.5)")).first()[0]
    put(sent.filter(F.col("time") <= middle), inbox)
    put(sent.filter(F.col("time") > middle), inbox)
    sums = scores(spark, inbox, str(tmp_path / "state"), params, "sums")
    found = {r.plate: r.sure for r in live.dangerous(sums, params).collect()}
    scored = past.driving_scores(with_kinematics(sent), params)
    exact = {r.plate for r in past.severe_windows(scored, params).select("plate").distinct().collect()}
    sure = {plate for plate, certain in found.items() if certain}
    assert sure <= exact <= set(found) and sure and len(exact) < sent.select("plate").distinct().count()
    spark.sql("DROP TABLE IF EXISTS sums")


def test_scores_of_a_stream_are_the_exact_ones(spark, tmp_path):
    """In order of time, over several batches, with incomplete readings and lane changes."""
    inbox = str(tmp_path / "in")
    start = 1_685_000_000.0
    drive = [
        dict(plate=p, time=start + 7 * i, x=(i * i * 13 + len(p) * i) % 900, y=(i // 3) % 3,
             road_speed=60 if i % 4 else 400, road=None if (i, p) == (5, "A") else "r")
        | ({"x": None} if (i, p) == (9, "BB") else {"y": None} if (i, p) == (9, "C") else {})
        for i in range(20) for p in ("A", "BB", "C")
    ]
    df = frame(spark, drive)
    for low in range(0, 60, 12):
        put(df.filter((F.col("_id") >= low) & (F.col("_id") < low + 12)), inbox)
    scored = live.scored_stream(stream(spark, inbox))
    query = (
        scored.writeStream.format("memory").queryName("scored").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "state")).trigger(**ONCE).start()
    )
    query.awaitTermination(240)
    wanted = past.driving_scores(with_kinematics(df))
    assert rows(spark.table("scored"), "plate", "time", "total") == rows(wanted, "plate", "time", "total")
    spark.sql("DROP TABLE IF EXISTS scored")
