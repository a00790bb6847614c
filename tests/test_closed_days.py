"""Closing days must not change any result."""

import glob

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows
from kinelane.operators import history as past
from kinelane.plans import closed_days
from kinelane.plans.refresh import moving_history
from kinelane.plans.refresh import past_analyses as full_pass
from kinelane.schema import Params, with_event_date
from kinelane.sources.events import load_events, plain, readings

AS_OF = 1_686_000_000.0
FIRST = 19502  # 2023-05-25


@pytest.fixture(scope="module")
def history(spark):
    """Ten days of readings: the time of the events runs 200 times as fast."""
    df = plain(readings(load_events(spark, "/root/testdata/sf0.001")))
    slow = F.lit(FIRST * 86400.0) + F.floor((F.col("time") - 1_685_000_000) * 200)
    df = df.withColumn("time", F.when(F.col("_id") % 5 == 0, slow - 30).otherwise(slow))
    df = with_event_date(df).cache()
    yield df
    df.unpersist()


def check(spark, history, base, params=Params(), **options):
    full = full_pass(moving_history(history), history, params, AS_OF)
    with closed_days.past_analyses(spark, history, base, params, AS_OF, **options) as (tables, n_rows):
        assert n_rows == history.count()
        for name, table in tables.items():
            columns = full[name].columns
            assert sorted(table.columns) == sorted(columns)
            assert rows(table, *columns) == rows(full[name], *columns), name
            assert not full[name].isEmpty()


def test_day_by_day(spark, history, tmp_path):
    base = str(tmp_path)
    days = sorted(r.event_date for r in history.select("event_date").distinct().collect())
    assert len(days) > 8
    for day in (days[1], days[2], days[6], days[-1]):
        seen = history.filter(F.col("event_date") <= day)
        check(spark, seen, base, Params(min_score=3, score_window_seconds=20_000))
    state = closed_days.load(spark, base)
    assert state.generation == 0 and len(state.steps) == 3
    assert state.n_rows == history.filter(F.col("event_date") <= days[-3]).count()


def test_windows_across_days(spark, tmp_path):
    """Scores half a minute on either side of midnight belong to one window."""
    midnight = (FIRST + 1) * 86400.0
    path = [midnight + s for s in (-40.0, -35.0, -30.0, -25.0, 0.0, 25.0, 30.0, 90_000.0)]
    df = frame(spark, [dict(time=t, x=(i % 2) * 500) for i, t in enumerate(path)])
    check(spark, with_event_date(df), str(tmp_path), open_days=1)


def test_gaps_across_days(spark, tmp_path):
    """Plate by plate, another reading around midnight lacks its road's length."""
    midnight = (FIRST + 1) * 86400.0
    path = [midnight + s for s in (-50.0, -40.0, -30.0, -20.0, 10.0, 20.0, 30.0, 200_000.0)]
    readings_ = [
        dict(plate=f"P{gap}", time=t, x=(i % 2) * 500, y=i // 3)
        for gap in range(8) for i, t in enumerate(path)
    ]
    df = frame(spark, readings_)
    complete = F.col("_id") % 8 != F.floor(F.col("_id") / 8)
    df = df.withColumn("road_size", F.when(complete, F.col("road_size")))
    check(spark, with_event_date(df), str(tmp_path), Params(min_score=1), open_days=1)


def test_a_reading_from_the_future_closes_nothing_else(spark, history, tmp_path):
    base = str(tmp_path)
    ahead = frame(spark, [dict(plate="Z", time=4e9)]).withColumn("_id", F.lit(-1).cast("long"))
    check(spark, history.unionByName(with_event_date(ahead)), base)
    last = history.agg(F.unix_date(F.max("event_date"))).first()[0]
    assert closed_days.load(spark, base).through == last - 2


def test_late_readings_reopen_the_days(spark, history, tmp_path):
    base = str(tmp_path)
    late = F.col("_id") % 50 == 7
    check(spark, history.filter(~late), base)
    check(spark, history, base)
    assert closed_days.load(spark, base).generation == 1


def test_other_settings_reopen_the_days(spark, history, tmp_path):
    base = str(tmp_path)
    check(spark, history, base)
    check(spark, history, base, Params(harsh_acc=10, min_infractions=2))
    assert closed_days.load(spark, base).generation == 1


def test_split_plates(spark, history, tmp_path):
    check(spark, history, str(tmp_path), segment_rows=30, open_days=3)


def test_unlogged_step_does_not_count(spark, history, tmp_path, monkeypatch):
    base = str(tmp_path)
    monkeypatch.setattr(closed_days, "LOG", "broken")
    with pytest.raises(Exception):
        closed_days.close(spark, history, base, FIRST + 2)
    monkeypatch.undo()
    assert glob.glob(f"{base}/generation=0/*") and closed_days.load(spark, base) is None
    (tmp_path / "log" / "_temporary").mkdir(parents=True)
    assert closed_days.load(spark, base) is None
    check(spark, history, base)


def test_open_days_are_all_that_is_read(spark, history, tmp_path):
    from kinelane.sources.history import append_history, read_history

    append_history(history, str(tmp_path / "history"))
    stored = read_history(spark, str(tmp_path / "history"))
    base = str(tmp_path / "closed")
    with closed_days.past_analyses(spark, stored, base, as_of=AS_OF) as (tables, _):
        tables["historical2"].collect()
    through = closed_days.load(spark, base).through
    plan = closed_days._after(stored, through)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_minimum_below_one_is_refused(spark, history, tmp_path):
    with pytest.raises(ValueError):
        check(spark, history, str(tmp_path), Params(min_infractions=0))


def test_merged_stats(spark):
    sums = spark.createDataFrame(
        [("r", 2, 10, 2000, 1), ("r", 1, 5, 1000, 0), ("s", 1, 0, 1000, 0)],
        "road string, n long, speeds long, sizes long, still long",
    )
    assert rows(past.merged_road_stats(sums), "road", "avg_speed", "avg_time_to_cross") == [
        ("r", 5.0, 200.0), ("s", 0.0, None),
    ]
