import glob

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.operators import history as past
from kinelane.operators import live, snapshot
from kinelane.operators.cursor import Cursor, start
from kinelane.operators.kinematics import with_kinematics
from kinelane.plans import refresh as plan
from kinelane.sources import results
from kinelane.sources.events import load_events, plain, readings
from kinelane.sources.history import append_history, read_history

AS_OF = 1_700_000_000.0


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "history")
    append_history(plain(readings(load_events(spark, "/root/testdata/sf0.01"))), path)
    return path


def same(left, right):
    left = left.select(*right.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def expected(df, cut):
    snap, vehicles = snapshot.snapshot(df, cut), snapshot.live_vehicles(df, cut)
    moving = with_kinematics(df)
    return {
        "analysis1": live.road_count(snap),
        "analysis2": live.vehicle_count(snap),
        "analysis3": live.overspeed_count(vehicles),
        "analysis4": live.collision_count(vehicles),
        "analysis5": live.overspeed_list(vehicles),
        "analysis6": live.collision_list(vehicles),
        "historical1": past.top_vehicles(df),
        "historical2": past.road_stats_joined(moving),
        "historical3": past.banned_vehicles(moving, as_of=AS_OF),
        "alternative": past.dangerous_driving(moving),
    }


def test_runs_publish_all_tables(spark, stored, tmp_path):
    base = str(tmp_path / "results")
    df = read_history(spark, stored)
    top = df.agg(F.max("time")).first()[0]
    cursor = start()
    for run_id, cut in enumerate((-60.0, top - 60, top)):
        assert cursor.cut == cut
        assert results.next_run(spark, base) == (run_id, cursor)
        cursor = plan.run_once(spark, df, base, run_id, cursor, as_of=AS_OF)
        for name, table in expected(df, cut).items():
            assert same(results.read_result(spark, base, name), table), name
        stamp = results.read_result(spark, base, "lasttimestamp")
        assert rows(stamp, "LastTimeStamp") == [(cut,)]
        times = results.read_result(spark, base, "times")
        assert sorted(r.analysis for r in times.collect()) == sorted(plan.TIMED)
        log = results.last_run(spark, base)
        assert log.history_rows == df.count()
        assert log.recent_rows == df.filter(F.col("time") > cut).count()
        assert log.batch_rows == snapshot.snapshot(df, cut).count()
    assert cursor == Cursor(top, top)
    results.write_cut_changes(spark, base, str(tmp_path / "times"))
    logged = spark.read.csv(str(tmp_path / "times"), header=True, inferSchema=True)
    assert [r.times for r in logged.collect()] == [-60.0, top - 60, top]


def test_runs_with_split_plates(spark, stored, tmp_path):
    df = read_history(spark, stored).filter(F.col("plate") < "AA012")
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    plan.run_once(spark, df, one, 0, start(), as_of=AS_OF)
    plan.run_once(spark, df, other, 0, start(), as_of=AS_OF, segment_rows=70)
    for name in (*plan.LIVE, *plan.PAST):
        assert same(
            results.read_result(spark, one, name), results.read_result(spark, other, name)
        ), name


def test_tables_in_another_format(spark, stored, tmp_path):
    df = read_history(spark, stored).filter(F.col("plate") < "AA008")
    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    plan.run_once(spark, df, one, 0, start(), as_of=AS_OF)
    plan.run_once(spark, df, other, 0, start(), as_of=AS_OF, fmt="orc", options={"compression": "zlib"})
    for name in plan.TABLES:
        written = results.read_result(spark, other, name, "orc")
        assert glob.glob(f"{other}/{name}/run_id=0/*.zlib.orc"), name
        if name != "times":
            assert same(results.read_result(spark, one, name), written), name


def test_a_second_commit_of_a_run_counts(spark, tmp_path):
    base = str(tmp_path)
    results.commit_run(spark, base, 0, 1.0, Cursor(2.0, 3.0), (1, 1, 1))
    results.commit_run(spark, base, 0, 1.0, Cursor(5.0, 6.0), (2, 2, 2))
    assert results.run_log(spark, base).count() == 1
    assert results.next_run(spark, base) == (1, Cursor(5.0, 6.0))


def test_nothing_stays_cached_and_new_data_is_seen(spark, tmp_path):
    path, base = str(tmp_path / "history"), str(tmp_path / "results")
    append_history(frame(spark, track("A", [0, 1, 2])), path)
    cursor = plan.run_once(spark, read_history(spark, path), base, 0, start())
    append_history(frame(spark, track("B", [0, 9, 30], start=100.0)), path)
    plan.run_once(spark, read_history(spark, path), base, 1, cursor)
    assert results.read_result(spark, base, "historical1").count() == 2
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_failed_run_is_not_visible(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "results")
    df = frame(spark, track("A", [0, 1, 2]))
    cursor = plan.run_once(spark, df, base, 0, start())

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(plan.past, "dangerous_driving", fail)
    with pytest.raises(RuntimeError):
        plan.run_once(spark, frame(spark, []), base, 1, cursor)
    monkeypatch.undo()
    assert results.read_result(spark, base, "historical1").count() == 1
    assert results.next_run(spark, base) == (1, cursor)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()
    plan.run_once(spark, df, base, 1, cursor)
    assert results.last_run(spark, base).run_id == 1


def test_old_tables_are_pruned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(results, "RUNS_PER_BLOCK", 2)
    base = str(tmp_path / "results")
    df, cursor = frame(spark, track("A", [0, 1, 2])), start()
    for run_id in range(3):
        cursor = plan.run_once(spark, df, base, run_id, cursor)
    results.prune_results(spark, base, list(plan.TABLES), keep_seconds=600)
    assert len(glob.glob(f"{base}/historical1/*")) == 3
    results.prune_results(spark, base, list(plan.TABLES), keep_seconds=0)
    assert len(glob.glob(f"{base}/historical1/*")) == 1
    assert results.run_log(spark, base).count() == 3
    (tmp_path / "results" / "runs" / "block=7" / "_temporary").mkdir(parents=True)
    assert results.last_run(spark, base).run_id == 2
    with pytest.raises(FileNotFoundError):
        results.read_result(spark, str(tmp_path / "other"), "historical1")
