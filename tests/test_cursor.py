import random

from pyspark.sql import functions as F

from helpers import frame
from kinelane.operators import cursor
from kinelane.operators.cursor import Cursor, next_cut, start


def legacy_next_cut(cut: float, max_time: float | None, window: float = 60.0) -> float:
    """As the stock loop moves it: data exactly ``window`` past the cut counts as none."""
    if max_time is None:
        return cut
    if max_time - window == cut:
        return max_time
    return max_time - window


def test_transitions():
    first = start()
    assert first == Cursor(-60.0, None)
    assert next_cut(first, None) == first
    busy = next_cut(first, 1000.0)
    assert busy == Cursor(940.0, 1000.0)
    idle = next_cut(busy, 1000.0)
    assert idle == Cursor(1000.0, 1000.0)
    assert next_cut(idle, None) == idle
    assert next_cut(idle, 1001.0) == Cursor(941.0, 1001.0)


def test_late_data_only_is_no_new_data():
    assert next_cut(Cursor(940.0, 1000.0), 950.0) == Cursor(1000.0, 1000.0)


def test_data_exactly_a_window_ahead():
    """The stock loop takes it for none; ours follows it."""
    assert legacy_next_cut(1000.0, 1060.0) == 1060.0
    assert next_cut(Cursor(1000.0, 1000.0), 1060.0) == Cursor(1000.0, 1060.0)


def test_same_cuts_as_the_stock_loop():
    """Over growing histories, until data comes exactly a window past the cut."""
    rng = random.Random(7)
    for _ in range(300):
        now, times, mine, theirs, known = 1000.0, [], start(), -60.0, None
        for _ in range(30):
            if rng.random() < 0.6:
                now += rng.choice([0.5, 7.0, 59.0, 61.0])
                times.append(now)
            assert mine.cut == theirs
            after = [t for t in times if t > mine.cut]
            latest = max(after) if after else None
            following = next_cut(mine, latest)
            assert following.last_max is None or known is None or following.last_max >= known
            known = following.last_max
            coincidence = latest is not None and latest - 60 == theirs and latest != mine.last_max
            theirs = legacy_next_cut(theirs, latest)
            mine = following
            if coincidence:
                break


def test_latest_time(spark):
    df = frame(spark, [dict(time=3.0), dict(time=9.0)])
    assert cursor.scalar(cursor.latest_time(df)) == 9.0
    assert cursor.scalar(cursor.latest_time(df, cut=9.0)) is None


def test_changes_cross_stretches(spark, monkeypatch):
    monkeypatch.setattr(cursor, "PASSES_PER_SEGMENT", 3)
    cuts = [0.0, 5.0, 5.0, 5.0, 5.0, 7.0, 7.0, 5.0, 5.0]
    log = spark.createDataFrame(list(enumerate(cuts)), "run_id long, cut double")
    changed = cursor.changes(log).orderBy("run_id").collect()
    assert [tuple(r) for r in changed] == [(1, 5.0), (5, 7.0), (7, 5.0)]


def test_replay_moves_to_the_latest_time_when_idle(spark):
    df = frame(spark, [dict(time=t) for t in (100.0, 101.0, 200.0, 261.0)])
    log = cursor.replay(df, 60).orderBy("run_id").collect()
    assert [tuple(r) for r in log] == [(1, 41.0), (2, 101.0), (3, 140.0), (4, 201.0)]
    state, expected = start(), []
    for until in (120, 180, 240, 300):
        seen = df.filter(F.col("time") < until)
        state = next_cut(state, cursor.scalar(cursor.latest_time(seen, state.cut)))
        expected.append(state.cut)
    assert [r.cut for r in log] == expected
