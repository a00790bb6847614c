"""The chain of days against a full pass, and what it does not read."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows
from kinelane.operators import history as past
from kinelane.plans import day_chain
from kinelane.plans.refresh import moving_history
from kinelane.plans.refresh import past_analyses as full_pass
from kinelane.schema import Params, with_event_date
from kinelane.sources.events import load_events, plain, readings

AS_OF = 1_686_000_000.0
FIRST = 19502  # 2023-05-25
LONG = Params(min_score=3, score_window_seconds=20_000)


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached(spark):
    yield
    spark.catalog.clearCache()


@pytest.fixture(scope="module")
def history(spark):
    """Ten days of readings: the time of the events runs 200 times as fast."""
    df = plain(readings(load_events(spark, "/root/testdata/sf0.001")))
    slow = F.lit(FIRST * 86400.0) + F.floor((F.col("time") - 1_685_000_000) * 200)
    df = with_event_date(df.withColumn("time", F.when(F.col("_id") % 5 == 0, slow - 30).otherwise(slow)))
    return df.cache()


def check(spark, df, base, params=LONG, readable=None, **options):
    """All tables as in a full pass; only ``readable`` is given to the chain to read."""
    full = full_pass(moving_history(df), df, params, AS_OF)
    found = day_chain.digests(df)
    given = df if readable is None else readable
    with day_chain.past_analyses(spark, given, base, params, AS_OF, found=found, **options) as (tables, n):
        assert n == df.count()
        for name, table in tables.items():
            columns = full[name].columns
            assert sorted(table.columns) == sorted(columns)
            assert rows(table, *columns) == rows(full[name], *columns), name
    return day_chain.load(spark, base)


def days_of(chain, commit):
    """The days that a commit wrote."""
    return sorted(d - FIRST for d, day in chain.days.items() if day.folder.startswith(f"v={commit}/"))


def on_days(df, days):
    dates = [datetime.date(1970, 1, 1) + datetime.timedelta(days=FIRST + d) for d in days]
    return df.filter(F.col("event_date").isin(dates))


def test_day_by_day(spark, history, tmp_path):
    base = str(tmp_path)
    for day in (1, 3, 6, 9):
        chain = check(spark, history.filter(F.unix_date("event_date") <= FIRST + day), base)
    assert chain.commit == 2 and days_of(chain, 2) == [5, 6, 7]
    assert (1, 19504) in chain.blocks and len(chain.cover(0, 1 << 30)) < len(chain.days)


def test_a_late_reading_rewrites_its_day_alone(spark, tmp_path):
    """It comes early in the day, its plate has later ones: no other closed day is read."""
    drives = [
        dict(plate=plate, time=(FIRST + d) * 86400.0 + 3600 + 10 * i, x=d * 500 + i * i * 9, y=(d + i) % 3)
        for plate in "AB" for d in range(9) for i in range(12)
    ]
    df = with_event_date(frame(spark, drives)).cache()
    base, params, late = str(tmp_path), Params(min_score=3), 3 * 12 + 4
    check(spark, df.filter(F.col("_id") != late), base, params)
    chain = check(spark, df, base, params, readable=on_days(df, [3, 7, 8]))
    assert days_of(chain, 1) == [3]


def test_replaced_added_and_removed_readings_are_noticed(spark, history, tmp_path):
    """Each changes its day's digest, also where the number of rows stays the same."""
    base = str(tmp_path)
    check(spark, history, base)
    some = history.filter(F.unix_date("event_date") == FIRST + 2).orderBy("_id").first()._id
    there = F.col("_id") == some
    replaced = history.withColumn("x", F.when(there, F.col("x") + 3000).otherwise(F.col("x"))).cache()
    chain = check(spark, replaced, base)
    assert chain.commit == 1 and 2 in days_of(chain, 1)
    added = replaced.unionByName(replaced.filter(there).withColumn("_id", F.lit(-5).cast("long"))).cache()
    assert check(spark, added, base).commit == 2
    assert check(spark, added.filter(~there), base).commit == 3
    assert check(spark, added.filter(~there), base).commit == 3


def test_replay_reaches_the_days_whose_state_moved(spark, tmp_path):
    """A plate's last reading of a day moves: its next day is replayed, days in between not."""
    drives = [
        dict(plate=plate, time=(FIRST + d) * 86400.0 + 3600 + 10 * i, x=d * 500 + i * i * 9, y=(d + i) % 3)
        for plate, days in (("A", (0, 4, 6)), ("B", range(9))) for d in days for i in range(6)
    ]
    before = with_event_date(frame(spark, drives)).cache()
    base = str(tmp_path)
    params = Params(min_score=3)
    check(spark, before, base, params)
    last = F.col("_id") == 5
    after = before.withColumn("x", F.when(last, F.col("x") + 400).otherwise(F.col("x"))).cache()
    chain = check(spark, after, base, params, readable=on_days(after, [0, 4, 7, 8]))
    assert days_of(chain, 1) == [0, 4]


def test_scores_around_midnight_reach_the_next_day(spark, tmp_path):
    """A window that starts late in a day is settled by the next one."""
    midnight = (FIRST + 1) * 86400.0
    path = [midnight + s for s in (-40.0, -35.0, -30.0, -25.0, 0.0, 25.0, 30.0, 90_000.0, 260_000.0)]
    df = frame(spark, [dict(time=t, x=(i % 2) * 500) for i, t in enumerate(path)])
    df = with_event_date(df).cache()
    base = str(tmp_path)
    check(spark, df.filter("_id <> 3"), base, Params(), open_days=1)
    check(spark, df, base, Params(), open_days=1)


def test_a_day_that_loses_all_rows(spark, history, tmp_path):
    base = str(tmp_path)
    check(spark, history, base)
    gone = history.filter(F.unix_date("event_date") != FIRST + 4)
    check(spark, gone, base)
    check(spark, history, base)


def test_gaps_and_incomplete_readings(spark, tmp_path):
    midnight = (FIRST + 1) * 86400.0
    path = [midnight + s for s in (-50.0, -40.0, -30.0, -20.0, 10.0, 20.0, 30.0, 200_000.0)]
    drives = [
        dict(plate=f"P{gap}", time=t, x=(i % 2) * 500, y=i // 3)
        for gap in range(8) for i, t in enumerate(path)
    ]
    df = frame(spark, drives)
    complete = F.col("_id") % 8 != F.floor(F.col("_id") / 8)
    df = with_event_date(df.withColumn("road_size", F.when(complete, F.col("road_size"))))
    check(spark, df, str(tmp_path), Params(min_score=1), open_days=1)


def test_retention_counts_days_as_sums(spark, history, tmp_path, monkeypatch):
    """Days out of the retention are not read, only the one at its edge is by the reading."""
    base = str(tmp_path)
    read = []
    plain_read = day_chain._Tables.read

    def noted(self, chain, part, cover):
        read.append((part, cover))
        return plain_read(self, chain, part, cover)

    monkeypatch.setattr(day_chain._Tables, "read", noted)
    top = history.agg(F.max("time")).first()[0]
    for keep in (40_000.0, 3.3 * 86400, 5 * 86400 - 0.5, 86400.0 * 20):
        params = Params(retention_seconds=keep)
        full = past.banned_vehicles(moving_history(history), params, top)
        with day_chain.past_analyses(spark, history, base, params, top) as (tables, _):
            columns = ("plate", "total_infractions")
            assert rows(tables["historical3"], *columns) == rows(full, *columns)
        (border,) = [cover for part, cover in read if part == "infraction_times"]
        assert len(border) <= 2
        read.clear()


def test_few_folders_after_many_days(spark):
    """Blocks are aligned, so any range of days is a logarithmic number of them."""
    days = {d: day_chain.Day("v=0/run=0", day_chain.NOTHING) for d in range(100, 1100)}
    blocks = {
        (n, f): "v=0" for n in range(1, 6) for f in range(0, 1100, 4**n) if 100 <= f + 4**n - 1 < 1100
    }
    chain = day_chain.Chain(0, "", days, blocks)
    for first, last in ((0, 5000), (100, 1099), (333, 777), (1098, 1099)):
        cover = chain.cover(first, last)
        seen = [d for level, f in cover for d in range(f, f + 4**level) if d in days]
        assert seen == [d for d in sorted(days) if first <= d <= last]
        assert len(cover) <= 2 * 3 * 6


def test_other_settings_and_broken_commits(spark, history, tmp_path):
    base = str(tmp_path)
    check(spark, history, base)
    chain = check(spark, history, base, Params(harsh_acc=10, min_infractions=2))
    assert days_of(chain, 1) == sorted(d - FIRST for d in chain.days)
    # What a run that failed before its entry left behind counts for nothing.
    (tmp_path / "entries" / "commit=2").mkdir()
    (tmp_path / "v=2").mkdir()
    assert day_chain.load(spark, base).commit == 1
    check(spark, history, base, Params(harsh_acc=10, min_infractions=2))
    for params in (Params(min_infractions=0), Params(score_window_seconds=90_000)):
        with pytest.raises(ValueError):
            check(spark, history, base, params)


def test_readings_of_the_future_and_split_plates(spark, history, tmp_path):
    ahead = frame(spark, [dict(plate="Z", time=4e9 + i, x=i * i * 40) for i in range(5)])
    ahead = with_event_date(ahead.withColumn("_id", -F.col("_id") - 1))
    both = history.unionByName(ahead).cache()
    chain = check(spark, both, str(tmp_path), segment_rows=30)
    assert chain.through < FIRST + 10


def test_nothing_and_repeated_rows(spark, history, tmp_path):
    empty = history.limit(0)
    assert check(spark, empty, str(tmp_path / "a")).commit == -1
    twice = history.unionByName(history).cache()
    roads = past.top_vehicles(twice)
    with day_chain.past_analyses(spark, twice, str(tmp_path / "b"), as_of=AS_OF) as (tables, _):
        assert rows(tables["historical1"], "plate", "road_count") == rows(roads, "plate", "road_count")


def test_digests_add_up_in_any_order(spark, history):
    whole = rows(day_chain.digests(history), "day", "n", "digest")
    parts = [day_chain.digests(history.filter(F.pmod("_id", F.lit(3)) == k)) for k in range(3)]
    line = parts[2].unionByName(parts[0]).unionByName(parts[1])
    assert rows(day_chain.added_up(line), "day", "n", "digest") == whole
    # A null at another place is another row.
    one = frame(spark, [dict(road=None, plate="r", time=5.0)])
    other = frame(spark, [dict(road="r", plate=None, time=5.0)])
    digest = [rows(day_chain.digests(df), "digest") for df in (one, other)]
    assert digest[0] != digest[1]


def test_road_numbers_stay(spark, tmp_path):
    base = str(tmp_path)
    first = spark.createDataFrame([(f"r{i % 50}",) for i in range(200)] + [(None,)], "road string")
    one = dict(rows(day_chain._road_numbers(spark, base, first.repartition(7)), "road", "number"))
    assert sorted(one.values()) == list(range(1, 51))
    more = spark.createDataFrame([(f"r{i}",) for i in range(45, 60)], "road string")
    two = dict(rows(day_chain._road_numbers(spark, base, more), "road", "number"))
    assert {r: n for r, n in two.items() if r in one} == one
    assert sorted(two.values()) == list(range(1, 61))
