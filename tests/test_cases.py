"""Hand-made cases the event table does not reach."""

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.functions import rules
from kinelane.operators import history, live, snapshot, views
from kinelane.operators.kinematics import numbered, with_kinematics
from kinelane.schema import READING, Params


def test_speed_and_acceleration(spark):
    moving = with_kinematics(frame(spark, track("A", [0, 10, 30, 25])))
    assert rows(moving, "time", "speed", "acc") == [(2.0, 20, 10), (3.0, 5, -15)]


def test_speed_per_second(spark):
    moving = with_kinematics(frame(spark, track("A", [0, 10, 30], every=2.0)), per_second=True)
    assert rows(moving, "speed", "acc") == [(10.0, 5.0)]


def test_speed_spans_roads(spark):
    two_roads = track("A", [0, 10], road="r") + track("A", [70], start=2.0, road="s")
    assert rows(with_kinematics(frame(spark, two_roads)), "road", "speed") == [("s", 60)]


def test_equal_times_follow_the_id(spark):
    tied = [dict(x=x, time=5.0) for x in (0, 10, 40, 100)]
    moving = with_kinematics(frame(spark, tied))
    assert rows(moving, "_id", "speed", "acc") == [(2, 30, 20), (3, 60, 30)]


def test_null_in_any_column_drops_the_row(spark):
    four = track("A", [0, 10, 30, 60])
    four[3]["road"] = None
    assert rows(with_kinematics(frame(spark, four)), "time") == [(2.0,)]
    four[3] = dict(four[3], road="r", time=float("nan"))
    assert rows(with_kinematics(frame(spark, four)), "x") == [(30,)]


def test_road_where_nothing_moves(spark):
    still = with_kinematics(frame(spark, track("A", [5, 5, 5, 5])))
    for stats in (history.road_stats(still), history.road_stats_joined(still)):
        assert stats.collect() == [("r", 0.0, None, 2)]


def test_road_without_collision(spark):
    moving = with_kinematics(frame(spark, track("A", [0, 5, 10])))
    for stats in (history.road_stats(moving), history.road_stats_joined(moving)):
        assert stats.collect() == [("r", 5.0, 200.0, None)]


def test_plates_with_few_readings_are_only_counted(spark):
    df = frame(spark, track("A", [0, 500]) + track("B", [0]) + track("C", [0, 10, 500]))
    snap = snapshot.snapshot(df, cut=-60)
    assert live.vehicle_count(snap).first()[0] == 3
    vehicles = snapshot.live_vehicles(df, cut=-60)
    assert rows(live.overspeed_list(vehicles), "plate", "speed") == [("C", 490)]


def test_cut_off_is_exclusive(spark):
    df = frame(spark, [
        dict(plate="A", time=1000.0), dict(plate="A", time=760.0), dict(plate="A", time=760.5),
        dict(plate="B", time=1000.5), dict(plate="B", time=760.0), dict(plate="B", time=760.5),
    ])
    assert rows(snapshot.recent(df, 1000), "plate") == [("B",)]
    assert rows(snapshot.snapshot(df, 1000), "plate", "time", "row") == [
        ("B", 760.5, 2), ("B", 1000.5, 1),
    ]


def test_late_reading_activates_its_plate(spark):
    late = frame(spark, [dict(plate="A", time=941.0), dict(plate="B", time=1000.0)])
    assert rows(snapshot.snapshot(late, 940), "plate") == [("A",), ("B",)]


def test_only_the_latest_three_count(spark):
    snap = snapshot.snapshot(frame(spark, track("A", [0, 1, 2, 3, 4])), cut=-60)
    assert rows(snap, "row", "x") == [(1, 4), (2, 3), (3, 2)]


def vehicle(plate, x, speed, acc, direction=1, y=0):
    return (plate, "r", y, x, speed, acc, direction)


def risk(spark, *vehicles):
    names = "plate string, road string, y int, x int, speed int, acc int, direction int"
    flagged = snapshot.with_collision_risk(spark.createDataFrame(list(vehicles), names))
    return dict(rows(flagged, "plate", "collision_risk"))


def test_collision_risk_forward(spark):
    assert risk(spark, vehicle("A", 0, 50, 10), vehicle("B", 40, 10, 5)) == {"A": 1, "B": 0}
    assert risk(spark, vehicle("A", 0, 50, 5), vehicle("B", 40, 10, 5)) == {"A": 0, "B": 0}


def test_collision_risk_backward(spark):
    ahead, behind = vehicle("A", 40, 10, 5, -1), vehicle("B", 80, 50, 10, -1)
    assert risk(spark, ahead, behind) == {"A": 0, "B": 1}


def test_collision_risk_needs_the_same_lane(spark):
    assert risk(spark, vehicle("A", 0, 90, 9), vehicle("B", 5, 1, 0, y=1)) == {"A": 0, "B": 0}


def test_collision_risk_ties_follow_the_plate(spark):
    assert risk(spark, vehicle("B", 5, 1, 0), vehicle("A", 5, 9, 0)) == {"A": 1, "B": 0}


def test_first_row_over_the_limit_is_an_infraction(spark):
    flags = history.infraction_flags(with_kinematics(frame(spark, track("A", [0, 0, 200, 500]))))
    assert rows(flags, "time", "change_in_speed") == [(2.0, 1), (3.0, 0)]


def test_previous_speed_meets_the_current_limit(spark):
    """The limit drops between two fast readings: the slower limit was already broken."""
    path = track("A", [0, 50, 100, 200])
    for reading, limit in zip(path, (100, 100, 60, 40)):
        reading["road_speed"] = limit
    flags = history.infraction_flags(with_kinematics(frame(spark, path)))
    assert rows(flags, "speed", "change_in_speed") == [(50, 0), (100, 0)]
    for reading in path:
        reading["road_speed"] = 60
    flags = history.infraction_flags(with_kinematics(frame(spark, path)))
    assert rows(flags, "speed", "change_in_speed") == [(50, 0), (100, 1)]


def test_retention_keeps_the_view_of_dropped_rows(spark):
    moving = with_kinematics(frame(spark, track("A", [0, 0, 200, 400, 600])))
    params = Params(retention_seconds=2)
    assert rows(history.banned_vehicles(moving, params, as_of=5), "plate") == []
    assert history.banned_vehicles(moving, Params(), as_of=5).collect() == [("A", 1)]


def test_infractions_need_the_minimum(spark):
    moving = with_kinematics(frame(spark, track("A", [0, 0, 200, 200, 400])))
    assert history.banned_vehicles(moving, Params(min_infractions=2)).collect() == [("A", 2)]
    assert history.banned_vehicles(moving, Params(min_infractions=3)).isEmpty()


WIDE = Params(band_start=-1, band_end=1e9)


def scored(spark, *entries):
    names = "_id long, plate string, time double, total int"
    return spark.createDataFrame([(i, "A", *e) for i, e in enumerate(entries)], names)


@pytest.mark.parametrize("entries, starts", [
    ([(0.0, 3), (60.0, 4)], [0.0]),
    ([(0.0, 3), (60.1, 4)], []),
    ([(0.0, 6)], []),
    ([(0.0, 7)], [0.0]),
    ([(5.0, 4), (5.0, 3), (5.0, 1)], [5.0, 5.0, 5.0]),
    ([(float(i), 1) for i in range(9)], [0.0, 1.0, 2.0]),
])
def test_score_window(spark, entries, starts):
    severe = history.severe_windows(scored(spark, *entries))
    assert [t for (t,) in rows(severe, "time")] == starts
    sums = history.window_scores(scored(spark, *entries)).filter("window_total >= 7")
    assert sums.count() == len(starts)


def test_harsh_acceleration_is_beyond_the_limit(spark):
    values = spark.createDataFrame([(v,) for v in (40, -40, 41, -41)], "acc int")
    scores = values.select("acc", rules.flag(rules.harsh(40), 3).alias("s"))
    assert rows(scores, "acc", "s") == [(-41, 3), (-40, 0), (40, 0), (41, 3)]


def test_no_lane_change_at_the_start_of_the_band(spark):
    path = track("A", [0, 1, 2, 3, 4])
    for reading, lane in zip(path, (0, 0, 0, 1, 0)):
        reading["y"] = lane
    moving = with_kinematics(frame(spark, path))
    inside = Params(band_start=2.0, band_end=100)
    assert rows(history.driving_scores(moving, WIDE), "time") == [(3.0,), (4.0,)]
    assert rows(history.driving_scores(moving, inside), "time") == [(4.0,)]
    assert history.driving_scores(moving, Params(band_start=2.0, band_end=4.0)).isEmpty()


def test_top_vehicles_break_ties_by_plate(spark):
    seen = [dict(plate=p, road=r) for p, r in ("Cr", "Cs", "Br", "Ar", "Ar")]
    top = history.top_vehicles(frame(spark, seen), Params(top_vehicles=2))
    assert top.collect() == [("C", 2), ("A", 1)]


def test_empty_history(spark):
    none = spark.createDataFrame([], READING)
    snap = snapshot.snapshot(none, -60)
    vehicles = snapshot.live_vehicles(none, -60)
    for counted in (live.road_count(snap), live.vehicle_count(snap),
                    live.overspeed_count(vehicles), live.collision_count(vehicles)):
        assert [tuple(r) for r in counted.collect()] == [(0,)]
    moving = with_kinematics(none)
    for listed in (live.overspeed_list(vehicles), live.collision_list(vehicles),
                   history.top_vehicles(none), history.road_stats(moving),
                   history.banned_vehicles(moving), history.dangerous_driving(moving)):
        assert listed.isEmpty()


def test_views(spark):
    stats = spark.createDataFrame([(1, "r", 2.125, None, 3)],
                                  "_id long, road string, avg_speed double, "
                                  "avg_time_to_cross double, total_collisions long")
    assert views.road_stats(stats).collect() == [("r", 2.12, None, 3)]
    listed = spark.createDataFrame([("A", 5, 1), ("B", 6, 0)],
                                   "plate string, speed int, collision_risk int")
    assert rows(views.overspeed(listed), "plate", "collision_risk") == [("A", "Yes"), ("B", "No")]
    times = spark.createDataFrame([("analysis1", 1.005)], "analysis string, time double")
    assert views.run_times(times).columns == ["analysis", "time"]


def test_order_of_input_does_not_matter(spark):
    path = track("A", [0, 10, 40, 200, 210]) + track("B", [5, 9, 300, 300, 300], y=1)
    df = frame(spark, path)
    shuffled = df.orderBy(F.xxhash64("_id")).repartition(5)
    for analysis in (history.road_stats, history.banned_vehicles, history.infraction_flags):
        one = analysis(with_kinematics(df))
        other = analysis(with_kinematics(shuffled))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert rows(numbered(df), "_id", "row") == rows(numbered(shuffled), "_id", "row")
