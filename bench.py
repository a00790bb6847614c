"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinelane.operators import history as past  # noqa: E402
from kinelane.operators import live, snapshot  # noqa: E402
from kinelane.operators.cursor import start  # noqa: E402
from kinelane.plans.catalog import QUERIES  # noqa: E402
from kinelane.plans.refresh import (  # noqa: E402
    moving_history,
    open_days,
    run_once,
    whole_history,
)
from kinelane.schema import Params  # noqa: E402
from kinelane.sources.events import START, load_events, plain, readings  # noqa: E402
from kinelane.sources.history import append_history, read_history  # noqa: E402
from kinelane.sources.results import write_result  # noqa: E402
from kinelane.streaming import ledger  # noqa: E402
from kinelane.streaming.refresh import refresh_ledger  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

# The reference's ten analyses, then the steps they share.
HEADLINE = {
    "analysis1": "live_road_count",
    "analysis2": "live_vehicle_count",
    "analysis3": "live_overspeed_count",
    "analysis4": "live_collision_count",
    "analysis5": "live_overspeed_list",
    "analysis6": "live_collision_list",
    "historical1": "top_road_vehicles",
    "historical2": "road_stats_single_pass",
    "historical3": "banned_vehicles",
    "alternative": "dangerous_driving",
    "history_kinematics": "history_kinematics",
    "payload_roundtrip": "payload_roundtrip",
    "active_history": "active_history_semi",
}


def best(action) -> float:
    """The best of a few runs; the caller has warmed up."""
    seconds = []
    for _ in range(REPEATS):
        began = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - began)
    return round(min(seconds), 4)


def recomputed(history):
    """Each analysis from the stored history on its own, nothing shared."""
    cut, params, n_rows = start().cut, Params(), history.count()

    def seen():
        return snapshot.snapshot(history, cut, params)

    def vehicles():
        return snapshot.live_vehicles(history, cut, params, at_most=n_rows)

    def moving():
        return moving_history(history)

    return {
        "analysis6": lambda: live.collision_list(vehicles()),
        "analysis4": lambda: live.collision_count(vehicles()),
        "analysis1": lambda: live.road_count(seen()),
        "analysis2": lambda: live.vehicle_count(seen()),
        "analysis5": lambda: live.overspeed_list(vehicles()),
        "analysis3": lambda: live.overspeed_count(vehicles()),
        "historical1": lambda: past.top_vehicles(history),
        "historical2": lambda: past.road_stats_joined(moving()),
        "historical3": lambda: past.banned_vehicles(moving()),
        "alternative": lambda: past.dangerous_driving(moving()),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def materialise(query: str) -> None:
        QUERIES[query](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    for query in HEADLINE.values():
        materialise(query)
    seconds = {name: best(lambda q=query: materialise(q)) for name, query in HEADLINE.items()}

    # Whole refreshes over a stored history: of one day, and of the month it is drawn from.
    scratch = tempfile.mkdtemp(prefix="bench-")
    rows = plain(readings(load_events(spark, SF_DIR)))
    append_history(rows, f"{scratch}/history")
    month = F.lit(float(START)) + (F.col("time") - START) * 600
    append_history(rows.withColumn("time", month), f"{scratch}/month")
    ledger.append_readings(rows.withColumn("time", month), f"{scratch}/ledger", 0)
    runs = iter(range(1000))

    def separate() -> None:
        run_id, history = next(runs), read_history(spark, f"{scratch}/history")
        for name, table in recomputed(history).items():
            write_result(table(), f"{scratch}/separate", name, run_id)

    def shared(historical, stored: str, base: str) -> None:
        history = read_history(spark, f"{scratch}/{stored}")
        run_once(spark, history, f"{scratch}/{base}", next(runs), start(), historical=historical)

    # A steady run finds the month's past days closed; a first one closes them.
    refreshes = {
        "separate": separate,
        "shared": lambda: shared(whole_history, "history", "shared"),
        "open_days": lambda: shared(open_days, "history", "open"),
        "shared_month": lambda: shared(whole_history, "month", "shared_month"),
        "open_days_month_steady": lambda: shared(open_days, "month", "open_month"),
        "ledger_month_steady": lambda: refresh_ledger(spark, f"{scratch}/ledger", f"{scratch}/chain_month"),
    }
    for action in refreshes.values():
        action()
    refresh_seconds = {name: best(action) for name, action in refreshes.items()}
    firsts = iter(range(1000))
    refresh_seconds["open_days_month_first"] = best(
        lambda: shared(open_days, "month", f"first_{next(firsts)}")
    )
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds_of_headline_queries",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "refresh": refresh_seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
