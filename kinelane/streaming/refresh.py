"""The refresh loop, driven by a clock so that it also runs when no data comes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinelane.operators.cursor import Cursor
from kinelane.plans import carried
from kinelane.plans.day_chain import chained_days
from kinelane.plans.refresh import TABLES, open_days, run_once
from kinelane.schema import Params
from kinelane.sources import results
from kinelane.streaming import ledger
from kinelane.streaming.ingest import EVERY


def refresh(
    spark: SparkSession,
    read: Callable[[SparkSession], DataFrame],
    base: str,
    params: Params = Params(),
    as_of: float | None = None,
    historical=open_days,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    keep_seconds: float = results.KEEP_SECONDS,
) -> Cursor:
    """One pass: continue from the run log, compute, commit, drop old tables.

    Row-numbered windows and exact distinct counts do not run on a stream, so each
    pass is a batch over the history as it is now. ``read`` lists it anew.
    """
    run_id, cursor = results.next_run(spark, base)
    following = run_once(
        spark, read(spark), base, run_id, cursor, params, as_of,
        historical=historical, fmt=fmt, options=options,
    )
    results.prune_results(spark, base, list(TABLES), keep_seconds)
    return following


def refresh_ledger(
    spark: SparkSession,
    path: str,
    base: str,
    params: Params = Params(),
    as_of: float | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    keep_seconds: float = results.KEEP_SECONDS,
) -> Cursor:
    """One pass over a ledger, whose cost follows what came in since the last one.

    The pass holds on to the sets that are live when it starts, so compaction does not
    disturb it. Live analyses read the newest readings carried along and those that are
    new; historical ones read the open days, and closed days whose digest has changed.
    """
    sets = ledger.live_sets(spark, path)
    history = ledger.read_history(spark, path, sets)
    run_id, cursor = results.next_run(spark, base)
    newest = None
    if sets:
        store, mark = f"{base}/carried", sets[-1].last
        before = carried.load(spark, store)
        if before is None or before.mark > mark:
            newest = carried.advance(spark, store, history, mark, None, params, cursor.last_max)
        elif before.mark == mark:
            newest = before
        else:
            new = ledger.rows_after(spark, path, before.mark, sets)
            if new is None:
                before, new = None, history
            newest = carried.advance(spark, store, new, mark, before, params, cursor.last_max)
    found = chained_days(lambda s: ledger.day_digests(s, path, sets))
    following = run_once(
        spark, history, base, run_id, cursor, params, as_of, historical=found, fmt=fmt,
        options=options, newest=None if newest is None else newest.rows,
    )
    results.prune_results(spark, base, list(TABLES), keep_seconds)
    return following


def start_refresh(
    spark: SparkSession,
    read: Callable[[SparkSession], DataFrame],
    base: str,
    checkpoint: str,
    params: Params = Params(),
    trigger: Mapping = EVERY,
    **refresh_options,
) -> StreamingQuery:
    """Refresh on every trigger until the query is stopped; options as for ``refresh``."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 10).load()

    def tick(batch: DataFrame, _batch_id: int) -> None:
        refresh(batch.sparkSession, read, base, params, **refresh_options)

    writer = ticks.writeStream.foreachBatch(tick)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
