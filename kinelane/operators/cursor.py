"""The moving cut-off between live and old readings."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinelane.operators.ordered import SEG, own, pad
from kinelane.operators.snapshot import recent

PASSES_PER_SEGMENT = 100_000


class Cursor(NamedTuple):
    """The cut-off of the next pass, and the latest time seen so far."""

    cut: float
    last_max: float | None


def start(window: float = 60.0) -> Cursor:
    """Before the first pass every plate ever seen counts as active."""
    return Cursor(-window, None)


def next_cut(cursor: Cursor, max_time: float | None, window: float = 60.0) -> Cursor:
    """Follow new data with the cut-off; without any, move it up to the latest time.

    ``max_time`` is the latest reading after the cut-off, or None.
    """
    if max_time is not None and (cursor.last_max is None or max_time > cursor.last_max):
        return Cursor(max_time - window, max_time)
    if cursor.last_max is not None:
        return Cursor(cursor.last_max, cursor.last_max)
    return cursor


def latest_time(df: DataFrame, cut: float | None = None) -> DataFrame:
    """One row: the latest time (after the cut-off), null if there is none."""
    rows = df if cut is None else recent(df, cut)
    return rows.agg(F.max("time").alias("max_time"))


def scalar(one_row: DataFrame):
    """The one value of a one-row, one-column frame."""
    return one_row.first()[0]


def changes(log: DataFrame, run: str = "run_id", first: float = 0.0) -> DataFrame:
    """Rows of the run log whose ``cut`` differs from the run before.

    The run before the first counts as ``first``. Runs are whole numbers; the log
    is windowed in stretches of them, so no task gets all of it.
    """

    line = pad(_stretches(log, run), [], [run], before=1)
    before = F.lag("cut", 1).over(Window.partitionBy(SEG).orderBy(run))
    compared = own(line.withColumn("_before", F.coalesce(before, F.lit(float(first)))))
    return compared.filter(F.col("cut") != F.col("_before")).drop("_before", SEG)


def _stretches(log: DataFrame, run: str) -> DataFrame:
    return log.withColumn(SEG, F.floor(F.col(run) / PASSES_PER_SEGMENT).cast("int"))


def replay(df: DataFrame, pass_seconds: float, window: float = 60.0) -> DataFrame:
    """The run log a loop would leave that passes over the history every so often.

    One pass per ``pass_seconds`` of event time, up to the last reading. A pass
    with new readings sets the cut ``window`` behind the latest; the first one
    without sets it at the latest, and further ones leave it there, so they are
    left out.
    """
    passes = df.groupBy(F.floor(F.col("time") / pass_seconds).alias("run_id")).agg(
        F.max("time").alias("_max")
    )

    line = pad(_stretches(passes, "run_id"), [], ["run_id"], after=1)
    following = F.lead("run_id").over(Window.partitionBy(SEG).orderBy("run_id"))
    gap = F.coalesce(following > F.col("run_id") + 1, F.lit(False))
    known = own(line.withColumn("_idle", gap))
    busy = known.select("run_id", (F.col("_max") - window).alias("cut"))
    idle = known.filter("_idle").select(F.col("run_id") + 1, F.col("_max"))
    return busy.union(idle)
