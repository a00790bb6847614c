"""The newest readings of each plate, carried along from tick to tick.

A tick merges the newest three of each plate so far with the newest three of the readings
that came in since, instead of scanning the lookback again. The table is as big as the
fleet seen lately, whatever the length of the history.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelane.operators.snapshot import latest_readings
from kinelane.schema import READING, Params
from kinelane.sources.files import exists, names, remove


class Carried(NamedTuple):
    """The table of a tick, and the last batch in it."""

    mark: int
    rows: DataFrame


def _marks(spark: SparkSession, base: str) -> list[int]:
    found = (name.partition("=") for name in names(spark, base))
    marks = [int(number) for label, _, number in found if label == "mark"]
    return sorted(m for m in marks if exists(spark, f"{base}/mark={m}/_SUCCESS"))


def load(spark: SparkSession, base: str) -> Carried | None:
    """The table of the newest tick."""
    marks = _marks(spark, base)
    if not marks:
        return None
    path = f"{base}/mark={marks[-1]}"
    return Carried(marks[-1], spark.read.schema(READING).parquet(path))


def advance(
    spark: SparkSession,
    base: str,
    new: DataFrame,
    mark: int,
    before: Carried | None = None,
    params: Params = Params(),
    newest: float | None = None,
) -> Carried:
    """The table after the readings ``new``, which reach up to batch ``mark``.

    Without ``before`` they are all there are. ``newest`` is the latest time known: what
    no cut-off from there on looks back to is let go of. The table before stays until the
    next tick.
    """
    rows = new.select(*READING.fieldNames())
    if before is not None:
        rows = before.rows.unionByName(rows)
    if newest is not None:
        # A cut-off follows the latest time by a window at most.
        oldest = newest - params.live_seconds - params.lookback_seconds
        rows = rows.filter(F.col("time") > F.lit(float(oldest)))
    kept = latest_readings(rows, params.latest).drop("row")
    path = f"{base}/mark={mark}"
    kept.select(*READING.fieldNames()).write.mode("overwrite").parquet(path)
    for old in _marks(spark, base)[:-2]:
        remove(spark, f"{base}/mark={old}")
    return Carried(mark, spark.read.schema(READING).parquet(path))
