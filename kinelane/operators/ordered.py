"""Ordered windows that stay parallel when one key holds most of the rows.

A window puts all rows of a key into one task. Where a key has more rows than
one task should sort, ``split_hot_keys`` cuts its ordered rows into segments,
numbered in a ``_seg`` column, and gives each segment copies of the few rows
before and after it, marked in a ``_copy`` column. Windows that look no further
than that are right for the rows of a segment when partitioned by key and
segment (``partition_keys``); ``own`` drops the copies in the end. All windows of
a chain share one split and one shuffle.

``running_total`` is for sums from the first row on: each segment starts from
the totals of the segments before it.

A frame without ``_seg`` is partitioned by its keys alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kinelane.sources.files import new_table_path, remove

SEG = "_seg"
COPY = "_copy"
UNSPLIT = -1

# Rows one task sorts without trouble; a key above this is split.
SEGMENT_ROWS = 4_000_000

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``pinned`` writes within the block at its end."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            remove(spark, path)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def split_hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = SEGMENT_ROWS,
    at_most: int | None = None,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Cut keys with more than ``max_rows`` rows into segments, padded with copies.

    Measures first and returns ``df`` as it is when no key is that big.
    ``at_most`` is a known bound on the rows of ``df`` that saves the measuring.
    """
    if at_most is None:
        at_most = df.count()
    if at_most <= max_rows:
        return df
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot_keys = per_key.filter(F.col("_n") > max_rows).dropna(subset=list(keys))
    hot_keys = pinned(hot_keys)
    n_keys, n_rows = hot_keys.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if n_keys == 0:
        return df
    # How many there are follows the data; whether to broadcast them is left to AQE.
    hot_keys = hot_keys.select(*keys)
    # Sampled range bounds over the whole sort key follow the data, so a burst in
    # time is cut as well. The segment numbers are pinned: a lost executor cannot
    # bring back other borders.
    hot = (
        df.join(hot_keys, list(keys), "left_semi")
        .repartitionByRange(math.ceil(n_rows / max_rows) + n_keys, *keys, *order)
        .withColumn(SEG, F.spark_partition_id())
    )
    cold = df.join(hot_keys, list(keys), "left_anti").withColumn(SEG, F.lit(UNSPLIT))
    return _padded(cold, pinned(hot), keys, order, before, after)


def pad(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int = 0, after: int = 0
) -> DataFrame:
    """Give the segments of a frame that is split already copies of their neighbours.

    A frame that is not split, or has its copies, stays as it is.
    """
    if SEG not in df.columns or COPY in df.columns:
        return df
    split = pinned(df.filter(F.col(SEG) != UNSPLIT))
    return _padded(df.filter(F.col(SEG) == UNSPLIT), split, keys, order, before, after)


def _padded(
    whole: DataFrame,
    split: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    before: int,
    after: int,
) -> DataFrame:
    rows = whole.unionByName(split)
    if not before and not after:
        return rows
    rows = rows.withColumn(COPY, F.lit(False))
    if before:
        rows = rows.unionByName(_neighbours(split, keys, order, before, ahead=False))
    if after:
        rows = rows.unionByName(_neighbours(split, keys, order, after, ahead=True))
    return rows


def _neighbours(
    split: DataFrame, keys: Sequence[str], order: Sequence[str], k: int, ahead: bool
) -> DataFrame:
    """For each segment, copies of the ``k`` rows that come before (or after) it.

    Only the last ``k`` rows of each segment can be among them, so the per-key
    window runs over those alone.
    """
    rising = [F.col(c).asc() for c in order]
    falling = [F.col(c).desc() for c in order]
    onward, backward = (falling, rising) if ahead else (rising, falling)
    per_segment = Window.partitionBy(*keys, SEG).orderBy(*backward)
    edge = (
        split.withColumn("_r", F.row_number().over(per_segment))
        .filter(F.col("_r") <= k)
        .drop("_r")
    )
    per_key = Window.partitionBy(*keys).orderBy(*onward)
    enters = ~F.lag(SEG).over(per_key).eqNullSafe(F.col(SEG))
    passed = F.collect_list(F.struct(*split.columns)).over(per_key.rowsBetween(-k, -1))
    return (
        edge.select(F.col(SEG).alias("_into"), enters.alias("_enters"), passed.alias("_passed"))
        .filter("_enters")
        .select("_into", F.inline("_passed"))
        .withColumn(SEG, F.col("_into"))
        .drop("_into")
        .withColumn(COPY, F.lit(True))
    )


def partition_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """``keys``, and the segment where the frame is split."""
    return [*keys, SEG] if SEG in df.columns else list(keys)


def own(df: DataFrame) -> DataFrame:
    """The rows themselves, without the copies that padded the segments."""
    return df.filter(~F.col(COPY)).drop(COPY) if COPY in df.columns else df


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    layout: Sequence[str] = (),
) -> DataFrame:
    """Add the bigint sum of ``value`` from the first row of a key to this row.

    Copies may only be of rows before a segment. ``layout`` names some of the keys to
    partition the rows by, for windows to come.
    """
    rows = df.withColumn("_value", value.cast(T.LongType()))
    first = []
    if SEG in df.columns:
        # Each segment starts with a row that carries the total so far.
        rows = rows.withColumn("_start", F.lit(False))
        rows = rows.unionByName(_starts(rows, keys), allowMissingColumns=True)
        first = [F.desc("_start")]
    by = partition_keys(df, keys)
    if layout:
        rows = rows.repartition(*partition_keys(df, layout))
    along = Window.partitionBy(*by).orderBy(*first, *order)
    total = F.sum("_value").over(along.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn(name, total).drop("_value")
    return rows.filter(~F.col("_start")).drop("_start") if first else rows


def _starts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per segment, what its first row (or copy) has before it."""
    copied = F.col(COPY) if COPY in rows.columns else F.lit(False)
    sums = (
        rows.filter(F.col(SEG) != UNSPLIT)
        .groupBy(*keys, SEG)
        .agg(
            F.sum(F.when(~copied, F.col("_value"))).alias("_own"),
            F.sum(F.when(copied, F.col("_value"))).alias("_copied"),
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_own").over(earlier), F.lit(0)) - F.coalesce("_copied", F.lit(0))
    return sums.select(*keys, SEG, start.alias("_value"), F.lit(True).alias("_start"))
