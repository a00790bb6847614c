"""Shared intermediates and concurrent actions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a shared intermediate for the block, and let go of it afterwards.

    Lost blocks are recomputed from lineage.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def together(spark: SparkSession, actions: list[Callable[[], None]]) -> None:
    """Run independent actions as concurrent jobs; the first error is raised."""
    with ThreadPoolExecutor(max(1, len(actions))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
        for done in running:
            done.result()
