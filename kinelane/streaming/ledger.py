"""A history of file sets: batches as they come in, merged ones later, switched at once.

Each micro-batch is a set of files of its own, named after the batch. Its entry in the
ledger holds the row count and digest of each day and is written last, so a set counts
whole or not at all, and a batch that comes again after a failure is left as it is.

Compaction merges sets that follow each other into one that covers the same batches. When
its entry is there, readers take it instead of the sets it covers; those stay for slow
readers and are pruned later. Sets are merged ``FAN`` at a time, so each row is rewritten
a logarithmic number of times. One stream writes to a ledger, one process compacts it,
any number reads.
"""

from __future__ import annotations

import math
import re
import time as clock
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinelane.functions.payload import decode
from kinelane.plans.day_chain import added_up, digests
from kinelane.schema import READING, with_event_date
from kinelane.sources import files
from kinelane.sources.history import STORED
from kinelane.sources.results import KEEP_SECONDS
from kinelane.streaming.ingest import EVERY, INGESTED, without_repeats

#: Sets that are merged into one.
FAN = 8
#: Rows of a file of a merged set.
FILE_ROWS = 5_000_000

DIGESTS = "day int, n bigint, digest decimal(38,0)"
_NAME = re.compile(r"batches=(\d+)-(\d+)")


class FileSet(NamedTuple):
    """A set of files by the batches that it covers."""

    first: int
    last: int

    @property
    def name(self) -> str:
        return f"batches={self.first}-{self.last}"

    def tier(self, fan: int) -> int:
        """How often its rows have been merged, if it is always ``fan`` sets."""
        return round(math.log(self.last - self.first + 1, fan))


def _committed(spark: SparkSession, path: str) -> list[FileSet]:
    found = (_NAME.fullmatch(name) for name in files.names(spark, f"{path}/ledger"))
    named = [FileSet(int(m[1]), int(m[2])) for m in found if m]
    return [s for s in named if files.exists(spark, f"{path}/ledger/{s.name}/_SUCCESS")]


def _outermost(sets: list[FileSet]) -> list[FileSet]:
    live: list[FileSet] = []
    for entry in sorted(sets, key=lambda s: (s.first, -s.last)):
        if not live or entry.last > live[-1].last:
            live.append(entry)
    return live


def live_sets(spark: SparkSession, path: str) -> list[FileSet]:
    """The sets that make up the history now, in order; what a reader should hold on to."""
    return _outermost(_committed(spark, path))


def _rows(spark: SparkSession, path: str, sets: list[FileSet]) -> DataFrame:
    if not sets:
        return spark.createDataFrame([], INGESTED)
    # The sets are partitions of one table, of which those named are read.
    reader = spark.read.schema(INGESTED).option("basePath", f"{path}/sets")
    rows = reader.parquet(*[f"{path}/sets/{s.name}" for s in sets])
    return rows.select(*INGESTED.fieldNames())


def read_history(spark: SparkSession, path: str, sets: list[FileSet] | None = None) -> DataFrame:
    """The good readings of the live sets, or of those that the caller holds."""
    sets = live_sets(spark, path) if sets is None else sets
    return _rows(spark, path, sets).filter("accepted").select(*STORED.fieldNames())


def read_quarantine(spark: SparkSession, path: str, sets: list[FileSet] | None = None) -> DataFrame:
    sets = live_sets(spark, path) if sets is None else sets
    return _rows(spark, path, sets).filter("not accepted").select("_id", "payload", "reason")


def day_digests(spark: SparkSession, path: str, sets: list[FileSet] | None = None) -> DataFrame:
    """Rows and digest of each day, from the ledger alone."""
    sets = live_sets(spark, path) if sets is None else sets
    if not sets:
        return spark.createDataFrame([], DIGESTS)
    entries = [f"{path}/ledger/{s.name}" for s in sets]
    return added_up(spark.read.schema(DIGESTS).parquet(*entries))


def _put(rows: DataFrame, path: str, name: str, sums: DataFrame | None = None) -> None:
    """Write a set, then its entry; ``sums`` are its digests if they are known."""
    spark = rows.sparkSession
    folder = f"{path}/sets/{name}"
    rows.write.mode("overwrite").partitionBy("accepted", "event_date").parquet(folder)
    if sums is None:
        written = spark.read.schema(INGESTED).parquet(folder).filter("accepted")
        sums = digests(written)
    sums.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{name}")


def append(rows: DataFrame, path: str, batch: int) -> bool:
    """Add decoded payloads (readings with ``reason`` and ``payload``) as one batch.

    False if the ledger has that batch already, by itself or within a merged set.
    """
    one = FileSet(batch, batch)
    if any(s.first <= batch <= s.last for s in _committed(rows.sparkSession, path)):
        return False
    good = F.col("reason").isNull()
    stored = with_event_date(rows).withColumns({
        "accepted": good,
        "payload": F.when(~good, F.col("payload")),
        "event_date": F.when(good, F.col("event_date")),
    })
    _put(stored.select(*INGESTED.fieldNames()), path, one.name)
    return True


def append_readings(rows: DataFrame, path: str, batch: int) -> bool:
    """Add readings that did not come as payloads."""
    nothing = F.lit(None).cast(T.StringType())
    plain = rows.select(*READING.fieldNames(), nothing.alias("reason"), nothing.alias("payload"))
    return append(plain, path, batch)


def start_ingest(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping = EVERY,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Payload stream to the ledger, each batch exactly once.

    With ``repeats_within`` a reading that is sent again within that time is dropped.
    """
    rows = decode(payloads, keep=("_id",))
    if repeats_within is not None:
        rows = without_repeats(rows, repeats_within)

    def write(batch: DataFrame, number: int) -> None:
        append(batch, path, number)

    writer = rows.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _mergeable(sets: list[FileSet], fan: int) -> list[FileSet] | None:
    """The first ``fan`` sets of one tier that follow each other."""
    for at in range(len(sets) - fan + 1):
        group = sets[at : at + fan]
        if len({s.tier(fan) for s in group}) == 1:
            return group
    return None


def compact(spark: SparkSession, path: str, fan: int = FAN, file_rows: int = FILE_ROWS) -> int:
    """Merge sets while there are ``fan`` of one tier in a row; the number of merges.

    A merged set is sorted by day, vehicle and time, in files that are dealt by ranges of
    that order. Its entry adds up the entries of its parts; the rows written are held
    against it before it counts.
    """
    merges = 0
    while (group := _mergeable(live_sets(spark, path), fan)) is not None:
        _merge(spark, path, group, file_rows)
        merges += 1
    return merges


def _merge(spark: SparkSession, path: str, group: list[FileSet], file_rows: int) -> None:
    name = FileSet(group[0].first, group[-1].last).name
    # One row for each day.
    sums = day_digests(spark, path, group).collect()
    parts = max(1, math.ceil(sum(r.n for r in sums) / file_rows))
    keys = ["event_date", "plate", "time", "_id"]
    rows = _rows(spark, path, group).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    folder = f"{path}/sets/{name}"
    rows.write.mode("overwrite").partitionBy("accepted", "event_date").parquet(folder)
    written = spark.read.schema(INGESTED).parquet(folder).filter("accepted")
    found = {tuple(r) for r in digests(written).collect()}
    if found != {tuple(r) for r in sums}:
        raise RuntimeError(f"{folder} does not hold the rows of the sets it is made of")
    entry = spark.createDataFrame(sums, DIGESTS).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{path}/ledger/{name}")


def prune(spark: SparkSession, path: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Delete sets that a merged set replaced this long ago; the number deleted.

    Readers have this long to finish with the sets they hold. The entry goes first, so
    what is left of a set after a failure counts no more.
    """
    sets = _committed(spark, path)
    live = _outermost(sets)
    gone = 0
    for old in set(sets) - set(live):
        by = next(s for s in live if s.first <= old.first and old.last <= s.last)
        switched = files.modified(spark, f"{path}/ledger/{by.name}/_SUCCESS")
        if switched <= clock.time() - keep_seconds:
            files.remove(spark, f"{path}/ledger/{old.name}")
            files.remove(spark, f"{path}/sets/{old.name}")
            gone += 1
    return gone


def rows_after(
    spark: SparkSession, path: str, mark: int, sets: list[FileSet]
) -> DataFrame | None:
    """Good readings of the batches after ``mark`` up to the last of ``sets``.

    None if one of the sets mixes older batches with newer ones.
    """
    new = [s for s in sets if s.last > mark]
    if any(s.first <= mark for s in new):
        within = [s for s in _committed(spark, path) if s.first > mark and s.last <= sets[-1].last]
        new = _outermost(within)
        # The parts of the merged set may be pruned already.
        if sum(s.last - s.first + 1 for s in new) != sets[-1].last - mark:
            return None
    return read_history(spark, path, new)
