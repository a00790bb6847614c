"""Result tables, one set per run, and the run log that makes a set visible.

Each run writes its tables to folders of their own. Appending the run to the log
is the last step and switches readers to all of its tables at once, so nobody
sees a half-written table and a failed run leaves no trace but its folders.
"""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelane.operators.cursor import Cursor, changes, start
from kinelane.sources import files

TIMES = T.StructType([
    T.StructField("analysis", T.StringType()),
    T.StructField("time", T.DoubleType()),
])

RUNS = T.StructType([
    T.StructField("run_id", T.LongType()),
    T.StructField("cut", T.DoubleType()),
    T.StructField("next_cut", T.DoubleType()),
    T.StructField("last_max", T.DoubleType()),
    T.StructField("history_rows", T.LongType()),
    T.StructField("recent_rows", T.LongType()),
    T.StructField("batch_rows", T.LongType()),
    T.StructField("committed", T.DoubleType()),
])

# Formats whose tables are folders; any other format names its place in its options.
FOLDERS = frozenset({"parquet", "orc", "json", "csv", "avro"})

# How long the tables of a run stay for slow readers, in seconds.
KEEP_SECONDS = 600.0


# Runs whose log entries share a folder, so that finding the newest lists few files.
RUNS_PER_BLOCK = 1000


def _folder(base: str, name: str, run_id: int) -> str:
    return f"{base}/{name}/run_id={run_id}"


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side values as a one-partition frame, without a Python worker."""

    def typed(row: tuple):
        fields = zip(row, schema.fields)
        return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in fields])

    return spark.range(1).select(F.inline(F.array(*[typed(row) for row in rows]))).coalesce(1)


def write_result(
    df: DataFrame,
    base: str,
    name: str,
    run_id: int,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> None:
    """Write one result table of a run; a retried run overwrites its own folder.

    A format that is no file format overwrites the whole collection its options name.
    """
    writer = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    if fmt in FOLDERS:
        writer.save(_folder(base, name, run_id))
    else:
        writer.option("collection", name).save()


def commit_run(
    spark: SparkSession,
    base: str,
    run_id: int,
    cut: float,
    cursor: Cursor,
    sizes: tuple[int, int, int],
) -> None:
    """Make the run the one readers see.

    ``cursor`` is where the next run starts; ``sizes`` are the rows of the history,
    of its recent part and of the snapshot.
    """
    row = (run_id, float(cut), float(cursor.cut), cursor.last_max, *sizes, clock.time())
    block = f"{base}/runs/block={run_id // RUNS_PER_BLOCK}"
    literal_rows(spark, [row], RUNS).write.mode("append").parquet(block)


def run_log(spark: SparkSession, base: str) -> DataFrame:
    """All committed runs; of a run committed twice the later commit counts."""
    return _log(spark, base, _blocks(spark, base))


def _blocks(spark: SparkSession, base: str) -> list[int]:
    entries = (name.partition("=") for name in files.names(spark, f"{base}/runs"))
    return sorted(int(number) for label, _, number in entries if label == "block")


def _log(spark: SparkSession, base: str, blocks: list[int]) -> DataFrame:
    if not blocks:
        return spark.createDataFrame([], RUNS)
    folders = [f"{base}/runs/block={block}" for block in blocks]
    entries = spark.read.schema(RUNS).parquet(*folders)
    latest = F.max_by(F.struct(*RUNS.fieldNames()), F.coalesce("committed", F.lit(0.0)))
    return entries.groupBy("run_id").agg(latest.alias("_run")).select("_run.*")


def next_run(spark: SparkSession, base: str) -> tuple[int, Cursor]:
    """Number and cut-off of the run that follows the newest committed one."""
    run = last_run(spark, base)
    return (0, start()) if run is None else (run.run_id + 1, Cursor(run.next_cut, run.last_max))


def last_run(spark: SparkSession, base: str):
    """The newest committed run as a row, or None."""
    # A run that failed while committing may leave the newest folder empty.
    for block in reversed(_blocks(spark, base)):
        row = _log(spark, base, [block]).orderBy(F.desc("run_id")).limit(1).first()
        if row is not None:
            return row
    return None


def read_result(
    spark: SparkSession,
    base: str,
    name: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A result table of the newest committed run, in the file format it was written in."""
    run = last_run(spark, base)
    if run is None:
        raise FileNotFoundError(f"no committed run under {base}")
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load(_folder(base, name, run.run_id))


def write_cut_changes(spark: SparkSession, base: str, path: str) -> None:
    """The changed cut-offs of the run log as CSV, oldest first, under ``times``."""
    changed = changes(run_log(spark, base)).orderBy("run_id").select(F.col("cut").alias("times"))
    changed.write.mode("overwrite").option("header", True).csv(path)


def prune_results(
    spark: SparkSession, base: str, names: list[str], keep_seconds: float = KEEP_SECONDS
) -> None:
    """Delete the tables of runs that were replaced this long ago; the log stays.

    A run is replaced when the next one is committed, so a reader has this long to
    finish with what it opened.
    """
    log = run_log(spark, base)
    # Runs are numbered in order: all before the newest that is old enough were replaced.
    old = log.filter(F.col("committed") <= clock.time() - keep_seconds)
    newest_old = old.agg(F.max("run_id")).first()[0]
    if newest_old is None:
        return
    for name in names:
        for entry in files.names(spark, f"{base}/{name}"):
            label, _, number = entry.partition("=")
            if label == "run_id" and int(number) < newest_old:
                files.remove(spark, f"{base}/{name}/{entry}")
