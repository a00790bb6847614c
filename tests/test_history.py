import datetime

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.schema import FIELDS, create_history_table
from kinelane.sources import history

DAY = 86400.0


@pytest.fixture
def sent(spark):
    return frame(spark, track("A", [1, 2, 3], start=DAY - 1) + track("B", [4], start=5 * DAY))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_append_and_read(spark, sent, tmp_path, fmt):
    path = str(tmp_path / "history")
    history.append_history(sent.limit(2), path, fmt)
    history.append_history(sent.exceptAll(sent.limit(2)), path, fmt)
    back = history.read_history(spark, path, fmt)
    assert rows(back, "_id", *FIELDS) == rows(sent, "_id", *FIELDS)
    days = {r.event_date for r in back.select("event_date").collect()}
    assert days == {datetime.date(1970, 1, d) for d in (1, 2, 6)}


def test_since_prunes_days_and_pushes_the_time(spark, sent, tmp_path):
    path = str(tmp_path / "history")
    history.append_history(sent, path)
    late = history.since(history.read_history(spark, path), DAY)
    assert rows(late, "time") == [(DAY + 1,), (5 * DAY,)]
    plan = late._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "GreaterThan(time,86400.0)" in plan


def test_compacted_history_is_the_same(spark, sent, tmp_path):
    history.compact_history(sent, str(tmp_path / "packed"), files=4)
    packed = history.read_history(spark, str(tmp_path / "packed"))
    assert rows(packed, "_id", *FIELDS) == rows(sent, "_id", *FIELDS)


def test_declared_table_reads_appended_days(spark, sent, tmp_path):
    create_history_table(spark, "sensor_data", str(tmp_path / "table"))
    create_history_table(spark, "sensor_data", str(tmp_path / "table"))
    history.append_history(sent, str(tmp_path / "table"))
    spark.catalog.recoverPartitions("sensor_data")
    assert rows(spark.table("sensor_data"), *FIELDS) == rows(sent, *FIELDS)
    spark.sql("DROP TABLE sensor_data")


def test_foreign_store_is_typed(spark, sent, tmp_path):
    """A store with text columns, no numeric id, and an incomplete document, which stays."""
    path = str(tmp_path / "documents")
    texts = sent.select(*[F.col(c).cast("string").alias(c) for c in FIELDS])
    broken = texts.limit(1).withColumn("x", F.lit("?"))
    texts.unionByName(broken).write.parquet(path)
    read = history.read_history(spark, None, "parquet", {"path": path})
    assert rows(read.filter("x is not null"), *FIELDS) == rows(sent, *FIELDS)
    assert read.filter("x is null").count() == 1
    assert dict(read.dtypes)["_id"] == "bigint"


def test_documents_keep_their_own_ids(spark, tmp_path):
    """Documents that differ only in the store's id stay apart, over two reads."""
    path = str(tmp_path / "documents")
    fields = ["road1", "120", "50000", "5", "0", "AA001", "1000.5", "1"]
    lines = [(f"5f{i:02d}", *fields) for i in range(4)]
    spark.createDataFrame(lines, ["_id", *FIELDS]).write.json(path)
    one, two = (history.read_history(spark, None, "json", {"path": path}) for _ in range(2))
    assert one.select("_id").distinct().count() == 4
    assert rows(one, "_id") == rows(two, "_id")


def test_jdbc_options_slice_the_scan():
    options = history.jdbc_options("jdbc:x", "readings", 0, 100, 8, "x", {"user": "me"})
    assert options["partitionColumn"] == "x" and options["numPartitions"] == "8"
    assert options["lowerBound"] == "0" and options["upperBound"] == "100"
    assert options["user"] == "me"
