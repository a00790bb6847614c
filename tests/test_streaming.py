import time

from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.functions.payload import encode
from kinelane.operators.cursor import Cursor
from kinelane.plans import refresh as plan
from kinelane.schema import FIELDS
from kinelane.sources import results
from kinelane.sources.events import load_events, plain, readings
from kinelane.sources.history import append_history, read_history
from kinelane.streaming import ingest
from kinelane.streaming.refresh import refresh, start_refresh

ONCE = {"availableNow": True}
BAD = ["", "road1,120", "road1,120,50000,5,0,AA001,later,1"]


def drop_bad(spark, folder):
    spark.createDataFrame([(x,) for x in BAD], "value string").coalesce(1).write.mode(
        "append"
    ).text(folder)


def run(spark, inbox, out, checkpoint):
    payloads = ingest.file_payloads(spark, inbox, max_files=2)
    ingest.start_ingest(payloads, out, checkpoint, ONCE).awaitTermination(120)


def test_stream_equals_batch(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    sent = plain(readings(load_events(spark, "/root/testdata/sf0.001")))
    early, late = sent.filter("_id % 3 <> 0"), sent.filter("_id % 3 = 0")
    ingest.publish(late.repartition(3), "text", {"path": inbox})
    run(spark, inbox, out, state)
    assert ingest.read_ingested(spark, out).count() == late.count()
    ingest.publish(early.repartition(3), "text", {"path": inbox})
    drop_bad(spark, inbox)
    run(spark, inbox, out, state)
    run(spark, inbox, out, state)
    stored = ingest.read_ingested(spark, out)
    assert rows(stored, *FIELDS) == rows(sent, *FIELDS)
    assert stored.select("_id").distinct().count() == sent.count()
    bad = ingest.read_quarantine(spark, out)
    assert rows(bad, "payload", "reason") == sorted(zip(BAD, ("blank", "short", "bad_field")))

    one, other = str(tmp_path / "one"), str(tmp_path / "other")
    append_history(sent, str(tmp_path / "batch"))
    refresh(spark, lambda s: ingest.read_ingested(s, out), one, as_of=1.7e9)
    batch = str(tmp_path / "batch")
    refresh(
        spark, lambda s: read_history(s, batch), other, as_of=1.7e9, historical=plan.whole_history
    )
    for name in (*plan.LIVE, *plan.PAST):
        columns = results.read_result(spark, one, name).columns
        assert rows(results.read_result(spark, one, name), *columns) == rows(
            results.read_result(spark, other, name), *columns
        ), name


def test_no_line_stops_ingestion(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    fields = dict(zip(FIELDS, ["road1", "120", "50000", "5", "0", "AA001", "1000.5", "1"]))
    odd = [("time", "1685000000000000"), ("time", "1e400"), ("time", "-1"), ("x", "2147483647"),
           ("direction", "7"), ("plate", ""), ("road", " "), ("road_speed", "-5")]
    lines = [",".join((fields | {name: value}).values()).encode() for name, value in odd]
    lines.append(b"road1,120,50000,5,0,AA\xff01,1000.5,1")
    good = ",".join(fields.values()).encode()
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"\n".join([*lines, good, good]) + b"\n")
    run(spark, inbox, out, state)
    (tmp_path / "in" / "b.txt").write_bytes(good + b"\n")
    run(spark, inbox, out, state)
    bad = ingest.read_quarantine(spark, out)
    assert sorted(r.reason for r in bad.collect()) == ["bad_text"] + ["out_of_range"] * len(odd)
    kept = ingest.read_ingested(spark, out)
    # Equal lines are readings of their own.
    assert kept.count() == 3 and kept.select("_id").distinct().count() == 3


def test_ingested_days_are_pruned(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ingest.publish(frame(spark, track("A", [1, 2, 3], every=86400.0)), "text", {"path": inbox})
    run(spark, inbox, out, state)
    stored = ingest.read_ingested(spark, out).filter(F.col("event_date") >= "1970-01-02")
    assert "PartitionFilters: [isnotnull(accepted" in stored._jdf.queryExecution().toString()
    assert rows(stored, "x") == [(2,), (3,)]


def test_batches_go_to_both_sinks(spark, tmp_path):
    inbox = str(tmp_path / "in")
    ingest.publish(frame(spark, track("A", [1, 2, 3])), "text", {"path": inbox})
    drop_bad(spark, inbox)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    ingest.start_batches(
        ingest.file_payloads(spark, inbox),
        lambda df: append_history(df, good),
        lambda df: df.write.mode("append").parquet(bad),
        str(tmp_path / "state"),
        ONCE,
    ).awaitTermination(120)
    assert rows(read_history(spark, good), "x") == [(1,), (2,), (3,)]
    assert spark.read.parquet(bad).count() == len(BAD)


def test_published_lines_are_payloads(spark, tmp_path):
    sent = frame(spark, track("A", [1, 2, 3]))
    ingest.publish(sent, "text", {"path": str(tmp_path / "in")})
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "in")).collect())
    assert lines == sorted(r.value.rstrip("\n") for r in encode(sent).collect())


def test_refresh_runs_without_new_data(spark, tmp_path):
    """The live counts of the loop fall to zero on the second idle pass."""
    path, base = str(tmp_path / "history"), str(tmp_path / "results")
    append_history(frame(spark, track("A", [0, 1, 2], start=1000.0)), path)
    query = start_refresh(
        spark, lambda s: read_history(s, path), base, str(tmp_path / "state")
    )
    try:
        deadline = time.monotonic() + 120
        while time.monotonic() < deadline:
            last = results.last_run(spark, base)
            if last is not None and last.run_id >= 2:
                break
            time.sleep(0.5)
    finally:
        query.stop()
    cuts = [r.cut for r in results.run_log(spark, base).orderBy("run_id").limit(3).collect()]
    assert cuts == [-60.0, 942.0, 1002.0]
    assert results.next_run(spark, base)[1] == Cursor(1002.0, 1002.0)
    assert results.read_result(spark, base, "analysis2").first()[0] == 0
