"""The ledger: batches, compaction under readers and writers, repeats, a whole live system."""

import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.functions.payload import decode, encode
from kinelane.operators import snapshot
from kinelane.plans import carried, day_chain
from kinelane.plans import refresh as plan
from kinelane.schema import FIELDS, READING, Params
from kinelane.sources import results
from kinelane.sources.events import load_events, plain, readings
from kinelane.sources.history import append_history, read_history
from kinelane.streaming import ingest, ledger
from kinelane.streaming.refresh import refresh, refresh_ledger

ONCE = {"availableNow": True}
AS_OF = 1.7e9


@pytest.fixture(scope="module")
def sent(spark):
    df = plain(readings(load_events(spark, "/root/testdata/sf0.001"))).cache()
    yield df
    df.unpersist()


def send(rows_, folder):
    ingest.publish(rows_.coalesce(1), "text", {"path": folder})


def run(spark, inbox, out, checkpoint, **options):
    payloads = ingest.file_payloads(spark, inbox, max_files=1)
    ledger.start_ingest(payloads, out, checkpoint, ONCE, **options).awaitTermination(180)


def digest_rows(spark, out, sets=None):
    return rows(ledger.day_digests(spark, out, sets), "day", "n", "digest")


def test_compaction_under_readers_and_writers(spark, sent, tmp_path):
    """Streaming equals batch across compactions, each row once; digests never need files."""
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in range(5):
        send(sent.filter(F.pmod("_id", F.lit(9)) == part), inbox)
    run(spark, inbox, out, state)
    held = ledger.live_sets(spark, out)
    assert [s.name for s in held] == [f"batches={i}-{i}" for i in range(5)]
    before, first_five = digest_rows(spark, out), ledger.read_history(spark, out, held)
    n = first_five.count()

    assert ledger.compact(spark, out, fan=2) == 3
    assert [(s.first, s.last) for s in ledger.live_sets(spark, out)] == [(0, 3), (4, 4)]
    assert digest_rows(spark, out) == before
    for part in range(5, 9):
        send(sent.filter(F.pmod("_id", F.lit(9)) == part), inbox)
    run(spark, inbox, out, state)
    ledger.compact(spark, out, fan=2)
    assert [(s.first, s.last) for s in ledger.live_sets(spark, out)] == [(0, 7), (8, 8)]
    # A reader that holds the old sets still has them, until they are pruned.
    assert first_five.count() == n
    assert ledger.prune(spark, out, keep_seconds=3600) == 0 and first_five.count() == n
    assert ledger.prune(spark, out, keep_seconds=0) > 0
    assert [(s.first, s.last) for s in ledger.live_sets(spark, out)] == [(0, 7), (8, 8)]

    stored = ledger.read_history(spark, out)
    assert rows(stored, *FIELDS) == rows(sent, *FIELDS)
    assert digest_rows(spark, out) == rows(day_chain.digests(stored), "day", "n", "digest")


def test_a_batch_counts_once_and_only_whole(spark, tmp_path):
    out = str(tmp_path)
    lines = encode(frame(spark, track("A", [0, 5, 9]))).union(
        spark.createDataFrame([("rubbish",)], "value string")
    )
    batch = decode(lines.withColumn("_id", F.monotonically_increasing_id()), keep=("_id",))
    assert ledger.append(batch, out, 0) and not ledger.append(batch, out, 0)
    assert ledger.append(batch, out, 1)
    ledger.compact(spark, out, fan=2)
    # It comes again after a merge and after a prune.
    assert not ledger.append(batch, out, 1)
    ledger.prune(spark, out, 0)
    assert not ledger.append(batch, out, 0)
    assert ledger.read_history(spark, out).count() == 6
    assert rows(ledger.read_quarantine(spark, out), "payload", "reason") == [("rubbish", "short")] * 2
    # Files without an entry, and an entry that was not finished.
    (tmp_path / "sets" / "batches=2-2").mkdir()
    (tmp_path / "ledger" / "batches=0-2").mkdir()
    assert [s.name for s in ledger.live_sets(spark, out)] == ["batches=0-1"]


def test_an_empty_batch_and_an_empty_ledger(spark, tmp_path):
    out = str(tmp_path)
    assert ledger.read_history(spark, out).isEmpty() and ledger.compact(spark, out) == 0
    assert ledger.append_readings(frame(spark, []), out, 0)
    assert ledger.read_history(spark, out).isEmpty() and digest_rows(spark, out) == []


def test_a_merge_that_lost_rows_does_not_count(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    for batch in range(2):
        ledger.append_readings(frame(spark, track("A", [batch, 5, 9], start=100.0 * batch)), out, batch)
    whole = ledger._rows
    monkeypatch.setattr(ledger, "_rows", lambda *a: whole(*a).filter("x <> 5"))
    with pytest.raises(RuntimeError):
        ledger.compact(spark, out, fan=2)
    monkeypatch.undo()
    assert [s.name for s in ledger.live_sets(spark, out)] == ["batches=0-0", "batches=1-1"]
    assert ledger.compact(spark, out, fan=2) == 1 and ledger.read_history(spark, out).count() == 6


def test_repeats_in_one_and_in_several_batches(spark, tmp_path):
    """Sent again in the same file, in the next batch, and after a restart."""
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one, two = (frame(spark, track(p, [0, 5, 9, 30])) for p in "AB")
    bad = spark.createDataFrame([("rubbish",), ("rubbish",)], "value string").coalesce(1)
    send(one.union(one).union(two.limit(1)), inbox)
    send(one.union(two), inbox)
    bad.write.mode("append").text(inbox)
    run(spark, inbox, out, state, repeats_within="1 hour")
    assert rows(ledger.read_history(spark, out), *FIELDS) == rows(one.union(two), *FIELDS)
    late = frame(spark, track("A", [7], start=0.5))
    send(two.union(late), inbox)
    run(spark, inbox, out, state, repeats_within="1 hour")
    assert rows(ledger.read_history(spark, out), *FIELDS) == rows(one.union(two).union(late), *FIELDS)
    assert ledger.read_quarantine(spark, out).count() == 2


def test_repeats_into_a_plain_folder(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    one = frame(spark, track("A", [0, 5, 9, 30]))
    send(one.union(one), inbox)
    payloads = ingest.file_payloads(spark, inbox)
    ingest.start_ingest(payloads, out, state, ONCE, repeats_within="1 hour").awaitTermination(120)
    assert rows(ingest.read_ingested(spark, out), *FIELDS) == rows(one, *FIELDS)


def test_refreshes_of_a_ledger(spark, sent, tmp_path):
    """Three passes with a compaction between, each as a pass over a plain history."""
    out, base, other = (str(tmp_path / n) for n in ("out", "ledger", "plain"))
    part = F.pmod("_id", F.lit(3))
    for batch in range(3):
        ledger.append_readings(sent.filter(part == batch), out, batch)
        if batch == 1:
            ledger.compact(spark, out, fan=2)
        path = str(tmp_path / f"history{batch}")
        append_history(sent.filter(part <= batch), path)
        refresh_ledger(spark, out, base, as_of=AS_OF)
        refresh(
            spark, lambda s, p=path: read_history(s, p), other, as_of=AS_OF,
            historical=plan.whole_history,
        )
        for name in (*plan.LIVE, *plan.PAST):
            got, wanted = (results.read_result(spark, b, name) for b in (base, other))
            columns = wanted.columns
            assert rows(got, *columns) == rows(wanted, *columns), (batch, name)
        sizes = [
            rows(results.run_log(spark, b), "run_id", "cut", "next_cut", "history_rows", "recent_rows", "batch_rows")
            for b in (base, other)
        ]
        assert sizes[0] == sizes[1]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 1  # the readings sent


def test_carried_readings_over_many_ticks(spark, sent, tmp_path):
    """Late and early readings, at each tick the newest three as from all readings so far."""
    before, base = None, str(tmp_path)
    so_far = sent.limit(0)
    for tick in range(4):
        new = sent.filter(F.pmod("_id", F.lit(4)) == (tick * 3) % 4)
        so_far = so_far.union(new)
        newest = so_far.agg(F.max("time")).first()[0]
        before = carried.advance(spark, base, new, tick, before, Params(), newest)
        for cut in (newest - 60, newest - 20, newest):
            got, wanted = (snapshot.snapshot(df, cut) for df in (before.rows, so_far))
            assert rows(got, "plate", "_id", "row") == rows(wanted, "plate", "_id", "row")
    assert carried.load(spark, base).mark == 3
    assert before.rows.count() < sent.count()


def test_rows_after_a_mark(spark, tmp_path):
    out = str(tmp_path)
    for batch in range(4):
        ledger.append_readings(frame(spark, track(f"P{batch}", [0, 1])), out, batch)
    ledger.compact(spark, out, fan=4)
    sets = ledger.live_sets(spark, out)
    after = ledger.rows_after(spark, out, 1, sets)
    assert {r.plate for r in after.collect()} == {"P2", "P3"}
    ledger.prune(spark, out, 0)
    assert ledger.rows_after(spark, out, 1, sets) is None
    assert ledger.rows_after(spark, out, 3, sets).isEmpty()
    assert READING.fieldNames() == [c for c in after.columns if c != "event_date"]
