import pytest
from pyspark.sql import functions as F

from helpers import frame, rows, track
from kinelane.functions.payload import accepted, decode, encode, impose_types, rejected
from kinelane.schema import FIELDS
from kinelane.sources.events import mirrored

GOOD = "r,100,1000,5,1,AB123,1685000000.25,-1"
FIELD_VALUES = ("r", 100, 1000, 5, 1, "AB123", 1685000000.25, -1)


def decoded(spark, *lines):
    return decode(spark.createDataFrame([(x,) for x in lines], "value string"))


@pytest.mark.parametrize("line", [GOOD, GOOD + "\n", GOOD + "\r\n", GOOD + ",extra\n"])
def test_good_lines(spark, line):
    assert [tuple(r) for r in accepted(decoded(spark, line)).collect()] == [FIELD_VALUES]


def test_bytes(spark):
    line = spark.createDataFrame([(GOOD.replace("r,", "é,", 1).encode() + b"\n",)], "value binary")
    assert accepted(decode(line)).first().road == "é"


@pytest.mark.parametrize("line, reason", [
    ("", "blank"),
    ("\n", "blank"),
    ("r,100,1000\n", "short"),
    (GOOD.replace("1000", "wide"), "bad_field"),
    (GOOD.replace("1000", "1.5"), "bad_field"),
    (GOOD.replace("1000", "99999999999"), "bad_field"),
    (GOOD.replace("1685000000.25", "nan"), "bad_field"),
    (GOOD.replace("1685000000.25", "1685000000.25d"), "bad_field"),
    (GOOD.replace("1685000000.25", ""), "bad_field"),
])
def test_bad_lines(spark, line, reason):
    lines = decoded(spark, line)
    assert accepted(lines).isEmpty()
    assert rejected(lines).collect() == [(line.rstrip("\n"), reason)]


def test_lines_are_plain_text(spark):
    sent = frame(spark, [dict(time=1685000000.0), dict(time=1685000123.456), dict(time=0.5)])
    lines = [r.value for r in encode(sent).collect()]
    assert [line.split(",")[6] for line in lines] == ["1685000000.0", "1685000123.456", "0.5"]
    assert all(line.endswith(",1\n") for line in lines)


def test_round_trip(spark):
    sent = frame(spark, track("A", [1, 2, 3], every=0.123457, start=1685000000.1))
    assert rows(accepted(decode(encode(sent))), *FIELDS) == rows(sent, *FIELDS)


def test_impose_types_trims_and_nulls(spark):
    loose = spark.createDataFrame(
        [("r   ", 100, "x", 5, 1, "AB123 ", "1685000000.25   ", "-1 ")],
        "road string, road_speed int, road_size string, x int, y int, plate string, "
        "time string, direction string",
    )
    assert tuple(impose_types(loose).first()) == (
        "r", 100, None, 5, 1, "AB123", 1685000000.25, -1,
    )


def test_mirroring(spark):
    df = frame(spark, [dict(x=100, y=1), dict(x=100, y=1, direction=-1)])
    placed = df.select("direction", *mirrored(F.col("x"), F.col("y"), F.lit(3)))
    assert rows(placed, "direction", "x", "y") == [(-1, 900, 4), (1, 100, 1)]
