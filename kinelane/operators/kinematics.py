"""Speed and acceleration of every reading, from the readings before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinelane.operators.ordered import own, partition_keys, running_total
from kinelane.schema import FIELDS, IN_TIME, VEHICLE

# Rows back that speed and acceleration need. What follows looks back over the rows
# that are left, however many were dropped between them, and pads them again.
LOOKS_BACK = 2


def with_kinematics(df: DataFrame, per_second: bool = False) -> DataFrame:
    """Add ``speed`` (unsigned change of x) and ``acc`` (change of speed).

    Both are per reading by default; ``per_second`` divides by the time between
    readings. Rows with a null in any sensor column, speed or acc are dropped, so
    the first two readings of a plate go. A split frame loses its copies.
    """
    along = Window.partitionBy(*partition_keys(df, VEHICLE)).orderBy(*IN_TIME)
    columns = ["x", "time"] if per_second else ["x"]
    # All lags share one window, hence one exchange and one sort.
    back = {f"_{c}{n}": F.lag(c, n).over(along) for c in columns for n in (1, 2)}
    rows = df.withColumns(back)

    def moved(to: str, since: str) -> Column:
        """The way between two places; null if it is no int, so that no row stops a run."""
        return F.abs(F.col(to).cast("bigint") - F.col(since)).try_cast("int")

    speed, speed_before = moved("x", "_x1"), moved("_x1", "_x2")
    if per_second:
        speed = F.try_divide(speed, F.col("time") - F.col("_time1"))
        speed_before = F.try_divide(speed_before, F.col("_time1") - F.col("_time2"))
    moving = rows.withColumns({"speed": speed, "acc": speed - speed_before}).drop(*back)
    return own(moving).dropna(subset=[*FIELDS, "speed", "acc"])


def numbered(df: DataFrame) -> DataFrame:
    """Number the readings of each plate in ``row``, oldest first."""
    counted = own(running_total(df, VEHICLE, IN_TIME, F.lit(1), "row"))
    return counted.withColumn("row", F.col("row").cast("int"))
