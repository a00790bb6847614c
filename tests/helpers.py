from pyspark.sql import DataFrame, SparkSession

from kinelane.schema import READING

BASE = dict(
    road="r", road_speed=100, road_size=1000, x=0, y=0, plate="AA000", time=0.0, direction=1
)


def frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Readings from partial rows; ids follow the order given."""
    filled = [{"_id": i, **BASE, **row} for i, row in enumerate(rows)]
    names = READING.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in filled], READING)


def track(plate: str, xs: list[int], every: float = 1.0, start: float = 0.0, **fields):
    """One vehicle's readings at a steady pace."""
    return [
        dict(plate=plate, x=x, time=start + i * every, **fields) for i, x in enumerate(xs)
    ]


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    return sorted(tuple(r) for r in df.select(*columns).collect())
