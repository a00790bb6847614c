"""Wire payloads: eight comma-separated fields, newline at the end, UTF-8."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.schema import FIELDS, SENSOR

# What a reading may hold; lines beyond go to quarantine. Times are epoch seconds up to
# the year 9999, and the way between two places always fits an int.
MIN_TIME, MAX_TIME = 0.0, 253_402_300_799.0
MAX_PLACE = 1_000_000_000

#: What a decimal number never holds; Java also reads "1.5d", "NaN" or "0x1p3" as one.
NO_DECIMAL = "[^0-9eE.+ \t\n\x0b\f\r-]"


def wire_time(time: str) -> str:
    """Epoch seconds in plain decimal digits (a double prints as 1.68E9 in Spark), as SQL."""
    digits = f"cast(try_cast({time} as decimal(38,17)) as string)"
    bare = f"trim(trailing '0' from {digits})"
    return f"if(endswith({bare}, '.'), concat({bare}, '0'), {bare})"


def encode(df: DataFrame) -> DataFrame:
    """Readings -> payload lines in a ``value`` column."""
    # A missing value leaves its field empty, so that the others keep their places.
    parts = [
        f"coalesce({wire_time(c) if c == 'time' else f'cast({c} as string)'}, '')" for c in FIELDS
    ]
    return df.selectExpr(f"concat(concat_ws(',', {', '.join(parts)}), '\n') as value")


def decode(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Payload lines -> typed fields plus ``reason``, null where the line is good.

    Fields past the eighth are ignored. ``value`` may be text or bytes; bytes that are
    no UTF-8 are kept with replacement characters. Whatever a line holds, it gets a
    reason and raises nothing.
    """
    raw = f"cast(`{value}` as string)"
    parts = [f"'{f.name}', try_cast(get(_parts, {i}) as {f.dataType.simpleString()})"
             for i, f in enumerate(SENSOR.fields)]
    number = f"not rlike(get(_parts, {FIELDS.index('time')}), '{NO_DECIMAL}')"
    fields = f"named_struct({', '.join(parts)}, '_size', size(_parts), '_number', {number})"
    missing = " or ".join(f"{c} is null" for c in FIELDS)
    possible = (
        f"time between {MIN_TIME!r}D and {MAX_TIME!r}D and x between -{MAX_PLACE} and {MAX_PLACE} "
        "and road_size >= 0 and road_speed >= 0 and direction in (1, -1) "
        "and trim(road) != '' and trim(plate) != ''"
    )
    reason = (
        "case when not _valid then 'bad_text' when trim(payload) = '' then 'blank' "
        f"when _size < {len(FIELDS)} then 'short' when {missing} or not _number then 'bad_field' "
        f"when not ({possible}) then 'out_of_range' end as reason"
    )
    bare = (
        "case when endswith(_text, '\r\n') then left(_text, length(_text) - 2) "
        "when endswith(_text, '\n') then left(_text, length(_text) - 1) else _text end as payload"
    )
    # A filter on the reason cannot move below the generator, where it would parse
    # each line once per field.
    return (
        df.selectExpr(*keep, f"is_valid_utf8({raw}) as _valid", f"make_valid_utf8({raw}) as _text")
        .selectExpr(*keep, "_valid", bare)
        .selectExpr(*keep, "_valid", "payload", "split(payload, ',', -1) as _parts")
        .selectExpr(*keep, "_valid", "payload", f"inline(array({fields}))")
        .selectExpr(*keep, *FIELDS, "payload", reason)
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNull()).drop("reason", "payload")


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reason").isNotNull()).select("payload", "reason")


def impose_types(df: DataFrame) -> DataFrame:
    """Impose the sensor types on loosely typed columns; bad text becomes null.

    Fixed-width text columns come blank padded, so text is trimmed on the right.
    """
    kinds = dict(df.dtypes)

    def typed(field):
        column = F.col(field.name)
        if kinds[field.name] == "string":
            column = F.rtrim(column)
        return column.try_cast(field.dataType).alias(field.name)

    extra = [c for c in df.columns if c not in FIELDS]
    return df.select(*extra, *[typed(f) for f in SENSOR.fields])
