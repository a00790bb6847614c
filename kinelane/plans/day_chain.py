"""Historical analyses from a chain of days, of which only what changed is computed again.

Each closed day has tables of its own: sums per road, and per plate its last readings,
last speed and last lane (what the next readings of that plate need), its infractions,
its severe windows and the roads it was on as a bitmap. A day's input is its readings
and what came before of the plates on it, so

* a day whose rows changed (by a count and an order-free digest, see ``digests``) is
  replayed from the state before it,
* a later day is replayed only if a plate on it comes with another state than before, or
  if scores near the midnight before it changed; elsewhere the replay stops.

Tables of days merge: sums add up, the newest state of a plate wins, bitmaps are or-ed.
Aligned blocks of ``RADIX`` days, of ``RADIX`` blocks and so on are merged once, so a
refresh reads a logarithmic number of folders. Whatever a refresh writes lies in a folder
of its own; the entry that is written last makes it count.
"""

from __future__ import annotations

import datetime
import time as clock
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from decimal import Decimal
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelane.functions import rules
from kinelane.operators import history as past
from kinelane.operators.kinematics import LOOKS_BACK, with_kinematics
from kinelane.operators.ordered import SEGMENT_ROWS, pinned, split_hot_keys
from kinelane.plans.closed_days import AHEAD_DAYS, DAY
from kinelane.plans.shared import kept, together
from kinelane.schema import FIELDS, IN_TIME, READING, VEHICLE, Params, with_event_date
from kinelane.sources.files import exists, names, remove

#: Days, or blocks of the level below, that make a block.
RADIX = 4

#: A reading as it is carried on, ordered by time first.
CARRIED = T.StructType([READING["time"], *[f for f in READING.fields if f.name != "time"]])

#: Tables of a day; the first three also exist for blocks. ``seq`` is the first day.
PARTS = {
    "roads": "road string, n bigint, speeds bigint, sizes bigint, still bigint, seq int",
    "plates": (
        f"plate string, tails array<{CARRIED.simpleString()}>, last_speed int, last_lane int, "
        "infractions bigint, severe bigint, seq int"
    ),
    "road_bits": "plate string, bucket bigint, bits binary, seq int",
    "infraction_times": "plate string, time double",
    "late_scores": "plate string, _id bigint, time double, total int",
}
MERGED = ("roads", "plates", "road_bits")
ROAD_NUMBERS = "road string, number bigint"
ENTRY = "level int, first int, folder string, n bigint, digest decimal(38,0), settings string"

#: Digest of a day without rows.
NOTHING = (0, Decimal(0))


def digests(rows: DataFrame) -> DataFrame:
    """day, n, digest: how many rows a day has and the sum of their hashes.

    The sum does not depend on their order, and digests of parts of a day add up. One
    reading more, less or replaced by another changes it.
    """
    if "event_date" not in rows.columns:
        rows = with_event_date(rows)
    columns = [F.col(c) for c in READING.fieldNames()]
    one = F.xxhash64(*columns, *[c.isNull() for c in columns]).cast("decimal(20,0)")
    return added_up(
        rows.select(F.unix_date("event_date").alias("day"), F.lit(1).alias("n"), one.alias("digest"))
    )


def added_up(parts: DataFrame) -> DataFrame:
    """The digests of days from those of their parts; rows without a day are left out."""
    total = F.sum("digest").cast("decimal(38,0)").alias("digest")
    sums = parts.groupBy("day").agg(F.sum("n").cast("bigint").alias("n"), total)
    return sums.filter(F.col("day").isNotNull())


@dataclass(frozen=True)
class Day:
    folder: str
    key: tuple[int, Decimal]


@dataclass(frozen=True)
class Chain:
    """What is closed: days, and blocks by (level, first day), with their folders."""

    commit: int = -1
    settings: str = ""
    days: dict[int, Day] = field(default_factory=dict)
    blocks: dict[tuple[int, int], str] = field(default_factory=dict)

    @property
    def through(self) -> int | None:
        return max(self.days) if self.days else None

    def cover(self, first: int, last: int) -> list[tuple[int, int]]:
        """The fewest blocks and days (level 0) for the closed days of a range."""
        if not self.days:
            return []
        levels = sorted({level for level, _ in self.blocks}, reverse=True)
        out, low, last = [], max(first, min(self.days)), min(last, max(self.days))
        # Before the first closed day there is nothing, so a block may start there.
        at = low - low % RADIX ** levels[0] if levels and first <= min(self.days) else low
        while at <= last:
            level = next(
                (n for n in levels if (n, at) in self.blocks and at + RADIX**n - 1 <= last), 0
            )
            if level or at in self.days:
                out.append((level, at))
            at += RADIX**level
        return out


class _Tables:
    """The tables of a chain under its folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._listed: dict[str, set[str]] = {}

    def read(self, chain: Chain, part: str, cover: list[tuple[int, int]]) -> DataFrame:
        folders = []
        for level, first in cover:
            top = chain.blocks[level, first] if level else chain.days[first].folder
            root = f"{self.base}/{top}/{part}"
            if root not in self._listed:
                self._listed[root] = set(names(self.spark, root))
            # A day without such rows has no folder.
            if f"first={first}" in self._listed[root]:
                folders.append(f"{root}/first={first}")
        if not folders:
            return self.spark.createDataFrame([], PARTS[part])
        return self.spark.read.schema(PARTS[part]).parquet(*folders)

    def write(self, parts: dict[str, DataFrame], folder: str) -> None:
        def put(name: str) -> None:
            path = f"{self.base}/{folder}/{name}"
            parts[name].write.mode("overwrite").partitionBy("first").parquet(path)

        together(self.spark, [partial(put, name) for name in parts])


def load(spark: SparkSession, base: str) -> Chain:
    """The chain by its newest entry."""
    commits = (n.partition("=") for n in names(spark, f"{base}/entries"))
    numbers = sorted(int(number) for label, _, number in commits if label == "commit")
    for commit in reversed(numbers):
        path = f"{base}/entries/commit={commit}"
        if not exists(spark, f"{path}/_SUCCESS"):
            continue
        # One row for each day and block.
        rows = spark.read.schema(ENTRY).parquet(path).collect()
        days = {r["first"]: Day(r["folder"], (r["n"], r["digest"])) for r in rows if not r["level"]}
        blocks = {(r["level"], r["first"]): r["folder"] for r in rows if r["level"]}
        return Chain(commit, rows[0]["settings"] if rows else "", days, blocks)
    return Chain()


def _commit(spark: SparkSession, base: str, chain: Chain) -> None:
    rows = [(0, d, day.folder, *day.key, chain.settings) for d, day in chain.days.items()]
    rows += [(level, d, folder, None, None, chain.settings) for (level, d), folder in chain.blocks.items()]
    entry = spark.createDataFrame(rows, ENTRY).coalesce(1)
    entry.write.mode("overwrite").parquet(f"{base}/entries/commit={chain.commit}")


def _prune(spark: SparkSession, base: str, *chains: Chain) -> None:
    """Delete the folders that none of the chains uses."""
    used = {day.folder for c in chains for day in c.days.values()}
    used |= {folder for c in chains for folder in c.blocks.values()}
    for version in names(spark, base):
        if not version.startswith("v="):
            continue
        for entry in names(spark, f"{base}/{version}"):
            if f"{version}/{entry}" not in used:
                remove(spark, f"{base}/{version}/{entry}")
    newest = {f"commit={c.commit}" for c in chains}
    for entry in names(spark, f"{base}/entries"):
        if entry.startswith("commit=") and entry not in newest:
            remove(spark, f"{base}/entries/{entry}")


def _settings(params: Params) -> str:
    """What the tables of closed days depend on."""
    if params.min_infractions < 1:
        raise ValueError("plates without infractions are not kept for closed days")
    if not 0 <= params.score_window_seconds <= DAY:
        raise ValueError("a window of scores may span two days at most")
    return repr((
        params.band_start, params.band_end, params.harsh_acc,
        params.score_window_seconds, params.min_score,
    ))


def _date(day: int) -> Column:
    return F.lit(datetime.date(1970, 1, 1) + datetime.timedelta(days=day))


def _between(history: DataFrame, first: int, last: int) -> DataFrame:
    return history.filter(F.col("event_date").between(_date(first), _date(last)))


def _day_of(time: Column) -> Column:
    return F.floor(time / DAY).cast("int")


# --- roads as numbers ----------------------------------------------------------------


def _road_numbers(spark: SparkSession, base: str, rows: DataFrame) -> DataFrame:
    """Numbers from 1 for all roads, those of ``rows`` included; a road keeps its number."""
    path = f"{base}/road_numbers"
    known = (
        spark.read.schema(ROAD_NUMBERS).parquet(path)
        if exists(spark, f"{path}/_SUCCESS") else spark.createDataFrame([], ROAD_NUMBERS)
    )
    new = rows.select("road").dropna().distinct().join(known, "road", "left_anti")
    new = pinned(new.withColumn("_id", F.monotonically_increasing_id()))
    # Dense numbers from the sizes of the tasks' shares, not from one sorted task.
    shares = new.groupBy(F.shiftright("_id", 33).alias("_share")).agg(F.count(F.lit(1)).alias("_n"))
    if shares.isEmpty():
        return known
    before = F.sum("_n").over(Window.orderBy("_share")) - F.col("_n")
    starts = shares.select("_share", before.alias("_before"))
    taken = known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("_taken"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        new.withColumn("_share", F.shiftright("_id", 33)).join(starts, "_share")
        .join(F.broadcast(taken))  # one row
        .select("road", (F.col("_taken") + F.col("_before") + place + 1).alias("number"))
    )
    pinned(numbered).write.mode("append").parquet(path)
    return spark.read.schema(ROAD_NUMBERS).parquet(path)


def road_bits(rows: DataFrame, numbers: DataFrame, *by: str) -> DataFrame:
    """plate, bucket, bits: the roads of each plate; one without a road has an empty bitmap."""
    line = rows.select(*by, "plate", "road").distinct().join(numbers, "road", "left")
    number = F.col("number")
    bucket = F.coalesce(F.bitmap_bucket_number(number), F.lit(1).cast("bigint"))
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number))
    return line.groupBy(*by, "plate", bucket.alias("bucket")).agg(bits.alias("bits"))


def merged_road_bits(bits: DataFrame, *by: str) -> DataFrame:
    return bits.groupBy(*by, "plate", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def top_vehicles(bits: DataFrame, params: Params = Params()) -> DataFrame:
    """The plates seen on the most roads, exact from bitmaps of any days or blocks."""
    counts = merged_road_bits(bits).groupBy("plate").agg(
        F.sum(F.bitmap_count("bits")).cast("bigint").alias("road_count")
    )
    return counts.orderBy(F.desc("road_count"), "plate").limit(params.top_vehicles)


# --- merging ---------------------------------------------------------------------------


def _newest_tails(tails: Column) -> Column:
    return F.slice(F.sort_array(F.flatten(F.collect_list(tails)), asc=False), 1, LOOKS_BACK)


def merged_plates(plates: DataFrame, *by: str) -> DataFrame:
    """Per plate the newest state of days or blocks, and the sums over them."""

    def newest(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col("seq"))).alias(column)

    return plates.groupBy(*by, "plate").agg(
        _newest_tails(F.col("tails")).alias("tails"), newest("last_speed"), newest("last_lane"),
        F.sum("infractions").alias("infractions"), F.sum("severe").alias("severe"),
    )


def merged_roads(roads: DataFrame, *by: str) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("n", "speeds", "sizes", "still")]
    return roads.groupBy(*by, "road").agg(*sums)


_MERGE = {"roads": merged_roads, "plates": merged_plates, "road_bits": merged_road_bits}


def _with_blocks(tables: _Tables, chain: Chain, commit: int) -> Chain:
    """The chain with all blocks that lie within its days, level by level."""
    level = 1
    while chain.days and RADIX**level <= chain.through - min(chain.days) + RADIX**level:
        size = RADIX**level
        firsts = sorted({d - d % size for d in chain.days if d - d % size + size - 1 <= chain.through})
        missing = [f for f in firsts if (level, f) not in chain.blocks]
        if not firsts:
            break
        children: list[tuple[int, int]] = []
        for first in missing:
            below = [(level - 1, d) for d in range(first, first + size, RADIX ** (level - 1))]
            children += [c for c in below if (c in chain.blocks if c[0] else c[1] in chain.days)]
        if children:
            first = F.col("seq") - F.pmod("seq", F.lit(size))
            merged = {}
            for part in MERGED:
                rows = tables.read(chain, part, children).withColumn("first", first)
                merged[part] = _MERGE[part](rows, "first").withColumn("seq", F.col("first"))
            folder = f"v={commit}/level={level}"
            tables.write(merged, folder)
            chain = replace(chain, blocks={**chain.blocks, **{(level, f): folder for f in missing}})
        level += 1
    return chain


# --- one stretch of days -----------------------------------------------------------------


@contextmanager
def _stretch(
    rows: DataFrame,
    incoming: DataFrame,
    late: DataFrame,
    numbers: DataFrame,
    params: Params,
    segment_rows: int,
    at_most: int,
) -> Iterator[dict[str, DataFrame]]:
    """Tables of consecutive days by ``first``, from what is carried into the first of them.

    ``incoming`` is the state of all plates before, ``late`` the scores of the day before
    that may still have a window into these days. ``severe`` has the time of each window.
    """
    fresh = rows.select(*READING.fieldNames())
    carried = incoming.select(F.inline("tails")).select(*READING.fieldNames())
    line = carried.withColumn("_new", F.lit(False)).union(fresh.withColumn("_new", F.lit(True)))
    split = split_hot_keys(line, VEHICLE, IN_TIME, segment_rows, at_most, before=LOOKS_BACK)
    moving = with_kinematics(split).drop("x", "direction").filter("_new").drop("_new")
    last = incoming.select("plate", "last_speed", "last_lane")
    with kept(moving.join(last, "plate", "left")) as moving:
        day = _day_of(F.col("time")).alias("first")
        starts = past.infraction_flags(moving, F.col("last_speed")).filter("change_in_speed = 1")
        scores = ["plate", "_id", "time", "total"]
        scored = past.driving_scores(moving, params, F.col("last_lane")).select(*scores)
        with kept(late.select(*scores).unionByName(scored)) as scored:
            far = past.reach(params)
            windows = split_hot_keys(
                scored, VEHICLE, IN_TIME, segment_rows, at_most, before=far, after=far
            )
            yield {
                "roads": moving.groupBy(day, "road").agg(
                    F.count(F.lit(1)).alias("n"),
                    F.sum(F.col("speed").cast("bigint")).alias("speeds"),
                    F.sum(F.col("road_size").cast("bigint")).alias("sizes"),
                    F.count_if(rules.standing_still()).alias("still"),
                ),
                "road_bits": road_bits(fresh.withColumn("first", day), numbers, "first"),
                "infraction_times": starts.select(day, "plate", "time"),
                "scores": scored,
                "severe": past.severe_windows(windows, params).select("plate", "time"),
                "tails": _tails(fresh.withColumn("first", day)),
                "last": moving.groupBy(day, "plate").agg(*_last(params)),
            }


def _tails(rows: DataFrame) -> DataFrame:
    """The newest readings of each plate and day, each as an array of one."""
    newest = Window.partitionBy("first", "plate").orderBy(F.desc("time"), F.desc("_id"))
    ranked = rows.withColumn("_r", F.row_number().over(newest)).filter(F.col("_r") <= LOOKS_BACK)
    return ranked.select("first", "plate", F.array(F.struct(*CARRIED.fieldNames())).alias("tails"))


def _last(params: Params) -> list[Column]:
    when = F.struct(*IN_TIME)
    return [
        F.max_by("speed", when).alias("last_speed"),
        F.max_by(F.when(past.in_band(params), F.col("y")), F.when(past.in_band(params), when)).alias("last_lane"),
    ]


def _plates(found: dict[str, DataFrame], severe: DataFrame) -> DataFrame:
    """One row for each plate and day, from parts that are summed in one shuffle."""
    one = F.lit(1).cast("bigint")
    parts = [
        found["tails"], found["last"],
        found["infraction_times"].select("first", "plate", one.alias("infractions")),
        severe.select("first", "plate", one.alias("severe")),
    ]
    line = parts[0]
    for part in parts[1:]:
        line = line.unionByName(part, allowMissingColumns=True)
    return line.groupBy("first", "plate").agg(
        _newest_tails(F.col("tails")).alias("tails"),
        F.max("last_speed").alias("last_speed"), F.max("last_lane").alias("last_lane"),
        F.coalesce(F.sum("infractions"), F.lit(0)).alias("infractions"),
        F.coalesce(F.sum("severe"), F.lit(0)).alias("severe"),
    )


def _close(
    tables: _Tables, history: DataFrame, chain: Chain, run: list[int], keys: dict, folder: str,
    params: Params, segment_rows: int,
) -> Chain:
    """Write the tables of a stretch of days anew; blocks with any of them are dropped."""
    spark, first, last = tables.spark, run[0], run[-1]
    rows = _between(history, first, last)
    incoming = merged_plates(tables.read(chain, "plates", chain.cover(-(1 << 30), first - 1)))
    late = tables.read(chain, "late_scores", [(0, first - 1)] if first - 1 in chain.days else [])
    at_most = sum(keys[d][0] for d in run) + keys.get(first - 1, NOTHING)[0]
    numbers = _road_numbers(spark, tables.base, rows)
    window = params.score_window_seconds
    with kept(incoming) as incoming:
        with _stretch(rows, incoming, late, numbers, params, segment_rows, at_most) as found:
            # A window counts for the day by which its end is known.
            settled = found["severe"].select(
                "plate", _day_of(F.col("time") + window).alias("first")
            ).filter(F.col("first") <= last)
            midnight = (F.col("first") + 1) * DAY - window
            unsettled = found["scores"].withColumn("first", _day_of(F.col("time")))
            unsettled = unsettled.filter((F.col("first") >= first) & (F.col("time") >= midnight))
            seq = F.col("first").alias("seq")
            tables.write({
                "roads": found["roads"].select("*", seq),
                "road_bits": found["road_bits"].select("*", seq),
                "infraction_times": found["infraction_times"],
                "late_scores": unsettled,
                "plates": _plates(found, settled).select("*", seq),
            }, folder)
    days = {**chain.days, **{d: Day(folder, keys[d]) for d in run}}
    stale = {(n, f) for n, f in chain.blocks if any(f <= d < f + RADIX**n for d in run)}
    blocks = {b: folder for b, folder in chain.blocks.items() if b not in stale}
    return replace(chain, days=days, blocks=blocks)


# --- what else a change reaches ----------------------------------------------------------


def _moved_plates(tables: _Tables, old: Chain, new: Chain, run: list[int], before: DataFrame | None) -> DataFrame:
    """Plates that leave a stretch of days with another state than they used to.

    ``before`` are those that came into it so.
    """
    state = F.struct("tails", "last_speed", "last_lane")

    def left(chain: Chain) -> DataFrame:
        rows = merged_plates(tables.read(chain, "plates", [(0, d) for d in run if d in chain.days]))
        full = (F.size("tails") == LOOKS_BACK) & F.col("last_speed").isNotNull()
        return rows.select("plate", state.alias("state"), (full & F.col("last_lane").isNotNull()).alias("full"))

    was, now = left(old).alias("was"), left(new).alias("now")
    both = was.join(now, F.col("was.plate").eqNullSafe(F.col("now.plate")), "full")
    same = F.col("was.state").eqNullSafe(F.col("now.state"))
    compared = both.select(
        F.coalesce("was.plate", "now.plate").alias("plate"), same.alias("_same"),
        # Such a state hides whatever was before.
        (same & F.coalesce("was.full", F.lit(False))).alias("_hides"),
    )
    moved = compared.filter(~F.col("_same")).select("plate")
    if before is not None:
        hidden = compared.filter("_hides").select("plate")
        moved = moved.union(before.join(hidden, "plate", "left_anti")).distinct()
    return pinned(moved.dropna())


def _next_reached(
    tables: _Tables, old: Chain, new: Chain, moved: DataFrame, last: int, pending: set[int]
) -> int | None:
    """The first later day that was closed from a state which is another one now."""
    later = [d for d in sorted(old.days) if d > last and d not in pending]
    if not later:
        return None
    if later[0] == last + 1:
        was, now = (tables.read(c, "late_scores", [(0, last)]) for c in (old, new))
        if not (was.exceptAll(now).isEmpty() and now.exceptAll(was).isEmpty()):
            return later[0]
    seen = tables.read(new, "plates", [(0, d) for d in later]).filter(F.size("tails") > 0)
    return seen.join(moved, "plate", "left_semi").agg(F.min("seq")).first()[0]


def updated(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    found: dict[int, tuple[int, Decimal]],
    through: int,
    params: Params = Params(),
    segment_rows: int = SEGMENT_ROWS,
) -> Chain:
    """Close all days up to ``through`` and replay what changed since the last time.

    ``found`` are the digests of the history's days now.
    """
    tables, old = _Tables(spark, base), load(spark, base)
    settings = _settings(params)
    commit = old.commit + 1
    known = old if old.settings == settings else Chain(old.commit)
    keys = {d: key for d, key in found.items() if d <= through}
    # Windows from late in a day are settled by the next one, even if it has no rows. Of a
    # day that lost all its rows an empty one stays.
    empty = {d + 1 for d in keys if d < through} | set(known.days)
    keys.update({d: NOTHING for d in empty if d not in keys})
    pending = {d for d, key in keys.items() if d not in known.days or known.days[d].key != key}
    if not pending:
        return known
    chain, moved, runs = replace(known, commit=commit, settings=settings), None, 0
    order = sorted(keys)
    while pending:
        at = order.index(min(pending))
        run = [order[at]]
        while (at := at + 1) < len(order) and order[at] in pending:
            run.append(order[at])
        chain = _close(tables, history, chain, run, keys, f"v={commit}/run={runs}", params, segment_rows)
        pending.difference_update(run)
        runs += 1
        if any(d > run[-1] for d in known.days):
            moved = _moved_plates(tables, known, chain, run, moved)
            reached = _next_reached(tables, known, chain, moved, run[-1], pending)
            if reached is not None and (not pending or reached < min(pending)):
                pending.add(reached)
    chain = _with_blocks(tables, chain, commit)
    _commit(spark, base, chain)
    # Readers of the entry before may still be at its folders.
    _prune(spark, base, chain, old)
    return chain


# --- the analyses --------------------------------------------------------------------------


def _infraction_sums(
    tables: _Tables, chain: Chain, fresh: DataFrame, as_of: float, params: Params
) -> DataFrame:
    """plate, total: infractions within the retention.

    Days wholly within it come as sums from blocks, days wholly out of it are not read, and
    only the days at its edge are counted by the reading.
    """
    edge = as_of - params.retention_seconds
    # A second more on both sides, so that no rounding decides.
    first_exact, first_whole = (int((edge + s) // DAY) for s in (-1, 1))
    young = rules.recent_enough(F.lit(as_of), params.retention_seconds)
    one = F.lit(1).cast("bigint").alias("total")
    border = [(0, d) for d in range(max(first_exact, 0), first_whole + 1) if d in chain.days]
    whole = tables.read(chain, "plates", chain.cover(first_whole + 1, 1 << 30))
    return (
        whole.filter("infractions > 0").select("plate", F.col("infractions").alias("total"))
        .union(tables.read(chain, "infraction_times", border).filter(young).select("plate", one))
        .union(fresh.filter(young).select("plate", one))
    )


@contextmanager
def past_analyses(
    spark: SparkSession,
    history: DataFrame,
    base: str,
    params: Params = Params(),
    as_of: float | None = None,
    segment_rows: int = SEGMENT_ROWS,
    open_days: int = 2,
    found: DataFrame | None = None,
) -> Iterator[tuple[dict[str, DataFrame], int]]:
    """The historical result tables and the rows of the history, from closed and open days.

    All but the last ``open_days`` days are closed. ``found`` are the digests of all days
    as ingestion keeps them; without them they are taken from a pass over the history. A
    reading dated after tomorrow closes nothing; one without a time is left out.
    """
    if "event_date" not in history.columns:
        history = with_event_date(history)
    as_of = float(int(clock.time())) if as_of is None else float(as_of)
    # One row for each day.
    keys = {r.day: (r.n, r.digest) for r in (digests(history) if found is None else found).collect()}
    today = (datetime.date.today() - datetime.date(1970, 1, 1)).days
    last = max((d for d in keys if d <= today + AHEAD_DAYS), default=None)
    chain = Chain()
    if last is not None:
        chain = updated(spark, history, base, keys, last - open_days, params, segment_rows)
    tables = _Tables(spark, base)
    through = chain.through
    rows = history if through is None else history.filter(F.col("event_date") > _date(through))
    cover = chain.cover(-(1 << 30), 1 << 30)
    late = tables.read(chain, "late_scores", [] if through is None else [(0, through)])
    at_most = sum(n for d, (n, _) in keys.items() if through is None or d >= through)
    numbers = _road_numbers(spark, base, rows)
    with kept(merged_plates(tables.read(chain, "plates", cover))) as state:
        with _stretch(rows, state, late, numbers, params, segment_rows, at_most) as fresh:
            roads = ["road", "n", "speeds", "sizes", "still"]
            bits = ["plate", "bucket", "bits"]
            severe = state.filter("severe > 0").select("plate", F.col("severe").alias("n"))
            severe = severe.union(fresh["severe"].select("plate", F.lit(1).cast("bigint")))
            totals = _infraction_sums(tables, chain, fresh["infraction_times"], as_of, params)
            banned = totals.groupBy("plate").agg(F.sum("total").alias("total_infractions"))
            yield {
                "historical2": past.merged_road_stats(
                    tables.read(chain, "roads", cover).select(*roads)
                    .union(fresh["roads"].select(*roads))
                ),
                "historical1": top_vehicles(
                    tables.read(chain, "road_bits", cover).select(*bits)
                    .union(fresh["road_bits"].select(*bits)), params
                ),
                "historical3": banned.filter(F.col("total_infractions") >= params.min_infractions),
                "alternative": severe.select("plate", F.explode(F.sequence(F.lit(1), "n")).alias("_i")).drop("_i"),
            }, sum(n for n, _ in keys.values())


def chained_days(found: Callable[[SparkSession], DataFrame] | None = None, open_days: int = 2):
    """The chain as the historical part of a refresh; ``found`` reads the days' digests."""

    @contextmanager
    def analyses(spark, history, base, params, as_of, segment_rows):
        kept_digests = None if found is None else found(spark)
        with past_analyses(
            spark, history, f"{base}/day_chain", params, as_of, segment_rows, open_days, kept_digests
        ) as out:
            yield out

    return analyses
