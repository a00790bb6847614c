"""Byte-level helpers shared by the text operators.

Texts reach Python as Arrow batches. Words, their hashes and windows over them are
computed on the UTF-8 buffer with numpy, a slice of a few megabytes at a time, so the
memory of a task follows the slice or the longest single text, never the partition.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelane.sources.files import new_table_path

#: Bytes of text handled at once (about 80 bytes of memory for each); a longer text is
#: handled alone.
SLICE_BYTES = 1 << 20

#: Byte ranges longer than this are hashed one by one.
LONG_RANGE = 512

_RANDOM = np.random.default_rng(20240229)
_RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)  # keeps the factors that follow as they were
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: One odd factor for each place of a word in a window.
FACTORS = _RANDOM.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application."""
    context = spark.sparkContext
    if getattr(context, "_kinelane_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="package-")) / "kinelane_package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._kinelane_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads each bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    if len(_powers[inverse]) < n:
        steps = np.full(max(n, 1 << 16), _BASE_INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        _powers[inverse] = np.cumprod(steps)
    return _powers[inverse][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, or with one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


class Words(NamedTuple):
    """Words of consecutive texts: byte ranges, the text each is in, 64-bit hashes."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hashes: np.ndarray


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all other bytes as they are."""
    return _LOWER[data]


def hashes_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ranges of mixed values from their running sums, wherever a range lies."""
    return mixed((sums[ends] - sums[starts]) * powers(len(sums), True)[starts])


#: What is left of eight bytes if a range has only so many more.
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def blocks(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def first_bytes(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Up to eight bytes from each start on, mixed; different bytes give different numbers."""
    return mixed((blocks(data)[starts] & _MASKS[size]) + FACTORS[size])


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges, which do not depend on where a range lies.

    Ranges of one size up to eight bytes have one hash only if they are the same: each step
    is a bijection. Longer ones go into two lanes, eight bytes at a time, that are mixed in
    different ways, so what would cancel out in one does not in the other.
    """
    eight = blocks(data)
    sizes = ends - starts
    out = eight[starts] & _MASKS[np.minimum(sizes, 8)]
    one = mixed((sizes.astype(np.uint64) + FACTORS[61]) ^ out * FACTORS[60])
    out = mixed(one)
    more = np.flatnonzero(sizes > 8)
    one = one[more]
    other = mixed(one ^ FACTORS[62])
    for r in np.flatnonzero(sizes[more] > LONG_RANGE):
        whole = xxhash.xxh3_128_intdigest(data[starts[more[r]] : ends[more[r]]].tobytes())
        one[r], other[r] = whole & (1 << 64) - 1, whole >> 64
    active = np.flatnonzero(sizes[more] <= LONG_RANGE)
    step = 8
    while len(active):
        left = sizes[more[active]] - step
        block = eight[starts[more[active]] + step] & _MASKS[np.minimum(left, 8)]
        one[active] = mixed((one[active] ^ block) * FACTORS[60])
        other[active] = mixed((other[active] + block) * FACTORS[59])
        active = active[left > 8]
        step += 8
    out[more] = mixed(one + other * FACTORS[58])
    return out


def same_ranges(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, others: np.ndarray
) -> np.ndarray:
    """Whether ranges of two byte arrays, of the same sizes, hold the same bytes."""
    here, there = blocks(data), blocks(other)
    same = np.ones(len(starts), bool)
    for r in np.flatnonzero(sizes > LONG_RANGE):
        same[r] = (
            data[starts[r] : starts[r] + sizes[r]] == other[others[r] : others[r] + sizes[r]]
        ).all()
    active = np.flatnonzero((sizes > 0) & (sizes <= LONG_RANGE))
    step = 0
    while len(active):
        left = sizes[active] - step
        mask = _MASKS[np.minimum(left, 8)]
        same[active] &= ((here[starts[active] + step] ^ there[others[active] + step]) & mask) == 0
        active = active[left > 8]
        step += 8
    return same


def runs(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of one non-zero kind that do not cross a text border."""
    if not len(kind):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    change = np.ones(len(kind) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    borders = np.flatnonzero(change)
    inside = kind[borders[:-1]] != 0
    return borders[:-1][inside], borders[1:][inside]


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Runs of bytes other than space and 0x09-0x0D."""
    starts, ends = runs(~_SPACE[data], offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    return Words(starts, ends, row, range_hashes(data, starts, ends))


def windows(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and hashes of all windows of ``size`` words within one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[size - 1 :])
    total = np.full(n, size, np.uint64)
    for place in range(size):
        total += hashes[place : place + n] * FACTORS[place]
    return at, mixed(total[at])


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches that are sorted by ``key``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        change = np.flatnonzero(keys[1:] != keys[:-1])
        if rest and keys[0] != rest[-1].column(key)[-1].as_py():
            yield pa.Table.from_batches(rest)
            rest = []
        if len(change):
            cut = int(change[-1]) + 1
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def by_row_slices(
    batches: Iterator[pa.RecordBatch],
    text: str,
    work: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch | None],
) -> Iterator[pa.RecordBatch]:
    """Apply ``work`` to the rows of each slice, with its bytes and offsets."""
    for batch in batches:
        data, offsets = utf8(batch.column(text))
        for first, last in slices(offsets):
            part = data[offsets[first] : offsets[last]]
            out = work(
                batch.slice(first, last - first), part, offsets[first : last + 1] - offsets[first]
            )
            if out is not None:
                yield out
    give_back()


def give_back() -> None:
    """Return freed memory to the system, as workers stay for the tasks to come."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


_C = ctypes.CDLL(None)
