"""Packing token sequences into rows of fixed length by exact complements, then best fit.

The plan is made from the histogram of piece lengths alone, which has no more entries
than a row has tokens, whatever the size of the corpus. Longest first, each length
looks for one, two or three lengths that fill its gap exactly, as often as the counts
allow; what finds no complement is placed by best fit. Pieces are numbered within their
length by the partial counts of tasks, so no task sees a whole length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinelane.llm import common, tokens

LENGTH = 2048
END_ID = 0

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
    ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int64()),
    ("rank", pa.int64()), ("ids", pa.list_(pa.uint32())),
])
_PIECE_TYPE = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long"
)


def running_numbers(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each value how often it came before; ``seen`` keeps the counts."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(first, len(ordered)))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(ordered)) - np.repeat(first, sizes) + seen[ordered]
    seen[ordered[first]] += sizes
    return out


def cut_pieces(docs: DataFrame, path: str, length: int, end_id: int, with_ids: bool) -> DataFrame:
    """Pieces of each document's ids, numbered per length within their task."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(length + 1, np.int64)
        task = TaskContext.get().partitionId()
        encoder = tokens.encoder(path, False)

        def cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            flat, counts = encoder.ids(data, offsets)
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            begin = np.cumsum(counts) - counts
            pieces = -(-counts // length)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = tokens.ragged(np.zeros(len(counts), np.int64), pieces)
            start = piece * length
            size = np.minimum(counts[row] - start, length)
            at = begin[row] + start
            crc = [zlib.crc32(flat[a : a + n]) for a, n in zip(at.tolist(), size.tolist())]
            columns = [
                batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(size), pa.array(crc, pa.int64()),
                pa.array(np.full(len(row), task)), pa.array(running_numbers(size, seen)),
            ]
            if with_ids:
                columns.append(tokens.lists(flat[tokens.ragged(at, size)], size, pa.int32()))
            return pa.record_batch(columns, [*_PIECES.names][: len(columns)])

        yield from common.by_row_slices(batches, "text", cut)

    kind = _PIECE_TYPE + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(work, kind)


def _complement(avail: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to ``gap``, long ones first."""
    if avail[gap]:
        return (gap,)

    def pair(total: int, spare: np.ndarray) -> tuple[int, ...] | None:
        low = np.arange(1, total // 2 + 1)
        fits = (spare[low] > 0) & (spare[total - low] > (low == total - low))
        found = np.flatnonzero(fits)
        return (total - int(low[found[0]]), int(low[found[0]])) if len(found) else None

    if two := pair(gap, avail):
        return two
    for longest in np.flatnonzero(avail[: max(gap - 1, 0)])[::-1].tolist():
        if 3 * longest < gap:
            break
        spare = avail.copy()
        spare[longest] -= 1
        if two := pair(gap - longest, spare):
            return (longest, *two)
    return None


def _best_fit(left: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns for pieces placed one by one, longest first, each in the least room that holds it.

    Open rows are kept by the room they have; equal rows are one entry. A row that took a
    piece has the least room for the next of the same length, so it is filled up at once.
    """
    rooms: list[dict[tuple[int, ...], int]] = [{} for _ in range(length + 1)]
    for size, count in sorted(left.items(), reverse=True):
        room = size
        while count:
            while room < length and not rooms[room]:
                room += 1
            pattern, rows = rooms[room].popitem() if room < length else ((), count)
            per_row = room // size
            full = min(rows, count // per_row)
            count -= full * per_row
            filled = [(full, per_row)]
            if full < rows and count:
                filled.append((1, count))
                full, count = full + 1, 0
            if room < length and rows > full:
                rooms[room][pattern] = rows - full
            for times, copies in filled:
                if times:
                    grown, key = rooms[room - copies * size], pattern + (size,) * copies
                    grown[key] = grown.get(key, 0) + times
    return [item for room in rooms for item in room.items()]


def plan(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, longest first, and how many rows follow each."""
    avail = np.zeros(length + 1, np.int64)
    for size, count in histogram.items():
        avail[size] = count
    patterns: list[tuple[tuple[int, ...], int]] = []
    if avail[length]:
        patterns.append(((length,), int(avail[length])))
        avail[length] = 0
    left: dict[int, int] = {}
    for size in range(length - 1, 0, -1):
        while avail[size]:
            avail[size] -= 1
            found = _complement(avail, length - size)
            avail[size] += 1
            if not found:
                left[size], avail[size] = int(avail[size]), 0
                break
            pattern = (size, *found)
            times = min(int(avail[k]) // n for k, n in Counter(pattern).items())
            for k in pattern:
                avail[k] -= times
            patterns.append((tuple(sorted(pattern, reverse=True)), times))
    return patterns + _best_fit(left, length)


class Runs(NamedTuple):
    """For consecutive numbers of one length: where the pieces go."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    copies: np.ndarray


def runs(patterns: list[tuple[tuple[int, ...], int]]) -> Runs:
    taken: Counter[int] = Counter()
    found, sequence = [], 0
    for pattern, rows in patterns:
        offset = 0
        for size, copies in sorted(Counter(pattern).items(), reverse=True):
            found.append((size, taken[size], sequence, offset, copies))
            taken[size] += copies * rows
            offset += copies * size
        sequence += rows
    found.sort()
    return Runs(*np.array(found, np.int64).reshape(-1, 5).T)


def pack(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) per piece.

    A null or empty text is its end id alone. Repeated rows and rows without doc_id are
    packed like any other. Ties go by the order in which tasks meet them. Extra columns
    are ignored; an empty table gives no rows.
    """
    cut = common.stored(cut_pieces(docs, path, length, end_id, with_ids))
    per_task = common.stored(cut.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {
        row["length"]: row["n"] for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    places = runs(plan(histogram, length))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = common.stored(per_task.select(
        "length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    ))
    names = [f.name for f in cut.schema if f.name not in ("task", "rank")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stride = int(places.first.max(initial=0)) + 1
        keys = places.length * stride + places.first
        for batch in batches:
            size = batch.column("length").to_numpy()
            number = batch.column("base").to_numpy() + batch.column("rank").to_numpy()
            # Numbers beyond the last run's first must not reach into the next length.
            run = np.searchsorted(keys, size * stride + np.minimum(number, stride - 1), "right") - 1
            inside = number - places.first[run]
            copies = places.copies[run]
            sequence = places.sequence[run] + inside // copies
            offset = places.offset[run] + inside % copies * size
            yield pa.record_batch(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                [*names, "sequence_id", "offset"],
            )

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name in names)
    numbered = cut.join(bases, ["length", "task"])
    return numbered.mapInArrow(place, f"{kind}, sequence_id long, offset long")
