"""Token ids in files of canonical, length-limited Huffman codes.

One code for all ids is built from their counts over the whole corpus, which no longer
grow once the vocabulary is seen. A file row holds a segment: documents in ascending
doc_id order, each a byte-aligned run of codes with a checkpoint (a bit offset) every
``BLOCK`` ids. Blocks decode independently, so a segment is decoded by a table, many
blocks in step, without walking it from its start.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinelane.llm import common, tokens
from kinelane.sources.files import new_table_path, remove

#: Bits of the longest code, ids between two checkpoints, bytes of codes in a segment.
MAX_BITS, BLOCK, SEGMENT_BYTES = 18, 256, 1 << 20
#: Bytes of ids encoded at once.
ENCODE_BYTES = 1 << 18


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits, by merging packages of two.

    Zero counts get no code; a single symbol gets one bit.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} symbols need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    # For each level which of its merged items are packages, in weight order.
    levels = []
    packages = np.empty(0)
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        by_weight = np.argsort(items, kind="stable")
        levels.append(by_weight >= len(weights))
        merged = items[by_weight]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take = 2 * len(order) - 2
    depth = np.zeros(len(order), np.int64)
    for is_package in reversed(levels):
        chosen = is_package[:take]
        singles = int((~chosen).sum())
        depth[:singles] += 1
        take = 2 * int(chosen.sum())
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes counted upwards by length, then by symbol."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for symbol in order.tolist():
        code <<= int(lengths[symbol]) - last
        last = int(lengths[symbol])
        codes[symbol] = code
        code += 1
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length of the code at the front of any ``MAX_BITS`` bits."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    spans = 1 << (MAX_BITS - lengths[order].astype(np.int64))
    pad = (1 << MAX_BITS) - int(spans.sum())
    symbols = np.concatenate([np.repeat(order, spans), np.zeros(pad, np.int64)])
    sizes = np.concatenate([np.repeat(lengths[order], spans), np.ones(pad, np.uint8)])
    return symbols.astype(np.uint32), sizes.astype(np.int64)


def encode(
    ids: np.ndarray, counts: np.ndarray, codes: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of consecutive documents, bytes of each, and the bit offset of each id."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    begin = ends - bits
    doc = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    per_doc = np.add.reduceat(np.append(bits, 0), first) * (counts > 0) if len(counts) else counts
    sizes = -(-per_doc // 8)
    at = 8 * (np.cumsum(sizes) - sizes)
    within = begin - np.append(begin, 0)[first][doc]
    place = at[doc] + within
    total = int(sizes.sum())
    room = np.zeros(total // 4 + 3, np.uint64)
    word, shift = place >> 5, (place & 31).astype(np.uint64)
    value = codes[ids] << (np.uint64(64) - shift - bits.astype(np.uint64))
    if len(ids):
        # Codes never overlap, so adding those that begin in one word is setting bits.
        group = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        high = np.add.reduceat(value >> np.uint64(32), group)
        low = np.add.reduceat(value & np.uint64(0xFFFFFFFF), group)
        room[word[group]] += high
        room[word[group] + 1] += low
    return room.astype(">u4").view(np.uint8)[:total], sizes, within


def decode(
    data: np.ndarray, bit: np.ndarray, counts: np.ndarray, symbols: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """Ids of blocks that begin at the given bits, end to end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.int64)
    at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint32)
    live = np.argsort(-counts, kind="stable")
    position, number = bit[live].copy(), counts[live]
    step = 0
    while True:
        n = int(np.searchsorted(-number, -step, "left"))
        if not n:
            return out
        position = position[:n]
        byte = position >> 3
        front = (
            (padded[byte] << 24) | (padded[byte + 1] << 16) | (padded[byte + 2] << 8) | padded[byte + 3]
        )
        key = (front >> (32 - MAX_BITS - (position & 7))) & ((1 << MAX_BITS) - 1)
        out[at[live[:n]] + step] = symbols[key]
        position = position + sizes[key]
        step += 1


def _tokenised(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id and the ids of its text and the end id, as little-endian 16 or 32 bits."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder(path, True)
        narrow = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16

        def rows(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            flat, counts = encoder.ids(data, offsets)
            flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u2" if narrow else "<u4")
            ends = np.cumsum(counts + 1)
            ids = [flat[b - n : b].tobytes() for b, n in zip(ends.tolist(), (counts + 1).tolist())]
            return pa.record_batch(
                [batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array(np.full(len(ids), flat.itemsize, np.int32))],
                ["doc_id", "ids", "width"],
            )

        yield from common.by_row_slices(batches, "text", rows)

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, ids binary, width int")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw, offsets = common.utf8(batch.column("ids"))
    width = batch.column("width")[0].as_py() if batch.num_rows else 4
    return raw.view(f"<u{width}").astype(np.int64), np.diff(offsets) // width


def id_counts(tokenised: DataFrame) -> DataFrame:
    """How often each id occurs in the corpus."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(_flat(batch)[0])
            if len(found) > len(total):
                found[: len(total)] += total
                total = found
            else:
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], ["id", "n"])

    parts = tokenised.select("ids", "width").mapInArrow(work, "id long, n long")
    return parts.groupBy("id").agg(F.sum("n").alias("n"))


def _encoded(tokenised: DataFrame, lengths: np.ndarray) -> DataFrame:
    codes = canonical_codes(lengths)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for whole in batches:
            raw_ends = common.utf8(whole.column("ids"))[1]
            for first, last in common.slices(raw_ends, ENCODE_BYTES):
                batch = whole.slice(first, last - first)
                ids, counts = _flat(batch)
                data, sizes, within = encode(ids, counts, codes, lengths)
                blocks = -(-counts // BLOCK)
                begin = np.cumsum(counts) - counts
                places = np.repeat(begin, blocks) + tokens.ragged(np.zeros_like(blocks), blocks) * BLOCK
                ends = np.cumsum(sizes)
                payload = [data[b - n : b].tobytes() for b, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.record_batch(
                    [batch.column("doc_id"), pa.array(counts), pa.array(payload, pa.binary()),
                     tokens.lists(within[places], blocks, pa.int64())],
                    ["doc_id", "n_tokens", "payload", "checkpoints"],
                )

    return tokenised.mapInArrow(
        work, "doc_id long, n_tokens long, payload binary, checkpoints array<long>"
    )


_SEGMENT = "part int, before long, total long, doc_ids array<long>, n_tokens array<long>, n_bytes array<long>, checkpoints array<long>, payload binary"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in order gathered into segments, each with the ids before it in its part."""
    number, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        _raw, offsets = common.utf8(batch.column("payload"))
        for first, last in common.slices(offsets, SEGMENT_BYTES):
            part = batch.slice(first, last - first)
            payload = part.column("payload").to_pylist()
            total = sum(part.column("n_tokens").to_pylist())
            yield pa.record_batch(
                [
                    pa.array([number], pa.int32()), pa.array([before]), pa.array([total]),
                    pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([part.column("n_tokens").to_pylist()], pa.list_(pa.int64())),
                    pa.array([[len(p) for p in payload]], pa.list_(pa.int64())),
                    pa.array([part.column("checkpoints").flatten()], pa.list_(pa.int64())),
                    pa.array([b"".join(payload)], pa.binary()),
                ],
                ["part", "before", "total", "doc_ids", "n_tokens", "n_bytes", "checkpoints", "payload"],
            )
            before += total


def write(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> None:
    """Write ``folder``/codes and ``folder``/segments.

    Each text (null: empty) ends with ``end_id``. Documents are in ascending doc_id
    order over the files, those without doc_id first; repeated rows are all written, and
    rows of one doc_id may lie in several parts. An empty table gives tables without rows.
    """
    spark = docs.sparkSession
    place = new_table_path(spark)
    _tokenised(docs, path, end_id).write.parquet(place)
    tokenised = spark.read.parquet(place)
    counted = id_counts(tokenised).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=0) + 1, np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        list(zip(used.tolist(), lengths[used].tolist())), "id long, bits int"
    ).coalesce(1).write.parquet(f"{folder}/codes")
    # Coded once: dealing rows by range looks at their order twice. Rows of one id are told
    # apart by where they were written, so that one id may have more rows than a task.
    coded = common.stored(
        _encoded(tokenised, lengths).withColumn("row", F.monotonically_increasing_id())
    )
    remove(spark, place)
    ordered = coded.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    (
        ordered.drop("row").mapInArrow(_segments, _SEGMENT)
        .write.option("compression", "none").parquet(f"{folder}/segments")
    )


def _part_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids in all parts before each part, one sum for each part of the files."""
    segments = spark.read.schema(_SEGMENT).parquet(f"{folder}/segments")
    sums = segments.groupBy("part").agg(F.sum("total").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(sums, key=lambda r: r["part"]):
        starts[row["part"]] = total
        total += row["n"]
    return starts


def _decoded(
    spark: SparkSession, folder: str, column: str, kind: str, made: Callable[[np.ndarray], object]
) -> DataFrame:
    """doc_id, start, n_tokens and what is made of each document's ids, from the files."""
    codes = spark.read.parquet(f"{folder}/codes").collect()
    lengths = np.zeros(max((r["id"] for r in codes), default=0) + 1, np.uint8)
    for row in codes:
        lengths[row["id"]] = row["bits"]
    starts = _part_starts(spark, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        symbols, sizes = decoding_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                n_tokens = batch.column("n_tokens")[row].values.to_numpy()
                n_bytes = batch.column("n_bytes")[row].values.to_numpy()
                marks = batch.column("checkpoints")[row].values.to_numpy()
                data = np.frombuffer(batch.column("payload")[row].as_buffer(), np.uint8)
                blocks = -(-n_tokens // BLOCK)
                number = tokens.ragged(np.zeros_like(blocks), blocks)
                size = np.minimum(np.repeat(n_tokens, blocks) - number * BLOCK, BLOCK)
                bit = marks + np.repeat(8 * (np.cumsum(n_bytes) - n_bytes), blocks)
                ids = decode(data, bit, size, symbols, sizes).astype("<u4")
                ends = np.cumsum(n_tokens)
                out = [made(ids[b - n : b]) for b, n in zip(ends.tolist(), n_tokens.tolist())]
                begin = starts[batch.column("part")[row].as_py()] + batch.column("before")[row].as_py()
                yield pa.record_batch(
                    [batch.column("doc_ids")[row].values, pa.array(begin + ends - n_tokens),
                     pa.array(n_tokens), pa.array(out)],
                    ["doc_id", "start", "n_tokens", column],
                )

    # One segment at a time: it becomes several times its size.
    return spark.read.schema(_SEGMENT).parquet(f"{folder}/segments").mapInArrow(
        work, f"doc_id long, start long, n_tokens long, {column} {kind}"
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32 bits) from the files."""
    return _decoded(spark, folder, "ids", "binary", lambda ids: ids.tobytes())


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files.

    ``start`` is the place in the files: the ids of all documents before it.
    """
    return _decoded(spark, folder, "ids_crc32", "long", lambda ids: zlib.crc32(ids))


def round_trip(docs: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write the corpus to a folder of its own and read the digests back."""
    folder = new_table_path(docs.sparkSession)
    write(docs, path, folder, end_id)
    return digests(docs.sparkSession, folder)
