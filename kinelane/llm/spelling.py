"""Spelling variants of the corpus vocabulary, by Bloom-guided edit neighbourhoods.

The vocabulary is counted from whole texts. Its words go into blocked Bloom filters, one
shard for each word length, which are broadcast; their size has a fixed bound. Each task
makes the edits of its words and probes the shard of the edit's length. Only edits that
a shard claims to hold are shuffled, to an exact join with the vocabulary that removes
the false ones, so the filters' size changes the cost but never the result.

Nearness is symmetric, so each pair is generated from one side: deletions reach the
shorter word, replacements by a smaller code point reach the other word of equal length.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.llm import common, twins
from kinelane.llm.tokens import ragged

#: Fixed values of the word list: one run in so many loses a code point.
THINNED = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A form is at least so many times as frequent as its variant.
TIMES = 5

#: Words longer than this share the last shard, so there are at most so many shards.
LAST_SHARD = 255
#: Filter bits for each word, until all shards together reach the bound of the broadcast.
WORD_BITS = 16
MOST_BLOCKS = 1 << 21
LANES, LANE_BITS = 8, 32

#: Distinct words, or bytes of them, that a task counts before it hands them on.
TASK_WORDS, TASK_BYTES = 200_000, 1 << 24
#: Places within words whose edits are made at once.
PLACES = 1 << 15
#: Runs up to this many bytes are hashed together, longer ones one by one.
SHORT_RUN = 64

ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint32)
_RANK = np.zeros(0x100, np.int64)
_RANK[ALPHABET] = np.arange(len(ALPHABET))
_LANE_FACTORS = common.FACTORS[:LANES]
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _crc_table() -> np.ndarray:
    """The byte-wise table of the reflected CRC-32."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


# --- the vocabulary ----------------------------------------------------------------


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to A-Z, a-z or U+00C0 to U+00FF."""
    folded = data | 0x20
    letter = (folded >= 0x61) & (folded <= 0x7A) & (data < 0x80)
    lead = data == 0xC3
    letter |= lead
    letter[1:] |= lead[:-1]
    return letter


def _crc_from(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges, each continued from the CRC-32 of what comes before it."""
    out = np.empty(len(starts), np.uint32)
    sizes = ends - starts
    for r in np.flatnonzero(sizes > SHORT_RUN):
        out[r] = zlib.crc32(data[starts[r] : ends[r]].tobytes(), int(state[r]))
    short = np.flatnonzero(sizes <= SHORT_RUN)
    short = short[np.argsort(-sizes[short], kind="stable")]
    register, at = ~state[short], starts[short]
    longest = sizes[short[0]] if len(short) else 0
    left = np.searchsorted(-sizes[short], -np.arange(longest), "left")
    for step, active in enumerate(left):
        now = register[:active]
        register[:active] = _CRC[(now ^ data[at[:active] + step]) & 0xFF] ^ (now >> np.uint32(8))
    out[short] = ~register
    return out


def _word_array(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    sizes = ends - starts
    flat = data[ragged(starts, sizes)]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(flat))


def _count_slice(counts: Counter, ids: list, data: np.ndarray, offsets: np.ndarray) -> None:
    """Add the words of a slice of texts to ``counts``."""
    starts, ends = common.runs(_letters(data), offsets)
    data = common.lowered(data)
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    lengths = points[ends] - points[starts]
    long_enough = lengths >= LEAST_LENGTH
    starts, ends, lengths = starts[long_enough], ends[long_enough], lengths[long_enough]
    if not len(starts):
        return
    row = np.searchsorted(offsets, starts, "right") - 1
    heads = [zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids]
    crc = _crc_from(np.array(heads, np.uint32)[row], data, starts, ends)
    thinned = crc % THINNED == 0
    for r in np.flatnonzero(thinned):
        word = data[starts[r] : ends[r]].tobytes().decode()
        place = int(crc[r]) % len(word)
        if len(word) > LEAST_LENGTH:
            counts[word[:place] + word[place + 1 :]] += 1
    found = _word_array(data, starts[~thinned], ends[~thinned]).value_counts()
    for word, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
        counts[word] += n


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of whole texts, with at least ``LEAST_COUNT`` occurrences.

    Tasks count their own words first, so a frequent word shuffles one row for each of a
    task's hand-overs. A null or empty text has no words; repeated rows count each; a row
    without an id is hashed with an empty one.
    """
    common.shipped(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.record_batch(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"],
            )
            counts.clear()
            return out

        size = 0
        for batch in batches:
            data, offsets = common.utf8(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            for first, last in common.slices(offsets):
                part = data[offsets[first] : offsets[last]]
                _count_slice(counts, ids[first:last], part, offsets[first : last + 1] - offsets[first])
                # A slice adds at most its own bytes.
                size += len(part)
                if size > TASK_BYTES or len(counts) > TASK_WORDS:
                    size = sum(map(len, counts))
                if size > TASK_BYTES or len(counts) > TASK_WORDS:
                    yield handed_on()
                    size = 0
        yield handed_on()

    counted = docs.select("doc_id", "text").mapInArrow(work, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= LEAST_COUNT)


# --- the filters -------------------------------------------------------------------


class Shards(NamedTuple):
    """First block and number of blocks of each shard, by ``min(length, LAST_SHARD)``."""

    first: np.ndarray
    blocks: np.ndarray


def shards_for(sizes: dict[int, int]) -> Shards:
    """Blocks for so many words of each shard, at most ``MOST_BLOCKS`` and one for each."""
    wanted = np.zeros(LAST_SHARD + 1, np.int64)
    for shard, n in sizes.items():
        wanted[shard] = -(-n * WORD_BITS // (LANES * LANE_BITS))
    over = wanted.sum() / MOST_BLOCKS
    if over > 1:
        wanted = np.where(wanted > 0, np.maximum(1, np.floor(wanted / over)), 0).astype(np.int64)
    return Shards(np.cumsum(wanted) - wanted, wanted)


def _factor(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """What a code point at a place adds to the sum that a word is hashed from."""
    return common.mixed((place.astype(np.uint64) << np.uint64(8)) + code.astype(np.uint64) + np.uint64(1))


def _hashed(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return common.mixed(sums + lengths.astype(np.uint64) * _SPREAD)


def _blocks_of(hashes: np.ndarray, lengths: np.ndarray, shards: Shards) -> np.ndarray:
    shard = np.minimum(lengths, LAST_SHARD)
    inside = ((hashes >> np.uint64(32)) * shards.blocks[shard].astype(np.uint64)) >> np.uint64(32)
    return shards.first[shard] + inside.astype(np.int64)


def _lane_bit(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Which of the lane's 32 bits a hash sets."""
    low = hashes & np.uint64(0xFFFFFFFF)
    return ((low * _LANE_FACTORS[lane]) >> np.uint64(59)).astype(np.uint32)


class Codes(NamedTuple):
    """Code points of words, end to end, with the word and the place of each."""

    code: np.ndarray
    word: np.ndarray
    place: np.ndarray
    first: np.ndarray
    lengths: np.ndarray


def _codes(words: list[str]) -> Codes:
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    return Codes(code, word, np.arange(len(code)) - first[word], first, lengths)


def _sum_before(values: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total


def filters(vocab: DataFrame) -> tuple[Shards, np.ndarray]:
    """The shards of a vocabulary and their bits, (block, lane), at most 64 MB."""
    shard = F.least(F.length("word"), F.lit(LAST_SHARD))
    sizes = vocab.groupBy(shard.alias("shard")).count().collect()
    shards = shards_for({r["shard"]: r["count"] for r in sizes})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            if not words:
                continue
            codes = _codes(words)
            total = _sum_before(_factor(codes.place, codes.code))
            sums = total[codes.first + codes.lengths] - total[codes.first]
            hashes = _hashed(sums, codes.lengths)
            block = _blocks_of(hashes, codes.lengths, shards)
            order = np.argsort(block, kind="stable")
            starts = np.flatnonzero(np.diff(block[order], prepend=-1))
            lanes = [
                np.bitwise_or.reduceat((np.uint32(1) << _lane_bit(hashes, j))[order], starts)
                for j in range(LANES)
            ]
            yield pa.record_batch(
                [pa.array(block[order][starts]), *[pa.array(x.view(np.int32)) for x in lanes]],
                ["block", *[f"lane{j}" for j in range(LANES)]],
            )

    names = [f"lane{j}" for j in range(LANES)]
    rows = vocab.select("word").mapInArrow(work, "block long, " + ", ".join(f"{c} int" for c in names))
    merged = rows.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in names]).toArrow()
    bits = np.zeros((int(shards.blocks.sum()), LANES), np.uint32)
    at = merged.column("block").to_numpy()
    for j, name in enumerate(names):
        bits[at, j] = merged.column(name).to_numpy().view(np.uint32)
    return shards, bits


def _claimed(
    bits: np.ndarray, shards: Shards, sums: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Which of the hashed edits their shard may hold."""
    alive = np.flatnonzero(shards.blocks[np.minimum(lengths, LAST_SHARD)] > 0)
    hashes = _hashed(sums[alive], lengths[alive])
    block = _blocks_of(hashes, lengths[alive], shards)
    for lane in range(LANES):
        bit = np.uint32(1) << _lane_bit(hashes, lane)
        hit = (bits[block, lane] & bit) != 0
        alive, hashes, block = alive[hit], hashes[hit], block[hit]
    return alive


# --- the neighbourhoods --------------------------------------------------------------


def _claimed_edits(
    words: list[str], shards: Shards, bits: np.ndarray
) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Numbers of words, and edits of them that the filters claim to hold."""
    codes = _codes(words)
    factor = _factor(codes.place, codes.code)
    before = _sum_before(factor)
    # What follows a deleted code point moves one place to the front.
    moved = _sum_before(_factor(np.maximum(codes.place - 1, 0), codes.code))
    end = codes.first + codes.lengths
    whole = before[end] - before[codes.first]
    repeated = np.zeros(len(codes.code), bool)
    repeated[1:] = (codes.code[1:] == codes.code[:-1]) & (codes.word[1:] == codes.word[:-1])
    for low in range(0, len(codes.code), PLACES):
        at = np.arange(low, min(low + PLACES, len(codes.code)))
        # Of equal code points in a row the first alone is deleted: all give one word.
        gone = at[~repeated[at]]
        word = codes.word[gone]
        sums = before[gone] - before[codes.first[word]] + moved[end[word]] - moved[gone + 1]
        hit = _claimed(bits, shards, sums, codes.lengths[word] - 1)
        yield word[hit], [
            words[w][:p] + words[w][p + 1 :]
            for w, p in zip(word[hit].tolist(), codes.place[gone[hit]].tolist())
        ]
        smaller = _RANK[codes.code[at]]
        place = np.repeat(at, smaller)
        new = ALPHABET[ragged(np.zeros(len(at), np.int64), smaller)]
        word = codes.word[place]
        sums = whole[word] - factor[place] + _factor(codes.place[place], new)
        hit = _claimed(bits, shards, sums, codes.lengths[word])
        yield word[hit], [
            words[w][:p] + chr(c) + words[w][p + 1 :]
            for w, p, c in zip(
                word[hit].tolist(), codes.place[place[hit]].tolist(), new[hit].tolist()
            )
        ]


def _batches_of(words: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of words with at most about ``limit`` code points, or of one word."""
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])
    return common.slices(ends, limit)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """word, n, near, near_n: each pair of near words once, from the one its edit is made of."""
    common.shipped(vocab.sparkSession)
    shards, bits = filters(vocab)
    held = vocab.sparkSession.sparkContext.broadcast((shards, bits))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, bits = held.value
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            for first, last in _batches_of(words):
                part = words[first:last]
                for which, near in _claimed_edits(part, shards, bits):
                    if len(near):
                        yield pa.record_batch(
                            [
                                pa.array([part[w] for w in which.tolist()], pa.string()),
                                pa.array(n[first:last][which]), pa.array(near, pa.string()),
                            ],
                            ["word", "n", "near"],
                        )

    edits = vocab.select("word", "n").mapInArrow(work, "word string, n long, near string")
    exact = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return edits.join(exact, "near").select("word", "n", "near", "near_n")


def _roots(links: DataFrame, most: int) -> DataFrame:
    """word, root: the end of each chain of forms.

    A form is ``TIMES`` as frequent as its variant, so chains are short; each turn doubles
    how far a word looks ahead.
    """
    longest = max(1, math.floor(math.log(max(most, LEAST_COUNT) / LEAST_COUNT, TIMES)) + 1)
    links = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(longest))):
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        ahead = links.join(onward, "root", "left")
        links = common.stored(ahead.select("word", F.coalesce("_next", "root").alias("root")))
    return links


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary of ``docs``.

    ``form`` is the near word of largest n (the smallest of equally frequent ones) where it
    is ``TIMES`` as frequent, else null; ``root`` follows forms to the last. Texts that are
    null, empty or without words give nothing, repeated rows count each, other columns are
    ignored, and an empty table gives no rows. Words of any length are handled.
    """
    vocab = common.stored(vocabulary(docs))
    pairs = near_pairs(vocab)
    there = F.struct("word", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    sides = pairs.select(F.inline(F.array(there, back)))
    first = F.struct(-F.col("near_n"), F.col("near"))
    best = sides.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min_by(F.struct("near", "near_n"), first).alias("best"),
    )
    joined = vocab.join(best, "word", "left")
    strong = F.col("best.near_n") >= TIMES * F.col("n")
    found = common.stored(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, F.col("best.near_n")).alias("form_n"),
    ))
    most = found.agg(F.max("n")).first()[0] or 0
    roots = _roots(found.where("form IS NOT NULL"), most)
    ended = found.join(roots, "word", "left")
    return ended.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _sql() -> str:
    crc = twins.crc32_of(twins.bytes_of("coalesce(doc_id::VARCHAR, '') || ':' || run"))
    upper, lower = (bytes(range(first, first + 26)).decode() for first in (0x41, 0x61))
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'),
                                             '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, {crc} AS h FROM runs
), counted AS (
  SELECT CASE WHEN h % {THINNED} = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1
), vocab AS (
  SELECT word, n FROM counted WHERE length(word) >= {LEAST_LENGTH} AND n >= {LEAST_COUNT}
), places AS (
  SELECT word, n, unnest(range(length(word))) AS i FROM vocab
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest,
         substr(word, 1, i) || '*' || substr(word, i + 2) AS pattern
  FROM places
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.pattern = b.pattern AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN vocab b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(struct_pack(near, near_n), struct_pack(m := -near_n, near)) AS b
  FROM pairs GROUP BY word
), found AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.b.near_n >= {TIMES} * v.n THEN b.b.near END AS form,
         CASE WHEN b.b.near_n >= {TIMES} * v.n THEN b.b.near_n END AS form_n
  FROM vocab v LEFT JOIN best b ON b.word = v.word
), chain(word, now, next) AS (
  SELECT word, word, form FROM found
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN found f ON f.word = c.next
)
SELECT f.word, f.form, c.now AS root, f.n, f.n_near, f.form_n
FROM found f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""


ORACLE = _sql()
