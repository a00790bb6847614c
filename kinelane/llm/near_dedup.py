"""Near-duplicate groups by b-bit MinHash, confirmed on whole shingle sets.

1. Each text gets its distinct five-word shingles, 192 minima over them, the lowest
   ``BITS`` bits of each packed into a signature, and one key for each band. Bands have
   as many rows as the threshold allows.
2. Texts with equal sets are one class, stood for by its smallest id.
3. Classes that share a band key are candidates. Within a bucket, similarity is
   estimated from the bits that agree, corrected for agreement by chance; the pairs
   that could reach the threshold are joined into clusters. Only a spanning forest
   leaves a task.
4. Within a cluster all classes are compared on whole sets; again only a forest of the
   confirmed links leaves a task. Its components are the result.

Buckets and clusters above a block size are cut into blocks, and each pair of blocks is
one group, so no task holds more than two blocks whatever the size of the group.

Chance of losing a link: at the threshold itself a pair shares no band with a
probability of at most ``LEAST_LOST``, as (1 - 0.85 ** 6) ** 32 = 3e-7 or
(1 - 0.80 ** 5) ** 38 = 3e-7, and its estimate falls below the margin of 4.5 standard
deviations with 3e-6; both fall steeply above it, and a text is separated only if all its
links are lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinelane.llm import common
from kinelane.llm.graph import components

SHINGLE_WORDS = 5
BITS = 4
#: Linked if percent * union <= 100 * intersection; this one unless another is given.
PERCENT = 85
#: Probability of sharing no band that is taken at the threshold.
LEAST_LOST = 1e-6
#: Rows of a bucket, and texts of a cluster, in one block.
BUCKET_BLOCK, CLUSTER_BLOCK = 1024, 384
#: Up to so many clustered texts, or crowded buckets (at most 32 bytes each, so 32 MB), are
#: sent to the other side of their join; beyond that both sides are dealt out by key.
SENT_IDS = 1_000_000

_PERMS = 192
_ODD = np.random.default_rng(7).integers(1, 1 << 62, _PERMS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ZERO_NIBBLES = np.array([(not b & 15) + (not b >> 4) for b in range(256)], np.uint8)


def estimated(agreeing: np.ndarray) -> np.ndarray:
    """Similarity from the number of agreeing values, without agreement by chance."""
    by_chance = 0.5**BITS
    return (agreeing / _PERMS - by_chance) / (1 - by_chance)


def band_rows(percent: int) -> int:
    """The most rows of a band with which a pair at the threshold shares one but for chance."""
    def lost(rows: int) -> float:
        return (1 - (percent / 100) ** rows) ** (_PERMS // rows)

    return max((r for r in range(1, 17) if lost(r) <= LEAST_LOST), default=1)


def _least_agreement(percent: int = PERCENT) -> int:
    """Agreeing values that a pair at the threshold reaches but for 4.5 deviations."""
    chance = 0.5**BITS
    expected = percent / 100 * (1 - chance) + chance
    return int(_PERMS * (expected - 4.5 * np.sqrt(expected * (1 - expected) / _PERMS)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their counts.

    A text with fewer words than a shingle has its whole sequence as the only one.
    """
    rows = len(offsets) - 1
    found = common.words(common.lowered(data), offsets)
    per_row = np.bincount(found.row, minlength=rows)
    at, hashes = common.windows(found.hashes, found.row, SHINGLE_WORDS)
    bounds = np.searchsorted(found.row[at], np.arange(rows + 1))
    first = np.concatenate([[0], np.cumsum(per_row)])
    sets = []
    for row in range(rows):
        if per_row[row] >= SHINGLE_WORDS:
            sets.append(np.unique(hashes[bounds[row] : bounds[row + 1]]))
        elif per_row[row]:
            own = found.hashes[first[row] : first[row] + per_row[row]]
            total = np.uint64(per_row[row]) + (own * common.FACTORS[: len(own)]).sum(dtype=np.uint64)
            sets.append(common.mixed(np.array([total], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    counts = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), counts


_SIGNED = pa.schema([
    ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("print1", pa.int64()),
    ("print2", pa.int64()), ("bits", pa.binary()), ("bands", pa.list_(pa.int64())),
])


def _signed(
    batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, per_band: int
) -> pa.RecordBatch:
    shingles, counts = shingle_sets(data, offsets)
    full = np.flatnonzero(counts)
    begins = (np.cumsum(counts) - counts)[full]
    n = len(full)
    minima = np.empty((_PERMS, n), np.uint64)
    prints = np.zeros((2, len(counts)), np.uint64)
    if n:
        product = np.empty_like(shingles)
        for perm in range(_PERMS):
            np.multiply(shingles, _ODD[perm], out=product)
            np.minimum.reduceat(product, begins, out=minima[perm])
        prints[0, full] = np.add.reduceat(common.mixed(shingles + np.uint64(1)), begins)
        prints[1, full] = np.add.reduceat(common.mixed(shingles ^ common.FACTORS[63]), begins)
    low = ((minima >> np.uint64(20)) & np.uint64(15)).astype(np.uint8)
    packed = np.ascontiguousarray((low[0::2] | (low[1::2] << 4)).T)
    n_bands = _PERMS // per_band
    keys = np.empty((n, n_bands), np.uint64)
    for band in range(n_bands):
        rows = minima[band * per_band : (band + 1) * per_band]
        keys[:, band] = common.mixed(
            (rows * common.FACTORS[:per_band, None]).sum(axis=0, dtype=np.uint64) + np.uint64(band)
        )
    bits: list[bytes | None] = [None] * len(counts)
    bands: list[np.ndarray | None] = [None] * len(counts)
    for place, row in enumerate(full):
        bits[row] = packed[place].tobytes()
        bands[row] = keys[place].view(np.int64)
    return pa.record_batch([
        batch.column("doc_id"), pa.array(counts), pa.array(prints[0].view(np.int64)),
        pa.array(prints[1].view(np.int64)), pa.array(bits, pa.binary()),
        pa.array(bands, pa.list_(pa.int64())),
    ], schema=_SIGNED)


def signatures(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, two prints of the set, packed bits, band keys (null if empty)."""
    signed = partial(_signed, per_band=band_rows(percent))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return common.by_row_slices(batches, "text", signed)

    return docs.select("doc_id", "text").mapInArrow(
        work,
        "doc_id long, n_shingles long, print1 long, print2 long, bits binary, bands array<long>",
    )


def _local_roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest place that each of ``n`` places reaches over the given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _agreeing(bits: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = np.empty(len(left), np.int64)
    for first in range(0, len(left), 1 << 16):
        part = slice(first, first + (1 << 16))
        out[part] = _ZERO_NIBBLES[bits[left[part]] ^ bits[right[part]]].sum(axis=1, dtype=np.int64)
    return out


def _bucket_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A forest over the pairs of each bucket whose estimate is high enough."""
    least = _least_agreement(percent)
    for rows in common.whole_groups(batches, "bucket"):
        bucket = rows.column("bucket").to_numpy()
        docs = rows.column("doc_id").to_numpy()
        bits = np.frombuffer(
            b"".join(rows.column("bits").to_pylist()), np.uint8
        ).reshape(len(docs), _PERMS // 2)
        lefts, rights = [], []
        here = np.arange(len(docs))
        for step in range(1, len(docs)):
            here = here[here + step < len(docs)]
            here = here[bucket[here] == bucket[here + step]]
            if not len(here):
                break
            near = here[_agreeing(bits, here, here + step) >= least]
            lefts.append(near)
            rights.append(near + step)
        if not lefts:
            continue
        left, right = np.concatenate(lefts), np.concatenate(rights)
        root = _local_roots(left, right, len(docs))
        moved = np.flatnonzero(root != np.arange(len(docs)))
        edges = np.unique(np.stack([docs[moved], docs[root[moved]]], 1), axis=0)
        edges = edges[edges[:, 0] != edges[:, 1]]
        if len(edges):
            yield pa.record_batch([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])


def _confirmed(
    data: np.ndarray, offsets: np.ndarray, docs: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """A forest of the links among some texts, on their whole sets.

    Walks from text to text and compares each with those not yet reached.
    """
    shingles, counts = shingle_sets(data, offsets)
    owner = np.repeat(np.arange(len(docs)), counts)
    _, ids = np.unique(shingles, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    holders = owner[order]
    begin = np.searchsorted(ids[order], np.arange(ids.max() + 2)) if len(ids) else np.zeros(1, int)
    first = np.concatenate([[0], np.cumsum(counts)])
    waiting = np.ones(len(docs), bool)
    edges = []
    for seed in range(len(docs)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        queue = [seed]
        while queue and waiting.any():
            now = queue.pop()
            own = ids[first[now] : first[now + 1]]
            sizes = begin[own + 1] - begin[own]
            places = np.repeat(begin[own] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            shared = np.bincount(holders[places], minlength=len(docs))
            union = counts[now] + counts - shared
            near = np.flatnonzero(waiting & (shared > 0) & (100 * shared >= percent * union))
            waiting[near] = False
            queue.extend(near.tolist())
            edges += [(int(docs[now]), int(docs[other])) for other in near]
    return edges


def _cluster_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for rows in common.whole_groups(batches, "cluster"):
        cluster = rows.column("cluster").to_numpy()
        docs = rows.column("doc_id").to_numpy()
        data, offsets = common.utf8(rows.column("text"))
        borders = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1], [True]]))
        edges = []
        for a, b in zip(borders[:-1], borders[1:]):
            if b - a > 1:
                edges += _confirmed(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], docs[a:b], percent
                )
        if edges:
            u, v = zip(*edges)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _in_blocks(members: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Members under a key for each pair of blocks that they are in.

    A group within one block keeps one key. In a larger one, block i meets every
    block, in pairs (i, j) with i <= j.
    """
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("doc_id", F.lit(1)), n).cast("int")
    pairs = F.when(n <= 1, F.array(F.lit("0"))).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda j: F.concat_ws("_", F.least(own, j), F.greatest(own, j)),
        )
    )
    cut = members.withColumn("_pair", F.explode(pairs))
    return cut.withColumn(group, F.xxhash64(group, "_pair")).drop("_pair", size)


def _sent(keys: DataFrame) -> DataFrame:
    """Keys of a few numbers each, to be broadcast where their size allows."""
    return F.broadcast(keys) if keys.count() <= SENT_IDS else keys


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    Texts are linked from a similarity of ``percent`` hundredths on.
    A null or empty text, or one without words, has an empty set and stands alone.
    Rows that repeat a doc_id each give a row; their texts count as texts of one
    document. A row without doc_id is linked with nothing: component_id null, kept.
    Extra columns are ignored. An empty table gives no rows.
    """
    signed = common.stored(signatures(docs, percent))
    known = signed.where("doc_id is not null and n_shingles > 0")
    classes = ["print1", "print2", "n_shingles"]
    ids = known.groupBy(*classes).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    copies = common.stored(ids.where("n > 1").drop("n"))
    is_rep = known.join(copies, classes, "left").where("rep is null or rep = doc_id")
    banded = is_rep.select("doc_id", F.explode("bands").alias("bucket"))
    crowded = common.stored(
        banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    )
    crowded = _sent(crowded)
    # Only the keys of crowded buckets meet the signatures.
    members = banded.join(crowded, "bucket").join(is_rep.select("doc_id", "bits"), "doc_id")
    grouped = _in_blocks(members, "bucket", "size", BUCKET_BLOCK)
    likely = grouped.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        partial(_bucket_links, percent=percent), "u long, v long"
    )
    clusters = common.stored(
        components(likely).select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    )
    sizes = common.stored(clusters.groupBy("cluster").agg(F.count("*").alias("size")))
    placed = clusters.join(sizes, "cluster")
    if clusters.count() <= SENT_IDS:
        placed = F.broadcast(placed)
    texts = docs.where("doc_id is not null").select("doc_id", "text").join(placed, "doc_id")
    cut = _in_blocks(texts, "cluster", "size", CLUSTER_BLOCK)
    links = cut.repartition("cluster").sortWithinPartitions("cluster").mapInArrow(
        partial(_cluster_links, percent=percent), "u long, v long"
    )
    found = common.stored(
        components(links).select(F.col("id").alias("rep"), "component")
    )
    # Copies follow their representative, without taking part in the search for links.
    member = signed.join(copies, classes, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    named = member.join(found, "rep", "left")
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(linked, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
    out = named.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stand for their group, with all their columns.

    Of rows that repeat one doc_id, all stay together.
    """
    dropped = near_groups(docs, percent).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti")


#: The registered query in SQL: shared shingles counted pair by pair, then all that is reached.
ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN []::VARCHAR[]
         WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END
  ) AS shingle
  FROM texts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), near AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON s.a = x.doc_id JOIN sizes y ON s.b = y.doc_id
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
), links AS (
  SELECT a, b FROM near UNION ALL SELECT b, a FROM near
), reached(doc_id, other) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON r.other = l.a
), found AS (
  SELECT doc_id, min(other) AS least FROM reached GROUP BY doc_id
)
SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles,
       least(t.doc_id, coalesce(f.least, t.doc_id)) AS component_id,
       t.doc_id = least(t.doc_id, coalesce(f.least, t.doc_id)) AS kept
FROM texts t LEFT JOIN sizes s ON t.doc_id = s.doc_id LEFT JOIN found f ON t.doc_id = f.doc_id
"""
