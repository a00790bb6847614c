"""Toxicity by a chain of linear classifiers over labelled categories.

The categories are taken in order. Each has a logistic model over the presence of
telling words and word beginnings (which stand for all forms of a stem), over a few
counts of the text, and over the probabilities of the
categories before it; for training these come from models that did not see the row
(out of fold), so a later model does not trust them more than it may.

Words are hashed on their bytes. The training sample is bounded and documented; word
counts over it, and all scoring, are Spark jobs. Near copies enter training once, as a
wrong label that was copied would otherwise look like a telling word: a labelled document
stays out if its similarity to one that is in, of three-word shingles and estimated from
128 minima, is 0.8 or more.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinelane.llm import common

#: Labelled documents to learn from, drawn by a hash of their id.
SAMPLE_ROWS = 20_000
#: Telling words and beginnings kept for each category.
WORDS = 192
#: Bytes of the beginnings that are looked at.
BEGINNINGS = range(3, 9)
FOLDS = 5
#: The bar for telling words lies this much below twice the log of the words tested: a few
#: words may pass by chance, and the fit weighs them lightly.
SLACK = 7.0
#: Weight of the squared coefficients.
RIDGE = 0.1
THRESHOLD = 0.5
#: Similarity from which on a labelled document is a copy of another.
COPY = 0.8
_SKETCH, _BAND = 128, 4
_ODD = np.random.default_rng(17).integers(1, 1 << 62, _SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Link(NamedTuple):
    """One category's model: sorted word hashes and coefficients.

    Coefficients are those of the constant, the counts, the earlier categories, the words.
    """

    words: np.ndarray
    coefficients: np.ndarray


def _counts(data: np.ndarray, offsets: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Length, shares of capitals and of signs, and mean word length of each text."""
    def total(flag: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flag)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    size = np.maximum(np.diff(offsets), 1).astype(float)
    letters = total(_KIND[data] == 1)
    signs = size - letters - total(_SPACE[data])
    return np.stack([
        np.log1p(n_words) / 5, total(_UPPER[data]) / np.maximum(letters, 1),
        signs / size, letters / np.maximum(n_words, 1) / 10,
    ], 1)


def _features(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and hash of each lower-cased word and beginning, and the counts of each text.

    The words come first, in their order.
    """
    starts, ends = common.runs(_KIND[data], offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    lower = common.lowered(data)
    rows, hashes = [row], [common.range_hashes(lower, starts, ends)]
    for size in BEGINNINGS:
        longer = ends - starts > size
        first = starts[longer]
        rows.append(row[longer])
        hashes.append(common.first_bytes(lower, first, size))
    counts = _counts(data, offsets, np.bincount(row, minlength=len(offsets) - 1))
    return np.concatenate(rows), np.concatenate(hashes), counts


def _presence(row: np.ndarray, hashes: np.ndarray, rows: int, words: np.ndarray) -> np.ndarray:
    out = np.zeros((rows, len(words)))
    if len(words):
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        hit = words[at] == hashes
        out[row[hit], at[hit]] = 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic coefficients by Newton steps; the first column is the constant."""
    penalty = np.full(x.shape[1], RIDGE)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    rate = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
    w[0] = np.log(rate / (1 - rate))
    if not len(y) or y.min() == y.max():
        return w
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + penalty * w
        curve = (x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def _inputs(counts: np.ndarray, earlier: list[np.ndarray], present: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(counts)), counts, *earlier, present])


def scores(links: list[Link], data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The probability of each category for each text, along the chain."""
    row, hashes, counts = _features(data, offsets)
    earlier: list[np.ndarray] = []
    for link in links:
        present = _presence(row, hashes, len(counts), link.words)
        earlier.append(_sigmoid(_inputs(counts, earlier, present) @ link.coefficients))
    return earlier


def _drawn(docs: DataFrame, labels: DataFrame, categories: list[str], limit: int) -> DataFrame:
    """row, doc_id, text and categories of the labelled documents drawn, at most ``limit`` ids.

    A document with several labels has the highest; one with a missing label is not drawn.
    """
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(
        *(F.max(F.col(c).cast("double")).alias(c) for c in categories)
    ).dropna()
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    # At most ``limit`` small rows, so the side is bounded whatever the tables hold.
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    return joined.withColumn("row", F.monotonically_increasing_id())


def _sketched(drawn: DataFrame, categories: list[str]) -> DataFrame:
    """row, doc_id, categories, counts and a sketch of each text: a few hundred bytes."""
    def read(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        counts = _features(data, offsets)[2]
        plain = common.words(common.lowered(data), offsets)
        at, shingles = common.windows(plain.hashes, plain.row, 3)
        full, begins = np.unique(plain.row[at], return_index=True)
        minima = np.empty((len(full), _SKETCH), np.uint32)
        for k in range(_SKETCH if len(full) else 0):
            minima[:, k] = common.mixed(np.minimum.reduceat(shingles * _ODD[k], begins)).astype(np.uint32)
        sketch: list[bytes | None] = [None] * len(counts)
        for place, text in enumerate(full):
            sketch[text] = minima[place].tobytes()
        return pa.record_batch(
            [batch.column("row"), batch.column("doc_id"), *(batch.column(c) for c in categories),
             pa.array(counts.tolist(), pa.list_(pa.float64())), pa.array(sketch, pa.binary())],
            ["row", "doc_id", *categories, "counts", "sketch"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return common.by_row_slices(batches, "text", read)

    kinds = ", ".join(f"{c} double" for c in categories)
    return drawn.mapInArrow(
        work, f"row long, doc_id long, {kinds}, counts array<double>, sketch binary"
    )


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], limit: int) -> DataFrame:
    """doc_id, categories, counts and a sketch of the labelled documents drawn."""
    return _sketched(_drawn(docs, labels, categories, limit), categories)


def _kept_rows(drawn: DataFrame, rows: np.ndarray) -> DataFrame:
    spark = drawn.sparkSession
    ids = spark.createDataFrame(pa.table({"row": pa.array(rows, pa.int64())}))
    return drawn.join(F.broadcast(ids), "row", "left_semi")


def _tallied(kept: DataFrame, categories: list[str]) -> DataFrame:
    """word, a and k_<category>: documents with a word, and those of them in a category.

    Tasks count a slice of texts before they hand words on.
    """
    names = [f"k_{c}" for c in categories]

    def tally(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        row, hashes, _ = _features(data, offsets)
        order = np.lexsort((row, hashes))
        row, hashes = row[order], hashes[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
        row, hashes = row[new], hashes[new]
        words, first, n = np.unique(hashes, return_index=True, return_counts=True)
        sums = [
            np.add.reduceat(batch.column(c).to_numpy()[row], first) if len(row) else np.empty(0)
            for c in categories
        ]
        return pa.record_batch(
            [pa.array(words.view(np.int64)), pa.array(n), *map(pa.array, sums)], ["word", "a", *names]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return common.by_row_slices(batches, "text", tally)

    kinds = ", ".join(f"{c} double" for c in names)
    parts = kept.select("text", *categories).mapInArrow(work, f"word long, a long, {kinds}")
    sums = [F.sum(c).alias(c) for c in ("a", *names)]
    return parts.groupBy("word").agg(*sums).where("a >= 3")


def _telling(tallied: DataFrame, category: str, n: int, positive: float) -> np.ndarray:
    """Hashes of the words that tell most about a category, beyond what chance gives.

    Ranked by the likelihood ratio; as many are tested as there are words, and the bar
    follows their number.
    """
    rate = positive / n

    def part(count, expected):
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    a, k = F.col("a"), F.col(f"k_{category}")
    ratio = 2 * (part(k, a * rate) + part(a - k, a * (1 - rate)))
    scored = tallied.select("word", ratio.alias("ratio"))
    bar = 2 * np.log(max(tallied.count(), 2)) - SLACK
    best = scored.where(F.col("ratio") > float(bar)).orderBy(F.desc("ratio"), "word").limit(WORDS)
    return np.sort(np.array([r["word"] for r in best.collect()], np.int64).view(np.uint64))


def _hits(kept: DataFrame, words: np.ndarray) -> DataFrame:
    """row and places: which of the words each text has, where it has any."""
    def find(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
        row, hashes, _ = _features(data, offsets)
        text, place = np.nonzero(_presence(row, hashes, len(offsets) - 1, words))
        some, counts = np.unique(text, return_counts=True)
        if not len(some):
            return None
        bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        places = pa.ListArray.from_arrays(pa.array(bounds), pa.array(place.astype(np.int32)))
        return pa.record_batch([batch.column("row").take(pa.array(some)), places], ["row", "places"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return common.by_row_slices(batches, "text", find)

    return kept.select("row", "text").mapInArrow(work, "row long, places array<int>")


def _first_of_copies(sketches: list[bytes | None]) -> np.ndarray:
    """Whether each text is no near copy of one before it that is none itself.

    Texts at the similarity share no band of minima with a probability of 5e-8. One
    without a sketch is a copy of nothing.
    """
    minima = np.zeros((len(sketches), _SKETCH), np.uint32)
    known = np.array([sketch is not None for sketch in sketches], bool)
    for row in np.flatnonzero(known):
        minima[row] = np.frombuffer(sketches[row], np.uint32)
    bands = minima.reshape(len(sketches), _SKETCH // _BAND, _BAND).astype(np.uint64)
    keys = common.mixed(
        (bands * common.FACTORS[:_BAND]).sum(axis=2, dtype=np.uint64)
        + np.arange(_SKETCH // _BAND, dtype=np.uint64)
    )
    # Only keys that come more than once are held.
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    shared = (counts[inverse.reshape(keys.shape)] > 1) & known[:, None]
    keep = np.ones(len(sketches), bool)
    held: dict[int, list[int]] = {}
    for row in np.flatnonzero(shared.any(axis=1)):
        own = keys[row, shared[row]].tolist()
        near = list({other for key in own for other in held.get(key, ())})
        if near and ((minima[near] == minima[row]).mean(axis=1) >= COPY).any():
            keep[row] = False
            continue
        for key in own:
            held.setdefault(key, []).append(int(row))
    return keep


def train(
    docs: DataFrame, labels: DataFrame, categories: list[str], limit: int = SAMPLE_ROWS
) -> list[Link]:
    """The chain over ``categories``, 0/1 columns of ``labels``, in their order."""
    drawn = common.stored(_drawn(docs, labels, categories, limit))
    base = _sketched(drawn, categories).toPandas()
    base = base.sort_values(["doc_id", "row"]).drop_duplicates("doc_id").reset_index(drop=True)
    base = base[_first_of_copies(base["sketch"].tolist())].drop(columns="sketch").reset_index(drop=True)
    kept = _kept_rows(drawn, base["row"].to_numpy(np.int64))
    tallied = common.stored(_tallied(kept, categories))
    counts = np.array(base["counts"].tolist()).reshape(len(base), 4)
    place = {int(d): i for i, d in enumerate(base["row"])}
    fold = (common.mixed(base["doc_id"].to_numpy(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int)
    links: list[Link] = []
    earlier: list[np.ndarray] = []
    for category in categories:
        y = base[category].to_numpy(float)
        mixed = len(y) > 0 and 0 < y.sum() < len(y)
        words = _telling(tallied, category, len(y), float(y.sum())) if mixed else np.empty(0, np.uint64)
        present = np.zeros((len(base), len(words)))
        if len(words):
            for hit in _hits(kept, words).toLocalIterator():
                present[place[hit["row"]], hit["places"]] = 1
        x = _inputs(counts, earlier, present)
        links.append(Link(words, fit(x, y)))
        unseen = np.zeros(len(y))
        for k in range(FOLDS):
            out = fold == k
            unseen[out] = _sigmoid(x[out] @ fit(x[~out], y[~out]))
        earlier.append(unseen)
    common.give_back()
    return links


def judge(docs: DataFrame, links: list[Link], categories: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs``, p_<category> for each and ``toxic`` by the last category.

    A null or empty text is scored like a text without words. Repeated rows are scored
    alike. Columns of ``docs`` with the names of results give way to them.
    """
    made = [f"p_{c}" for c in categories] + ["toxic"]
    kept = docs.drop(*made)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
            found = scores(links, data, offsets)
            columns = [*batch.columns, *map(pa.array, found), pa.array(found[-1] >= threshold)]
            return pa.record_batch(columns, [*batch.schema.names, *made])

        return common.by_row_slices(batches, "text", rows)

    kind = T.StructType(list(kept.schema.fields))
    for name in made:
        kind = kind.add(name, "boolean" if name == "toxic" else "double")
    return kept.mapInArrow(work, kind)
