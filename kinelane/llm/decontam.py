"""Benchmark decontamination by templates of questions.

Numbers, names and units become typed placeholders, so a question that was given other
values has the same template. Windows of eight template tokens are hashed; a document's
windows meet the benchmark's in a hash join. The values behind the placeholders must then
fit: within an occurrence of an item, one value of the item stands for one value of the
document. Windows that disagree with the majority do not count. A document is
contaminated by an item if at least half of the item's windows are found in one
occurrence: windows at one distance from their places in the item, windows whose
distances differ by less than half an item, as words put in or left out change them, or
all windows of the document, as the parts of an item may lie anywhere.

Where plain words are few, a template says little, and more is asked:

* a window with fewer than ``LEAST_PLAIN`` plain words is found only with equal values;
* an item without a window of enough plain words is also found by the template of the
  whole item, if that has ``LEAST_WHOLE`` plain words;
* an item of three or four words is found with equal values as a sentence of its own.

Half of the windows with enough plain words, or half of all windows, must be found.

* a number is a run of digits, a unit a word of ``UNITS`` right behind a number,
* a name is a capitalised word that does not begin a sentence, a line or the text,
* all other words count in lower case; punctuation does not count. In scripts without
  spaces each character is a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinelane.llm import common

WINDOW = 8
#: Words of a window that are no placeholder; windows with fewer need equal values.
LEAST_PLAIN = 4
#: Plain words of a whole item that is found by its template alone.
LEAST_WHOLE = 2
#: Shorter items must be sentences of their own; items under ``LEAST_SENTENCE`` words
#: cannot be told from chance and match nothing.
LEAST_WORDS, LEAST_SENTENCE = 5, 3
#: How a window is looked for: by template, with equal values, as a whole item, as a sentence.
PLAIN, EQUAL, WHOLE, SENTENCE = range(4)
#: Part of an item's windows that must be found.
COVERAGE = 0.5
#: Benchmark windows that one pass over the documents looks for (8 bytes each).
PASS_WINDOWS = 2_000_000
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres "
    "kilometer kilometers mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec secs min mins h hr hrs second seconds minute "
    "minutes hour hours day days week weeks month months year years cent cents dollar dollars euro "
    "euros percent degree degrees kmh mph"
).split()

_NUMBER, _NAME, _UNIT = (common.mixed(np.array([n], np.uint64))[0] for n in (11, 12, 13))
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n\r"]] = True


def _hash_of(words: list[str]) -> np.ndarray:
    column = pa.array(words)
    data, offsets = common.utf8(column)
    return np.sort(common.range_hashes(data, offsets[:-1], offsets[1:]))


_UNIT_HASHES = _hash_of(UNITS)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _kinds(data: np.ndarray) -> np.ndarray:
    """Kind of each byte; neighbouring characters of scripts without spaces differ in kind."""
    kind = _KIND[data]
    if not (data >= 0xE0).any():
        return kind
    second = np.append(data[1:], np.uint8(0))
    third = np.append(data[2:], np.zeros(2, np.uint8))[: len(data)]
    lead = (data >= 0xE3) & (data <= 0xE9)
    lead |= (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    lead |= (data == 0xE1) & np.isin(second, [0x80, 0x81, 0x82, 0x9E, 0x9F])
    mark = (data == 0xE3) & (second == 0x80)
    mark |= (data == 0xEF) & (second == 0xBC) & ((third <= 0x8F) | (third >= 0x9A) & (third <= 0xA0))
    places = np.flatnonzero(lead)
    for step in range(3):
        at = places + step
        kind[at[at < len(kind)]] = (3 + np.arange(len(places)) % 2)[at < len(kind)]
    places = np.flatnonzero(mark)
    for step in range(3):
        at = places + step
        kind[at[at < len(kind)]] = 0
    return kind


class Tokens(NamedTuple):
    """Of each token: text, template hash, own hash, placeholder, first and last of a sentence."""

    row: np.ndarray
    shape: np.ndarray
    own: np.ndarray
    placeholder: np.ndarray
    begins: np.ndarray
    closes: np.ndarray


def template(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    kind = _kinds(data)
    starts, ends = common.runs(kind, offsets)
    row = np.searchsorted(offsets, starts, "right") - 1
    own = common.range_hashes(common.lowered(data), starts, ends)
    if not len(starts):
        return Tokens(row, own, own, *[np.empty(0, bool)] * 3)
    number = kind[starts] == 2
    follows = np.zeros(len(starts), bool)
    follows[1:] = row[1:] == row[:-1]
    unit = np.zeros(len(starts), bool)
    unit[1:] = number[:-1] & follows[1:] & ~number[1:] & _among(own[1:], _UNIT_HASHES)
    stops = np.concatenate([[0], np.cumsum(_ENDS[data])])
    inner = np.zeros(len(starts), bool)
    inner[1:] = follows[1:] & (stops[starts[1:]] == stops[ends[:-1]])
    upper = (data >= 0x41) & (data <= 0x5A)
    second = np.minimum(starts + 1, len(data) - 1)
    name = inner & upper[starts] & (ends - starts > 1) & ~upper[second] & ~number
    shape = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, own)))
    return Tokens(row, shape, own, number | unit | name, ~inner, np.append(~inner[1:], True))


def _windows(t: Tokens, how: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First tokens and hashes of the windows of a size that may be found this way."""
    values = t.shape if how in (PLAIN, WHOLE) else t.own
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    counted = np.concatenate([[0], np.cumsum(~t.placeholder)])
    plain = counted[size:] - counted[:-size]
    fits = t.row[:n] == t.row[size - 1 :]
    if how == PLAIN:
        fits &= plain >= min(LEAST_PLAIN, size)
    elif how == EQUAL:
        fits &= plain < min(LEAST_PLAIN, size)
    elif how == WHOLE:
        fits &= plain >= LEAST_WHOLE
    else:
        fits &= t.begins[:n] & t.closes[size - 1 :]
    at = np.flatnonzero(fits)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * common.powers(len(values)))])
    hashes = common.hashes_between(sums, at, at + size)
    return at, common.mixed(hashes + np.uint64(size) + (np.uint64(how) << np.uint64(40)))


def _slots(t: Tokens, how: int, at: np.ndarray, size: int) -> list[list[int]]:
    """Values behind the placeholders; none where they are part of the hash."""
    if how in (EQUAL, SENTENCE):
        return [[]] * len(at)
    return [_signed(t.own[a : a + size][t.placeholder[a : a + size]]).tolist() for a in at.tolist()]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, at, hash, item_slots, how, size for each window of each item.

    An item with fewer than ``WINDOW`` words is one window of its own length. A slot is
    named by the first place of its value in the item, so items that differ in values
    alone have equal windows.
    """
    def cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        t = template(data, offsets)
        per_row = np.bincount(t.row, minlength=len(offsets) - 1)
        first = np.cumsum(per_row) - per_row
        out: list[tuple] = []
        pairs = np.stack([t.row.astype(np.uint64), t.own])
        _, earliest, which = np.unique(pairs, axis=1, return_index=True, return_inverse=True)
        named = t._replace(own=(earliest[which.reshape(-1)] - first[t.row]).astype(np.uint64))

        def add(how: int, size: int, chosen: np.ndarray) -> np.ndarray:
            at, hashes = _windows(t, how, size)
            right = chosen[t.row[at]]
            at, hashes = at[right], hashes[right]
            rows = t.row[at]
            out.extend(zip(
                rows.tolist(), (at - first[rows]).tolist(), _signed(hashes).tolist(),
                _slots(named, how, at, size), [how] * len(at), [size] * len(at),
            ))
            return np.isin(np.arange(len(per_row)), rows)

        plain = np.zeros(len(per_row), bool)
        for size in range(LEAST_WORDS, WINDOW + 1):
            chosen = per_row >= WINDOW if size == WINDOW else per_row == size
            if chosen.any():
                plain |= add(PLAIN, size, chosen)
                add(EQUAL, size, chosen)
        for size in np.unique(per_row[~plain & (per_row >= LEAST_WORDS)]).tolist():
            add(WHOLE, size, ~plain & (per_row == size))
        for size in range(LEAST_SENTENCE, LEAST_WORDS):
            add(SENTENCE, size, per_row == size)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64())
        rows, *columns = (
            pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * len(kinds), kinds)
        )
        return pa.record_batch(
            [batch.column("item_id").take(rows), *columns],
            ["item_id", "at", "hash", "item_slots", "how", "size"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return common.by_row_slices(batches, "text", cut)

    items = benchmark.where("item_id is not null").select("item_id", "text")
    return items.mapInArrow(
        work, "item_id long, at long, hash long, item_slots array<long>, how long, size long"
    )


def _found(docs: DataFrame, wanted: np.ndarray, forms: list[tuple[int, int]]) -> DataFrame:
    """Windows of the documents whose hash is wanted: doc_id, print, doc_at, hash, doc_slots.

    ``forms`` are the ways and sizes in which the benchmark has windows.
    """
    ordered = np.sort(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
            t = template(data, offsets)
            rows, places, values, slots = [], [], [], []
            first = np.searchsorted(t.row, np.arange(len(offsets)))
            for how, size in forms:
                at, hashes = _windows(t, how, size)
                hit = _among(_signed(hashes), ordered)
                at = at[hit]
                rows += t.row[at].tolist()
                places += (at - first[t.row[at]]).tolist()
                values += _signed(hashes[hit]).tolist()
                slots += _slots(t, how, at, size)
            if not rows:
                return None
            at_rows = pa.array(rows, pa.int64())
            return pa.record_batch(
                [batch.column("doc_id").take(at_rows), batch.column("print").take(at_rows),
                 pa.array(places, pa.int64()), pa.array(values, pa.int64()),
                 pa.array(slots, pa.list_(pa.int64()))],
                ["doc_id", "print", "doc_at", "hash", "doc_slots"],
            )

        return common.by_row_slices(batches, "text", cut)

    return docs.select("doc_id", _print(), "text").mapInArrow(
        work, "doc_id long, print long, doc_at long, hash long, doc_slots array<long>"
    )


def _print() -> Column:
    return F.xxhash64(common.text_or_empty()).alias("print")


def _forms(items: DataFrame) -> DataFrame:
    """Of each item: its numbers of windows, and digests of those that ask for no values and of all."""
    plain, free = F.col("how") == PLAIN, F.col("how").isin(PLAIN, WHOLE)
    prints = [F.xxhash64(F.lit(seed), "at", "hash", "item_slots", "how", "size") for seed in (1, 2)]
    return items.groupBy("item_id").agg(
        F.count_distinct("at").alias("n_windows"),
        F.count_distinct(F.when(plain, F.col("at"))).alias("n_plain"),
        F.max(free).alias("has_free"), F.max(~free).alias("has_bound"),
        F.struct(*(F.bit_xor(F.when(free, p)) for p in prints)).alias("free_form"),
        F.struct(*(F.bit_xor(p) for p in prints)).alias("form"),
    )


def _first_of(forms: DataFrame, form: str) -> DataFrame:
    """item_id (the smallest), n_windows, n_plain of each set of items of one form."""
    alike = forms.groupBy(form, "n_windows", "n_plain").agg(F.min("item_id").alias("item_id"))
    return alike.select("item_id", "n_windows", "n_plain")


def item_classes(benchmark: DataFrame) -> DataFrame:
    """item_id, class_id: the smallest id of the items that no other values could tell apart.

    Items of one class have the same template, and equal values in the same places; a copy
    with values of its own is a copy of all of them. Items that are found with equal values
    alone are in one class if they are equal. Items that match nothing are left out.
    """
    forms = common.stored(_forms(common.stored(item_windows(benchmark).distinct())))
    form = F.when(F.col("has_free"), F.col("free_form")).otherwise(F.col("form"))
    forms = forms.select("item_id", "has_free", form.alias("form"), "n_windows", "n_plain")
    key = ["has_free", "form", "n_windows", "n_plain"]
    first = forms.groupBy(*key).agg(F.min("item_id").alias("class_id"))
    return forms.join(first, key).select("item_id", "class_id")


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, print (of the text), item_id, n_found for each contaminating item.

    Items of one template count as one, named by the smallest id (see ``item_classes``):
    windows are met once for each class, not once for each of its items. An item some of
    whose windows need equal values is looked for by all its windows too, in the documents
    that hold one of those, and then stands for itself and for equal items.

    The benchmark's hashes go to the tasks in passes of a stated size, so neither
    table has to be small.
    """
    items = common.stored(item_windows(benchmark).distinct())
    plain, whole = F.col("how") == PLAIN, F.col("how") >= WHOLE
    forms = [(r["how"], r["size"]) for r in items.select("how", "size").distinct().collect()]
    hashes = items.select("hash").distinct()
    passes = max(1, -(-hashes.count() // PASS_WINDOWS))
    found = None
    for number in range(passes):
        own = hashes.where(F.pmod(F.xxhash64("hash"), F.lit(passes)) == number)
        wanted = own.toPandas()["hash"].to_numpy(np.int64)
        part = _found(docs, wanted, forms).distinct()
        found = part if found is None else found.union(part)
    key = ["doc_id", "print", "item_id", "bound"]
    met = common.stored(_occurrences(_met(common.stored(found), items), key))
    key.append("occurrence")
    same = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & reduce(
        Column.__and__, [F.col(f"{a}.{c}") == F.col(f"{b}.{c}") for c in key[1:]]
    )
    value = F.explode(F.arrays_zip("item_slots", "doc_slots"))
    agreed = (
        met.select(*key, value.alias("v"))
        .groupBy(*key, F.col("v.item_slots").alias("theirs"), F.col("v.doc_slots").alias("ours"))
        .agg(F.count("*").alias("n"))
        .groupBy(*key, "theirs")
        .agg(F.max_by("ours", F.struct("n", "ours")).alias("ours"))
        .groupBy(*key)
        .agg(F.map_from_entries(F.collect_list(F.struct("theirs", "ours"))).alias("agreed"))
    )
    consistent = F.forall(
        F.arrays_zip("item_slots", "doc_slots"),
        lambda v: F.col("agreed")[v["item_slots"]] == v["doc_slots"],
    )
    judged = met.alias("m").join(agreed.alias("a"), same("m", "a"), "left").where(consistent)
    counted = judged.groupBy(*(f"m.{c}" for c in key)).agg(
        F.count_distinct("m.at").alias("n_found"), F.first("m.n_windows").alias("n_windows"),
        F.count_distinct(F.when(plain, F.col("m.at"))).alias("plain_found"),
        F.first("m.n_plain").alias("n_plain"), F.max(whole).alias("whole"),
    )
    enough = F.col("n_found") >= F.lit(coverage) * F.col("n_windows")
    enough |= (F.col("n_plain") > 0) & (F.col("plain_found") >= F.lit(coverage) * F.col("n_plain"))
    return (
        counted.where(enough | F.col("whole"))
        .groupBy("doc_id", "print", "item_id")
        .agg(F.max("n_found").alias("n_found"))
    )


def _met(found: DataFrame, items: DataFrame) -> DataFrame:
    """Windows met by classes of items, and (``bound``) by items that need equal values somewhere."""
    forms = common.stored(_forms(items))
    free = F.col("how").isin(PLAIN, WHOLE)
    by_class = items.where(free).join(_first_of(forms.where("has_free"), "free_form"), "item_id")
    by_item = items.join(_first_of(forms.where("has_bound"), "form"), "item_id")
    pairs = found.join(by_item.where(~free), "hash").select("doc_id", "print", "item_id").distinct()
    asked = pairs.join(by_item, "item_id")
    same = F.col("a.doc_id").eqNullSafe(F.col("f.doc_id"))
    for column in ("print", "hash"):
        same &= F.col(f"a.{column}") == F.col(f"f.{column}")
    again = asked.alias("a").join(found.alias("f"), same).select("a.*", "f.doc_at", "f.doc_slots")
    classes = found.join(by_class, "hash").withColumn("bound", F.lit(False))
    return classes.unionByName(again.withColumn("bound", F.lit(True)))


def _occurrences(met: DataFrame, key: list[str]) -> DataFrame:
    """Each met window once for each occurrence that it is part of."""
    shift = F.col("doc_at") - F.col("at")
    by_shift = Window.partitionBy(*key).orderBy("shift")
    apart = F.col("shift") - F.lag("shift").over(by_shift) > F.col("n_windows") / 2
    ran = met.withColumn("shift", shift).withColumn("apart", F.coalesce(apart.cast("int"), F.lit(0)))
    ran = ran.withColumn("run", F.sum("apart").over(by_shift))
    names = F.array(
        F.lit("all"), F.concat(F.lit("run "), F.col("run")), F.concat(F.lit("at "), F.col("shift"))
    )
    return ran.withColumn("occurrence", F.explode(names)).drop("shift", "apart", "run")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_ids (ascending), contaminated for each row of ``docs``.

    Of items that differ in values alone, the smallest id is listed (``item_classes``).
    Null or empty texts hold no window and are clean; repeated rows are judged alike,
    as are rows without doc_id. Items without id or with fewer than ``LEAST_SENTENCE``
    words match nothing. Extra columns are ignored; an empty table gives no rows.
    """
    dirty = leaks(docs, benchmark).groupBy("doc_id", "print").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids")
    )
    rows = docs.select("doc_id", _print())
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.print") == F.col("l.print"))
    out = rows.alias("d").join(dirty.alias("l"), same, "left")
    items = F.coalesce("l.item_ids", F.array().cast("array<long>"))
    return out.select(
        "d.doc_id", F.size(items).cast("long").alias("n_items"), items.alias("item_ids"),
        (F.size(items) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    dirty = leaks(docs, benchmark).select("doc_id", "print").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (
        F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("l.print")
    )
    return docs.alias("d").join(dirty.alias("l"), same, "left_anti")
