"""Decontamination against a plain version: every window of every item in every text."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pyarrow as pa

from kinelane.llm import common, decontam

WORD = re.compile(r"[A-Za-z]+|[0-9]+")
UNITS = set(decontam.UNITS)


def read(text):
    """(own, shape, is placeholder, begins, closes) of each word of a text in plain letters."""
    out, last, was_number = [], None, False
    for match in WORD.finditer(text):
        word, own = match[0], match[0].lower()
        begins = last is None or any(c in ".!?\n\r" for c in text[last : match.start()])
        number = word.isdigit()
        name = not begins and len(word) > 1 and word[0].isupper() and not word[1].isupper()
        shape = "N" if number else "U" if was_number and own in UNITS else "A" if name and not number else own
        if out and begins:
            out[-1][4] = True
        out.append([own, shape, shape in ("N", "U", "A"), begins, True])
        if len(out) > 1 and not begins:
            out[-2][4] = False
        last, was_number = match.end(), number
    return out


def windows(words, how, size):
    """(place, key, placeholders) of each window that may be found this way."""
    for at in range(len(words) - size + 1):
        part = words[at : at + size]
        plain = sum(not w[2] for w in part)
        if how == "plain" and plain >= 4 or how == "whole" and plain >= 2:
            yield at, (how, *(w[1] for w in part)), [at + i for i, w in enumerate(part) if w[2]]
        elif how == "equal" and plain < 4 or how == "sentence" and part[0][3] and part[-1][4]:
            yield at, (how, *(w[0] for w in part)), []


def windows_of_item(words):
    n, out = len(words), []
    if n >= 5:
        out += [*windows(words, "plain", min(n, 8)), *windows(words, "equal", min(n, 8))]
        if not any(key[0] == "plain" for _, key, _ in out):
            out += windows(words, "whole", n)
    elif n >= 3:
        out += windows(words, "sentence", n)
    first = {}
    for place, word in enumerate(words):
        first.setdefault(word[0], place)
    return [(at, key, tuple(first[words[p][0]] for p in slots)) for at, key, slots in out]


def hashed(word):
    data, offsets = common.utf8(pa.array([word]))
    return int(common.range_hashes(data, offsets[:-1], offsets[1:]).view("int64")[0])


def leaks(met, n_windows, n_plain):
    """Whether windows (at, key, item slots, place in the text, its values) are an item."""
    occurrences, run, last = defaultdict(list), 0, None
    for window in sorted(met, key=lambda w: w[3] - w[0]):
        shift = window[3] - window[0]
        run += last is not None and shift - last > n_windows / 2
        last = shift
        for name in ("all", ("run", run), ("at", shift)):
            occurrences[name].append(window)
    for part in occurrences.values():
        values = defaultdict(Counter)
        for _, _, slots, _, ours in part:
            for slot, value in zip(slots, ours):
                values[slot][value] += 1
        agreed = {s: max(c, key=lambda v: (c[v], hashed(v))) for s, c in values.items()}
        fit = [w for w in part if all(agreed[s] == v for s, v in zip(w[2], w[4]))]
        found, plain = {w[0] for w in fit}, {w[0] for w in fit if w[1][0] == "plain"}
        if any(w[1][0] in ("whole", "sentence") for w in fit) or n_plain and 2 * len(plain) >= n_plain:
            return True
        if fit and 2 * len(found) >= n_windows:
            return True
    return False


def plainly(docs, items):
    """item ids of each text."""
    cut = {i: windows_of_item(read(text)) for i, text in items.items()}
    free_of = {i: frozenset(w for w in ws if w[1][0] in ("plain", "whole")) for i, ws in cut.items()}
    sizes = {
        i: (len({w[0] for w in ws}), len({w[0] for w in ws if w[1][0] == "plain"})) for i, ws in cut.items()
    }
    first_free, first_whole = {}, {}
    for i in sorted(items):
        first_free.setdefault((free_of[i], sizes[i]), i)
        first_whole.setdefault((frozenset(cut[i]), sizes[i]), i)
    forms = {(key[0], len(key) - 1) for ws in cut.values() for _, key, _ in ws}
    wanted = {key for ws in cut.values() for _, key, _ in ws}
    out = {}
    for doc, text in docs.items():
        words, here = read(text or ""), defaultdict(list)
        for how, size in forms:
            for at, key, slots in windows(words, how, size):
                if key in wanted:
                    here[key].append((at, tuple(words[p][0] for p in slots)))

        def is_in(i, own):
            met = [(at, key, slots, *place) for at, key, slots in own for place in here.get(key, ())]
            return bool(met) and leaks(met, *sizes[i])

        found = set()
        for (own, _), i in first_free.items():
            if own and is_in(i, own):
                found.add(i)
        for (own, _), i in first_whole.items():
            if any(key[0] in ("equal", "sentence") and key in here for _, key, _ in own) and is_in(i, own):
                found.add(i)
        out[doc] = sorted(found)
    return out


QUESTIONS = [
    "A train runs 60 km in 2 hours. How far does the train of Anna run in 5 hours?",
    "A train runs 80 km in 4 hours. How far does the train of Berta run in 9 hours?",
    "What is 12 + 30 * 4 - 7 / 2?",
    "Who wrote the play Faust?",
    "Add 4 and 5 now",
    "the cat and the dog sat on the mat while the bird sang to the cat of old Mister Smith",
    "one two",
    "",
]


def varied(text, step):
    return re.sub("[0-9]+", lambda m: str(int(m[0]) + step), text)


def made_up(items):
    out = []
    for n, text in enumerate(items):
        words = text.split()
        out += [
            text, f"Before it. {text} After it.", varied(text, 7), text.replace("Anna", "Carla"),
            " ".join(words[: len(words) // 2]), " ".join(words[::-1]),
            f"{varied(text, 1)}\nand then\n{varied(text, 3)}\nand again {varied(text, 5)}",
            re.sub("[0-9]+", lambda m: str(m.start()), text),
            " ".join([*words[:9], "well", *words[9:]]), f"{text} {items[n - 1]}",
        ]
    return out


def same(spark, docs, items):
    rows = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    asked = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontam.contamination(rows, asked).collect()
    expected = plainly(docs, items)
    assert {r.doc_id: list(r.item_ids) for r in found} == expected
    assert all(r.n_items == len(r.item_ids) and r.contaminated == bool(r.item_ids) for r in found)
    return expected


def test_made_up_texts(spark):
    expected = same(spark, dict(enumerate(made_up(QUESTIONS))), dict(enumerate(QUESTIONS)))
    assert {i for ids in expected.values() for i in ids} >= {0, 2, 3, 4, 5}


def test_given_documents(spark):
    """The whole table, and versions of its benchmark, in plain letters."""
    folder = "/root/testdata/sf0.001"

    def plain_letters(text):
        return re.sub("[^\x00-\x7f]", "x", text or "")

    items = {r.item_id: plain_letters(r.text) for r in common.table(spark, folder, "benchmark").collect()}
    docs = {r.doc_id: plain_letters(r.text) for r in common.table(spark, folder, "documents").collect()}
    docs |= {10**6 + n: text for n, text in enumerate(made_up(list(items.values())[:20]))}
    expected = same(spark, docs, items)
    assert any(ids for doc, ids in expected.items() if doc < 10**6)
