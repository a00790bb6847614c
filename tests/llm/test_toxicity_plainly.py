"""The chain of classifiers against a plain refit on the same labelled rows."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from kinelane.llm import common, toxicity

CHAIN = ["quality", "toxic"]
WORD = re.compile(rb"[A-Za-z\x80-\xff]+")


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    common.shipped(spark)


def features(text):
    """The set of words and word beginnings, and four counts of the text."""
    data = (text or "").encode()
    words = [w.lower() for w in WORD.findall(data)]
    found = {("word", w) for w in words}
    found |= {("beginning", w[:k]) for w in words for k in toxicity.BEGINNINGS if len(w) > k}
    letters, capitals = sum(map(len, words)), len(re.findall(rb"[A-Z]", data))
    signs = max(len(data), 1) - letters - len(re.findall(rb"[\x20\x09-\x0D]", data))
    counts = [
        math.log1p(len(words)) / 5, capitals / max(letters, 1), signs / max(len(data), 1),
        letters / max(len(words), 1) / 10,
    ]
    return found, counts


def shingles(text):
    words = [w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)}


def without_copies(rows):
    kept = []
    for doc, text in sorted(rows.items()):
        own = shingles(text)
        alike = (len(own & s) / len(own | s) for _, s in kept if own and s)
        if not any(share >= toxicity.COPY for share in alike):
            kept.append((doc, own))
    return [doc for doc, _ in kept]


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def refit(x, y):
    """Logistic coefficients with squared ones weighed, the constant hardly."""
    weight = np.diag([1e-6] + [toxicity.RIDGE] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])

    def loss(at):
        return np.logaddexp(0, x @ at).sum() - y @ (x @ at) + at @ weight @ at / 2

    for _ in range(300):
        p = sigmoid(x @ w)
        slope = x.T @ (p - y) + weight @ w
        if np.abs(slope).max() < 1e-10:
            break
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + weight, slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-9:
            size /= 2
        w = w - size * step
    return w


def telling(sets, y):
    n, positive = len(y), y.sum()
    tally = {}
    for found, label in zip(sets, y):
        for f in found:
            a, k = tally.get(f, (0, 0))
            tally[f] = a + 1, k + label
    tally = {f: v for f, v in tally.items() if v[0] >= 3}
    bar = 2 * math.log(max(len(tally), 2)) - toxicity.SLACK

    def part(count, expected):
        return count * math.log(count / expected) if count > 0 else 0.0

    rate = positive / n
    ratio = {f: 2 * (part(k, a * rate) + part(a - k, a * (1 - rate))) for f, (a, k) in tally.items()}
    return [f for f, r in ratio.items() if r > bar]


def plainly(docs, labels):
    """Probabilities of the chain for each text."""
    labelled = [d for d in without_copies({d: docs[d] for d in labels if d in docs})]
    read = {d: features(t) for d, t in docs.items()}
    fold = common.mixed(np.array(labelled, np.int64).view(np.uint64)) % np.uint64(toxicity.FOLDS)
    before, scores = [], {d: [] for d in docs}
    for number, _ in enumerate(CHAIN):
        y = np.array([labels[d][number] for d in labelled], float)
        words = telling([read[d][0] for d in labelled], y)
        assert len(words) < toxicity.WORDS

        def row(d, earlier):
            return [1.0, *read[d][1], *earlier, *(float(w in read[d][0]) for w in words)]

        x = np.array([row(d, [b[i] for b in before]) for i, d in enumerate(labelled)])
        w = refit(x, y)
        unseen = np.zeros(len(y))
        for k in range(toxicity.FOLDS):
            unseen[fold == k] = sigmoid(x[fold == k] @ refit(x[fold != k], y[fold != k]))
        before.append(unseen)
        for d in docs:
            scores[d].append(float(sigmoid(np.array(row(d, scores[d])) @ w)))
    return scores


def made_up():
    docs, labels = {}, {}
    for i in range(240):
        words = [f"w{random.Random(100 * i + k).randrange(89)}" for k in range(30)] + [f"only{i}", "Zuß" * (i % 3)]
        if i % 5 == 0:
            words.insert(i % 20, ("Rotten!", "vile,", f"grim{i % 7}ly")[i % 3])
        if i % 2:
            words.insert(3, "splendid")
        docs[i], labels[i] = " ".join(words), (i % 2, int(i % 5 == 0))
    docs |= {i + 1000: docs[i] + " end" for i in range(20)}
    labels |= {i + 1000: (1, 1) for i in range(20)}
    return docs | {2000: "", 2001: None, 2002: "ROTTEN rotten"}, {d: v for d, v in labels.items() if d != 7}


@pytest.mark.parametrize("given", [False, True])
def test_probabilities_of_a_plain_refit(spark, given):
    """Made-up texts with clear copies (similarity is estimated), and the whole given table."""
    if given:
        folder = "/root/testdata/sf0.001"
        docs = {r.doc_id: r.text for r in common.table(spark, folder, "documents").collect()}
        labels = {r.doc_id: (r.quality, r.toxic) for r in common.table(spark, folder, "labels").collect()}
    else:
        docs, labels = made_up()
    texts = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    marks = spark.createDataFrame([(d, *v) for d, v in labels.items()], "doc_id long, quality int, toxic int")
    expected = plainly(docs, labels)
    found = toxicity.judge(texts, toxicity.train(texts, marks, CHAIN), CHAIN).collect()
    assert len(found) == len(docs)
    for r in found:
        assert (r.p_quality, r.p_toxic) == pytest.approx(expected[r.doc_id], abs=1e-6)
        assert r.toxic == (r.p_toxic >= toxicity.THRESHOLD)
