"""Operators over documents against plain versions, on given and on odd texts."""

import hashlib
import os
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers_llm import base_spans, near_components, quality
from kinelane.llm import common, huffman, near_dedup, packing, quality_rules, secret_scan, token_counts
from kinelane.llm import tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"
BYTE, WORD = (str(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    common.shipped(spark)


def ids_of(path, texts):
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids for e in encoded]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(params=["small", "odd"])
def docs(request, small_docs, odd_docs):
    return small_docs if request.param == "small" else odd_docs


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_near_groups(docs):
    texts = {d: t for d, t in collected(docs) if d is not None}
    component, sizes = near_components(texts)
    rows = near_dedup.near_groups(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        if row.doc_id is None:
            assert row.component_id is None and row.kept
        else:
            assert row.n_shingles == sizes[row.doc_id]
            assert row.component_id == component[row.doc_id]
            assert row.kept == (row.doc_id == row.component_id)


def test_near_groups_in_many_blocks(spark, monkeypatch):
    """A chain of edits: neighbours are linked, ends are not, and blocks are tiny."""
    monkeypatch.setattr(near_dedup, "BUCKET_BLOCK", 3)
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", 4)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for step in range(24):
        texts.append(" ".join(words))
        words[5 * step] = f"new{step}"
    texts += ["nothing alike here at all, not one bit"] * 9
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    component, _ = near_components(dict(enumerate(texts)))
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df).collect()}
    assert got == component
    assert set(got.values()) == {0, 24}
    kept = near_dedup.one_of_each_group(df.withColumn("rep", F.lit(1)))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 24] and kept.columns == [*df.columns, "rep"]


def test_links_from_a_given_threshold_on(spark):
    """Pairs at 0.79, 0.80 and 0.84 by five-word shingles, and one at 0.90."""
    texts = {}
    for pair, (n, changed) in enumerate([(204, 23), (184, 20), (204, 17), (194, 10)]):
        words = [f"p{pair}w{k}" for k in range(n)]
        texts[2 * pair] = " ".join(words)
        texts[2 * pair + 1] = " ".join(words[: n - changed] + [f"q{pair}w{k}" for k in range(changed)])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = {r.doc_id for r in near_dedup.one_of_each_group(df, 80).collect()}
    assert left == {0, 1, 2, 4, 6}
    assert sorted(r.doc_id for r in near_dedup.near_groups(df).where("not kept").collect()) == [7]
    assert (near_dedup.band_rows(85), near_dedup.band_rows(80)) == (6, 5)


def test_estimates_follow_similarity():
    rng = np.random.default_rng(3)
    agreeing = rng.binomial(near_dedup._PERMS, 0.85 * 15 / 16 + 1 / 16, 2000)
    assert abs(near_dedup.estimated(agreeing).mean() - 0.85) < 0.01
    assert (agreeing < near_dedup._least_agreement()).mean() < 0.001


def test_secrets(docs):
    rows = secret_scan.scan(docs).collect()
    texts = sorted(collected(docs), key=str)
    assert len(rows) == len(texts)
    expected = sorted(
        (str(d), hashlib.sha256(",".join(base_spans(t)).encode()).hexdigest()) for d, t in texts
    )
    assert sorted((str(r.doc_id), r.base_sha256) for r in rows) == expected
    for row in rows:
        spans = [s.split(":")[0] for s in row.spans.split(",")]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(
            spans.count(k) for k in ("assign", "access", "hex")
        )


def test_secrets_in_odd_places(spark):
    hexes, pem = "0123456789abcdef" * 2, "-----BEGIN RSA PRIVATE KEY-----"
    texts = [
        f"PassWord:'{hexes}' é 🙂 AKIA{'Z' * 16}", f"{pem} then ghp_{'a1' * 20}", "tokentoken==abcdef",
        "api_key = short", "apikey=" + "x" * 100_000, f"{hexes}G{hexes}", "secret:abcdef token:abcdef " * 300,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.scan(df).collect()}
    for number, text in enumerate(texts):
        spans = got[number].spans.split(",")
        base = [s for s in spans if s.split(":")[0] in ("assign", "access", "hex")]
        assert base == base_spans(text) or (base == [] and base_spans(text) == [])
    assert got[1].spans.startswith("private:0:31,hosted:37:")
    clean = {r.doc_id: r.text for r in secret_scan.redacted(df).collect()}
    assert clean[0] == "[SECRET]' é 🙂 [SECRET]" and clean[1] == "[SECRET] then [SECRET]"
    assert clean[3] == texts[3]
    assert all(not base_spans(t) for t in clean.values())


def test_many_secrets_in_one_text(spark):
    """A text of 100,000 matches, kinds that overlap, and chunk borders within and between."""
    key = "0123456789abcdef" * 2
    texts = [
        "password=abcdefg é🙂 " * 100_000, f"token={key}{'z' * 7} " * 3000,
        *("漢" * n + f"secret={key}\n" + "é" * (2048 - n) + key for n in (1000, 1010, 1023, 1024, 2047)),
        "\n" * 5000 + key, key + "x" * 1024,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: r.spans.split(",") for r in secret_scan.scan(df).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(df).collect()}
    assert time.monotonic() - began < 120
    for number, text in enumerate(texts):
        assert got[number] == base_spans(text)
        out, at = [], 0
        for _, first, last in (s.split(":") for s in got[number]):
            if int(first) >= at:
                out += [text[at:int(first)], "[SECRET]"]
            at = max(at, int(last))
        assert clean[number] == "".join(out) + text[at:]


def test_redaction_keeps_rows_and_columns(odd_docs):
    out = secret_scan.redacted(odd_docs)
    assert out.columns == odd_docs.columns and out.schema == odd_docs.schema
    assert out.count() == odd_docs.count()
    row = out.where("doc_id = 12").first()
    assert row.text == "[SECRET] and \ufdd0 [SECRET]'" and row.n_chars == len(row.text)


def test_trigram_queries():
    assert secret_scan.trigram_query(r"[0-9a-f]{24,}") is None
    assert secret_scan.trigram_query("ab") is None
    assert secret_scan.trigram_query("abcd") == {frozenset({"abc", "bcd"})}
    assert secret_scan.trigram_query("(abc|xyz)[a-z]+tail") == {
        frozenset({"abc", "tai", "ail"}), frozenset({"xyz", "tai", "ail"})
    }
    assert secret_scan.trigram_query("(abc)*def") == {frozenset({"def"})}
    assert secret_scan.trigram_query("(abc)?def") is not None


def test_quality(docs):
    texts = collected(docs)
    rows = quality_rules.judge(docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((str(r.doc_id), *(r[n] for n in names)) for r in rows)
    assert got == sorted((str(d), *quality(t)) for d, t in texts)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and not r.host_failed)


def test_bad_hosts_fall_and_small_ones_are_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(h * 100 + i, good, f"good{h}") for h in range(8) for i in range(30)]
    rows += [(2000 + i, "bad words", "bad") for i in range(28)] + [(2100 + i, good, "bad") for i in range(2)]
    rows += [(3000, "bad words", "tiny"), (3001, good, "tiny")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    assert out[2100].host_failed and not out[2100].base_failed and not out[2100].kept
    assert out[3001].kept and out[0].kept


def test_token_counts(docs):
    texts = collected(docs)
    rows = token_counts.counted(docs, BYTE).collect()
    ids = ids_of(BYTE, [t for _, t in texts])
    expected = sorted(
        (str(d), len((t or "").encode()), len(i), len(i) > 1024) for (d, t), i in zip(texts, ids)
    )
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == expected


def test_id_files(docs):
    rows = huffman.round_trip(docs, BYTE).collect()
    texts = collected(docs)
    ids = [i + [2] for i in ids_of(BYTE, [t for _, t in texts])]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (str(d), len(i), crc(i)) for (d, _), i in zip(texts, ids)
    )
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d))


@pytest.mark.parametrize("with_ids", [False, True])
def test_packing(docs, with_ids):
    rows = packing.pack(docs, WORD, with_ids=with_ids).collect()
    texts = collected(docs)
    expected = []
    for (d, _), ids in zip(texts, ids_of(WORD, [t for _, t in texts])):
        ids = ids + [0]
        for first in range(0, len(ids), 2048):
            part = ids[first : first + 2048]
            expected.append((str(d), first // 2048, first, len(part), crc(part)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
        assert not with_ids or crc(row.ids) == row.ids_crc32
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_no_documents(no_docs):
    for made in (
        near_dedup.near_groups(no_docs), secret_scan.scan(no_docs), secret_scan.redacted(no_docs),
        quality_rules.judge(no_docs), token_counts.counted(no_docs, BYTE),
        huffman.round_trip(no_docs, BYTE), packing.pack(no_docs, WORD),
    ):
        assert made.count() == 0


def test_plans_use_all_pieces_and_fill_rows():
    rng = np.random.default_rng(5)
    for _ in range(20):
        length = int(rng.integers(4, 120))
        histogram = {int(a): int(b) for a, b in zip(rng.integers(1, length + 1, 20), rng.integers(1, 500, 20))}
        used = defaultdict(int)
        for pattern, rows in packing.plan(histogram, length):
            assert rows > 0 and sum(pattern) <= length
            for size in pattern:
                used[size] += rows
        assert used == histogram
    exact = packing.plan({60: 10, 40: 7, 25: 3, 15: 3}, 100)
    assert sum(rows for _, rows in exact) == 10


def test_best_fit_of_hot_lengths():
    """As many rows as when pieces without complement are placed one by one."""
    def one_by_one(left, length):
        rooms = []
        for size in sorted((s for s, n in left.items() for _ in range(n)), reverse=True):
            fits = [r for r in rooms if r >= size]
            if fits:
                rooms.remove(min(fits))
            rooms.append(min(fits, default=length) - size)
        return len(rooms)

    assert sum(rows for _, rows in packing.plan({1100: 1000, 300: 3000}, 2048)) == 1000
    rng = np.random.default_rng(3)
    for length in (50, 97, 128):
        for _ in range(20):
            sizes = rng.choice(np.arange(2, length), rng.integers(1, 9), replace=False)
            left = {int(s): int(rng.integers(1, 60)) for s in sizes}
            found = packing._best_fit(left, length)
            held = {s: sum(p.count(s) * n for p, n in found) for s in left}
            assert held == left and all(sum(p) <= length and n > 0 for p, n in found)
            assert sum(n for _, n in found) == one_by_one(left, length)


def test_codes_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 300):
        counts = (rng.pareto(1.0, n) * 10).astype(np.int64) + 1
        lengths = huffman.code_lengths(counts)
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            heapq.heappush(heap, pair := heapq.heappop(heap) + heapq.heappop(heap))
            cost += pair
        assert n == 1 or int((lengths * counts).sum()) == cost
    steep = huffman.code_lengths(np.array([2**i for i in range(40)]), 6)
    assert steep.max() == 6 and (2.0 ** -steep.astype(float)).sum() <= 1


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_cached_pieces_give_the_librarys_ids(path, spaced, monkeypatch):
    import random

    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    alphabet = ["a", "b", "'", "'s", " ", "  ", "\n", "\t", "'re", "'ll", "S", "é", "Ê", "×", "5", "12", ".", "!",
                "<|endoftext|>", "<|", "漢", "e\u0301", "\x1c", "\xa0", "ſ", "İ", "_", "\x00", "ß"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 12))) for _ in range(1500)]
    import pyarrow as pa

    encoder = tokens.Encoder(path, spaced)
    data, offsets = common.utf8(pa.array(texts))
    found = []
    for first, last in common.slices(offsets, 500):
        part = data[offsets[first] : offsets[last]]
        flat, counts = encoder.ids(part, offsets[first : last + 1] - offsets[first])
        found += [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]
    assert found == ids_of(path, texts)


def thue_morse(n):
    """Two different words of two letters that cancel out in sums of powers."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_sums_of_powers_mistake(spark):
    """Different words of one hash in a plain polynomial are different everywhere."""
    one, other = thue_morse(1024)
    pairs = [thue_morse(n) for n in (8, 64, 512, 2048, 4096)]
    for a, b in [(one, other), *pairs]:
        data = np.frombuffer((a + b).encode(), np.uint8)
        at = np.array([0, len(a)])
        assert len(set(common.range_hashes(data, at, at + len(a)).tolist())) == 2
    texts = [one, other, f"{one} {one[::-1]}", f"{other} {one[::-1]}", *[t for p in pairs for t in p]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dedup.near_groups(df).collect()}
    assert got == near_components(dict(enumerate(texts)))[0]
    ids = ids_of(BYTE, texts)
    assert {r.doc_id: r.n_tokens for r in token_counts.counted(df, BYTE).collect()} == {
        i: len(x) for i, x in enumerate(ids)
    }
    assert {r.doc_id: r.ids_crc32 for r in huffman.round_trip(df, BYTE).collect()} == {
        i: crc(x + [2]) for i, x in enumerate(ids)
    }


def test_pieces_of_one_hash(monkeypatch):
    """Pieces that share a hash are told apart by their bytes."""
    monkeypatch.setattr(common, "range_hashes", lambda data, a, b: np.zeros(len(a), np.uint64))
    monkeypatch.setattr(tokens, "PROVEN", 0)
    encoder = tokens.Encoder(BYTE, True)
    texts = ["one two three two one" + " x" * 400, "two " + "y" * 600, "three one", "y" * 599 + "z"]
    data, offsets = common.utf8(pa.array(texts))
    flat, counts = encoder.ids(data, offsets)
    assert np.split(flat, np.cumsum(counts)[:-1])[0].tolist() == ids_of(BYTE, texts)[0]
    assert flat.tolist() == [i for ids in ids_of(BYTE, texts) for i in ids]


def test_ranges_are_the_same_only_byte_by_byte():
    data = np.frombuffer(b"abcdefghij" * 200, np.uint8)
    other = data.copy()
    other[1900] ^= 1
    starts, sizes = np.array([0, 10, 0, 1896, 1896]), np.array([2000, 600, 0, 4, 5])
    assert common.same_ranges(data, starts, sizes, other, starts).tolist() == [False, True, True, True, False]


def test_one_id_on_most_rows(spark):
    """Rows of one id may be dealt to several parts; each has a place of its own in the files."""
    rows = [(7, f"row {i} " * (1 + i % 5)) for i in range(300)] + [(i, "other") for i in range(20)] + [(None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(huffman.round_trip(df, BYTE).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    wanted = [(d, len(i) + 1, crc(i + [2])) for (d, _), i in zip(rows, ids_of(BYTE, [t for _, t in rows]))]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in got)
