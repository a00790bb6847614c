"""Spelling variants, the piece codec and the manifest against plain versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers_llm import lower
from kinelane.llm import manifest, piece_codec, spelling

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- spelling variants -----------------------------------------------------------------


def plain_vocabulary(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                place = h % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain_variants(vocab):
    near, alike = defaultdict(set), defaultdict(set)
    for word in vocab:
        for i in range(len(word)):
            alike[word[:i], word[i + 1 :]].add(word)
            shorter = word[:i] + word[i + 1 :]
            if shorter in vocab:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in alike.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word, n in vocab.items():
        best = min(near[word], key=lambda w: (-vocab[w], w), default=None)
        form[word] = best if best is not None and vocab[best] >= 5 * n else None

    def root(word):
        while form[word] is not None:
            word = form[word]
        return word

    return sorted(
        (w, form[w], root(w), n, len(near[w]), vocab.get(form[w])) for w, n in vocab.items()
    )


def variants_of(spark, texts):
    return spark.createDataFrame(texts, "doc_id long, text string")


def check_variants(df):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    vocab = plain_vocabulary(docs)
    got = sorted((tuple(r) for r in spelling.variants(df).collect()))
    assert got == plain_variants(vocab)
    return got


def test_variants_of_given_and_odd_texts(small_docs, odd_docs):
    assert any(form for _, form, *_ in check_variants(small_docs))
    check_variants(odd_docs.unionByName(odd_docs.select(*odd_docs.columns)))


def test_all_kinds_of_edits_and_chains(spark):
    """Inserted, deleted, replaced at both ends; a chain of forms; ties; letters beyond a-z."""
    counts = {
        "streets": 700, "street": 130, "streetz": 26, "xtreetz": 5, "treets": 5, "streetss": 5,
        "stroets": 6, "größere": 40, "grössere": 5, "größ÷re": 5, "ÀÈÌÒÙÝÞ": 30, "ÀÈÌÒÙÝß": 6,
        "aaaaaa": 25, "aaaaaaa": 125, "abcdef": 25, "abcdeg": 25, "abcdeh": 5, "lonely": 9, "seldom": 4,
    }
    texts = [(1000 + i, f"{w}") for w, n in counts.items() for i in range(n)]
    got = {r[0]: r for r in check_variants(variants_of(spark, texts))}
    assert got["xtreetz"][1:3] == ("streetz", "streets")
    assert got["abcdeh"][1] == "abcdef" and got["lonely"][1:3] == (None, "lonely")
    assert "seldom" not in got and "ÀÈÌÒÙÝÞ" in got


def test_long_words_and_crowded_filters(spark, monkeypatch):
    """Words of thousands of letters, and filters so full that they claim most edits."""
    monkeypatch.setattr(spelling, "MOST_BLOCKS", 4)
    monkeypatch.setattr(spelling, "PLACES", 100)
    monkeypatch.setattr(spelling, "TASK_WORDS", 7)
    long = "abcdefghij" * 70
    words = [long, long[:-1], "b" + long[1:], long[:300] + "z" + long[300:], "x" * 260, "x" * 259]
    words += [f"word{chr(97 + i)}{chr(97 + j)}{chr(97 + (i * j) % 7)}" for i in range(9) for j in range(9)]
    texts = [(i, " ".join(words)) for i in range(30)]
    got = check_variants(variants_of(spark, texts))
    assert len(got) > 80


def test_no_words_give_no_rows(spark, no_docs):
    assert spelling.variants(no_docs).count() == 0
    assert spelling.variants(variants_of(spark, [(1, None), (2, "a b c")])).count() == 0


def test_filters_never_miss_and_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BLOCKS", 64)
    words = [f"{chr(97 + i % 26)}{'abc' * (1 + i % 5)}{i}" for i in range(4000)]
    words = [re.sub("[0-9]", lambda m: "klmnopqrst"[int(m[0])], w) for w in words]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    shards, bits = spelling.filters(df)
    assert len(bits) == shards.blocks.sum() <= 64 + spelling.LAST_SHARD
    codes = spelling._codes(words)
    total = spelling._sum_before(spelling._factor(codes.place, codes.code))
    sums = total[codes.first + codes.lengths] - total[codes.first]
    assert len(spelling._claimed(bits, shards, sums, codes.lengths)) == len(words)


# --- the piece codec --------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def agenda():
    return piece_codec.Agenda(MODEL)


@pytest.mark.parametrize("which", ["small", "odd"])
def test_ids_and_texts_are_the_librarys(which, small_docs, odd_docs, library):
    df = small_docs if which == "small" else odd_docs
    texts = [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]
    wanted = [(d, library.encode(t), 0, library.decode(library.encode(t))) for d, t in texts]
    trips = piece_codec.round_trip(df, MODEL)
    got = [(r.doc_id, list(r.ids), r.n_unlike, r.decoded) for r in trips.collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    back = piece_codec.decoded(piece_codec.encoded(df, MODEL), MODEL).collect()
    assert sorted((r.doc_id, r.text) for r in back if r.doc_id is not None) == sorted(
        (d, text) for d, _, _, text in wanted if d is not None
    )


def test_digests(spark, odd_docs, no_docs, library):
    got = {r.doc_id: r for r in piece_codec.digests(piece_codec.round_trip(odd_docs, MODEL)).collect()}
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for doc_id, row in got.items():
        ids = library.encode(texts[doc_id])
        assert (row.n_tokens, row.ids_sha256) == (len(ids), digest(",".join(map(str, ids))))
        assert row.decoded_sha256 == digest(library.decode(ids))
    assert piece_codec.round_trip(no_docs, MODEL).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in piece_codec.decoded(nothing, MODEL).collect()] == ["", ""]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(
    st.sampled_from(list(" ▁ \n\t.,aeinorst'0123éß漢​ �")), st.characters(exclude_categories=["Cs"])
), max_size=60))
def test_any_text(agenda, library, text):
    flat, counts, unlike = agenda.encode([text, "", text])
    ids = library.encode(text)
    assert flat.tolist() == ids * 2 and counts.tolist() == [len(ids), 0, len(ids)]
    assert unlike.sum() == 0


def test_agenda_alone_and_a_full_memory(library, monkeypatch):
    """The merges themselves, without the library's word, also when chunks are forgotten."""
    monkeypatch.setattr(piece_codec, "CACHE_CHUNKS", 3)
    small = piece_codec.Agenda(MODEL)
    texts = ["international  understanding", " " * 33, "aaaaaaaaaaaaaaaaab", "mañana über", "a b c d e f"]
    for text in texts * 2:
        ids = [i for chunk in small.chunks([text])[0] for i in small.chunk_ids(chunk)]
        assert ids == library.encode(text) == small.encode([text])[0].tolist()


def test_unlike_chunks_are_told_and_mended(library, monkeypatch):
    wrong = piece_codec.Agenda(MODEL)
    monkeypatch.setattr(wrong, "merged", lambda chunk: list(chunk))
    flat, _, unlike = wrong.encode(["hello world"])
    assert flat.tolist() == library.encode("hello world") and unlike.tolist() == [2]


# --- the manifest -----------------------------------------------------------------------


def plain_tree(digests):
    """The root of some digests and each one's siblings, level by level."""
    paths, places = [[] for _ in digests], list(range(len(digests)))
    while len(digests) > 1:
        for k, place in enumerate(places):
            first = place - place % 8
            paths[k].append(("".join(digests[first:place]), "".join(digests[place + 1 : first + 8])))
            places[k] = place // 8
        digests = [digest("".join(digests[i : i + 8])) for i in range(0, len(digests), 8)]
    return digests[0], paths


def plain_leaf(row, text):
    values = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append((row.doc_id is not None, row.doc_id or 0, plain_leaf(row, row.text), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda entry: entry[:3])
        trees[name] = plain_tree([entry[2] for entry in groups[name]])
    root, above = plain_tree([trees[name][0] for name in names]) if names else (None, [])
    out = []
    for name, upper in zip(names, above):
        for (_, _, leaf, row), path in zip(groups[name], trees[name][1]):
            node = leaf
            if row.doc_id is not None and row.text is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                node = plain_leaf(row, lower(row.text))
            for left, right in path + upper:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path + upper))
            out.append((row.doc_id, leaf, trees[name][0], root, proof, node, node == root))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def check_manifest(df):
    got = [tuple(r) for r in manifest.verified(df).select(*COLUMNS).collect()]
    assert sorted(got, key=repr) == plain_manifest(df.collect())
    return got


@pytest.mark.parametrize("which", ["small", "odd"])
def test_manifest(which, small_docs, odd_docs):
    got = check_manifest(small_docs if which == "small" else odd_docs)
    assert any(row[-1] for row in got)


@pytest.mark.parametrize("sizes", [[1], [8, 1], [9, 64, 65, 7], [1] * 11 + [3]])
def test_runs_of_all_lengths(spark, sizes):
    """Lone leaves, full and broken runs, more groups than a run, a language that is empty."""
    rows = [
        (1000 * g + i, f"Text {i} of {g}", None if g == 2 else "" if g == 1 else f"l{g}ü", None, i)
        for g, n in enumerate(sizes) for i in range(n)
    ]
    check_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))


def test_repeated_and_missing_ids(spark, no_docs):
    """One row many times, one id with many texts, rows without anything."""
    rows = [(5, "Same TEXT", "en", "s", 9)] * 40 + [(6, f"Other {i}", "en", None, None) for i in range(20)]
    rows += [(None, None, None, None, None)] * 3 + [(None, "No id", "en", "s", 1)]
    check_manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert manifest.verified(no_docs).count() == 0


def test_any_change_breaks_a_proof(small_docs):
    proofs = manifest.proofs(small_docs).limit(20)
    good = proofs.select(manifest.folded(F.col("digest"), F.col("path")).alias("f"), "root").collect()
    assert all(r.f == r.root for r in good)
    other = F.concat(F.lit("0"), F.substring("digest", 1, 63))
    bad = proofs.where(other != F.col("digest")).select(
        manifest.folded(other, F.col("path")).alias("f"), "root"
    ).collect()
    assert bad and all(r.f != r.root for r in bad)
