"""Toxicity, decontamination and the pipeline."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from helpers_llm import base_spans, near_components
from kinelane.llm import common, decontam, toxicity
from kinelane.llm.queries import ORACLE

CHAIN = ["quality", "toxic"]


@pytest.fixture(autouse=True)
def package_on_executors(spark):
    common.shipped(spark)


def sentences(spark, n=400):
    """Every fifth document holds one of two bad words, or a form of a bad stem."""
    rows, labels = [], []
    for i in range(n):
        words = [f"w{(i * 31 + k * k) % 97}" for k in range(30)] + [f"only{i}"]
        bad = i % 5 == 0
        if bad:
            words.insert(i % 20, ("Rotten!", "vile,", f"grim{i % 7}ly")[i % 3])
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 2), int(bad)))
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_toxicity(spark):
    docs, labels = sentences(spark)
    links = toxicity.train(docs, labels.where("doc_id < 250"), CHAIN)
    out = toxicity.judge(docs, links, CHAIN).join(labels.withColumnRenamed("toxic", "truth"), "doc_id")
    held = out.where("doc_id >= 250").collect()
    assert all(r.toxic == bool(r.truth) for r in held)


def test_given_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (common.table(spark, folder, n) for n in ("documents", "labels"))
    links = toxicity.train(docs, labels, CHAIN)
    out = toxicity.judge(docs, links, CHAIN).join(labels.withColumnRenamed("toxic", "truth"), "doc_id")
    right, wrong = F.expr("toxic and truth = 1"), F.expr("toxic and truth = 0")
    hits, false, bad = out.agg(F.count_if(right), F.count_if(wrong), F.sum("truth")).first()
    assert hits >= 0.7 * bad and false <= 3


@pytest.mark.parametrize("label", [None, 0, 1])
def test_labels_that_teach_nothing(spark, odd_docs, label):
    rows = [(i, 1, label) for i in range(5)] if label is not None else []
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    links = toxicity.train(odd_docs, labels, CHAIN)
    out = toxicity.judge(odd_docs, links, CHAIN)
    assert out.count() == odd_docs.count()
    assert out.where("toxic").count() == (odd_docs.count() if label == 1 else 0)
    assert toxicity.judge(odd_docs.limit(0), links, CHAIN).count() == 0


ITEM = (
    "On Monday the farmer Miller drove 12 km to the market and sold 30 apples to Susan, "
    "then Miller drove 12 km back home with the empty cart and counted the money."
)


def test_templates_with_other_values(spark):
    other = ITEM.replace("Miller", "Baker").replace("12 km", "55 miles").replace("30", "7").replace("Susan", "Anna")
    mixed = ITEM.replace("farmer Miller", "farmer Baker").replace("30", "7").replace("then Miller", "then Smith")
    mixed = mixed.replace("drove 12 km back", "drove 90 km back").replace("drove 12 km to", "drove 8 km to")
    docs = [
        (1, f"Some words before. {ITEM} And more behind it."), (2, f"Intro here.\n{other}"),
        (3, "On a day the farmer went to the market to sell apples and counted the money."),
        (4, None), (5, ""), (6, ITEM.upper()), (None, f"x. {ITEM}"), (1, "clean text of the same id"),
        (7, " ".join(ITEM.split()[:9])), (8, mixed),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("print", F.lit("x"))
    items = spark.createDataFrame(
        [(10, ITEM), (11, "too short"), (None, ITEM), (12, None), (13, "six plain words are enough here")],
        "item_id long, text string",
    )
    rows = decontam.contamination(df, items).collect()
    got = {(r.doc_id, r.contaminated) for r in rows}
    assert len(rows) == len(docs)
    assert got >= {(1, True), (1, False), (2, True), (3, False), (4, False), (5, False), (None, True), (7, False)}
    assert [r.item_ids for r in rows if r.doc_id == 2] == [[10]]
    # Values that disagree within the item speak against it.
    found = {r.doc_id: r.n_found for r in decontam.leaks(df, items).collect()}
    assert found[2] == found[1] and found.get(8, 0) < found[1]
    clean = decontam.clean(df, items)
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect() if r.doc_id not in (6, 8)) == ["1", "3", "4", "5", "7"]
    assert decontam.contamination(df.limit(0), items).count() == 0
    assert decontam.contamination(df, items.limit(0)).where("contaminated").count() == 0


def test_several_versions_of_one_item(spark):
    """A worksheet of versions, each word put in somewhere, is caught like one version."""
    def version(a, b, c, extra=""):
        return (f"Tell how far {a} walked when she made {b} km on {a[::-1].title()} road and {c} km{extra} "
                f"with {b + 1} friends and {c + 2} dogs from {a}ville to {a}stadt in {b * c} hours")

    names = ["Nora", "Lena", "Mira", "Sofi", "Tara", "Ella"]
    docs = [(k, "\n".join(version(n, 11 + 3 * i + k, 50 + 7 * i - k) for i, n in enumerate(names[: 2 + k])))
            for k in range(5)]
    docs += [(9, "\n".join(version(n, 20 + i, 70 - i, " uphill") for i, n in enumerate(names)))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(10, version("Hugo", 5, 9))], "item_id long, text string")
    assert {r.doc_id for r in decontam.leaks(df, items).collect()} == {0, 1, 2, 3, 4, 9}


def test_items_of_few_plain_words(spark):
    """Items of numbers, short ones and unspaced ones: copies, other values, and chance."""
    items = [
        (1, "What is 12 + 30 * 4 - 7 / 2?"), (2, "What is 2 + 3?"), (3, "小明有12个苹果，又买了30个"),
        (4, "Sum 1 2 3 4 5 6 7 8 9 10 11 12"), (5, "7 8 9 10 11 12 13 14 15 16"), (6, "too short"),
    ]
    docs = [
        (0, "A sheet. What is 12 + 30 * 4 - 7 / 2? Next."), (1, "So: what is 5 + 8 * 9 - 3 / 6?"),
        (2, "A sheet.\nWhat is 2 + 3? Five."), (3, "she knows what is 2 3 times that"),
        (4, "前文。小明有55个苹果，又买了70个。后文"), (5, "Sum 1 2 3 4 5 6 7 8 9 10 11 12"),
        (6, "Table 31 32 33 34 35 36 37 38 39 40 41 42"), (7, "x 7 8 9 10 11 12 13 14 15 16"),
        (8, "too short"), (9, "What is it that 12 or 30 people of 4 to 7 years do 2 times"),
    ]
    got = decontam.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {r.doc_id: r.item_ids for r in got} == {
        0: [1], 1: [1], 2: [2], 3: [], 4: [3], 5: [4], 6: [], 7: [5], 8: [], 9: []
    }


def test_items_of_one_template_are_one_class(spark):
    """5,000 items of one template meet a document once; their classes tell who they are."""
    def version(a, b, c):
        return f"How many km does {a} drive if {a} first drives {b} km north and then {c} km back to the town"

    family = [(100 + k, version("Hugo", k, k + 1 + k % 2)) for k in range(5000)]
    same_value = [(7000, version("Hugo", 5, 5)), (6999, version("Emma", 8, 8))]
    sums = [(8000 + k, f"What is {k} + {k + 1} * 4 - 7 / 2?") for k in range(3000)]
    items = spark.createDataFrame(family + same_value + sums, "item_id long, text string")
    docs = [(k, version("Nora", 10 + k, 70 + k)) for k in range(20)] + [
        (30, version("Nora", 6, 6)), (40, "What is 9 + 3 * 6 - 2 / 8?"), (41, "What is 8 + 9 * 4 - 7 / 2?"),
        (50, "nothing of the kind is here, but for the 3 km to the town"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontam.contamination(df, items).collect()}
    # Most windows hold one of the two distances, so either template is found by half of them.
    assert all(got[k] in ([100], [100, 6999]) for k in range(20))
    assert got[30] == [100, 6999] and got[50] == []
    classes = {r.item_id: r.class_id for r in decontam.item_classes(items).collect()}
    assert {classes[i] for i, _ in family} == {100} and classes[7000] == classes[6999] == 6999
    assert {classes[i] for i in got[40]} == {8000} and 8008 in got[41]
    found = decontam._found(df, decontam_hashes(items), [(0, 8), (1, 8), (2, 9)])
    wide = decontam._met(common.stored(found), common.stored(decontam.item_windows(items).distinct()))
    assert wide.count() < 100 * len(docs)


def decontam_hashes(items):
    return decontam.item_windows(items).select("hash").distinct().toPandas()["hash"].to_numpy("int64")


def test_passes_over_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontam, "PASS_WINDOWS", 5)
    df = spark.createDataFrame([(1, ITEM), (2, "other")], "doc_id long, text string")
    items = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    assert [r.doc_id for r in decontam.leaks(df, items).collect()] == [1]


def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.001"
    docs = common.table(spark, folder, "documents")
    benchmark = {r.text for r in common.table(spark, folder, "benchmark").collect()}
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = common.stored(stage(spark, docs, folder))
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == first and set(after) <= set(before) and len(after) == docs.count()
        gone = set(before) - set(after)
        if name == "near_dedup":
            component, _ = near_components({d: r.text for d, r in before.items()})
            assert set(after) == set(component.values())
        elif name == "decontamination":
            assert gone == {d for d in gone if any(b in before[d].text for b in benchmark)}
            assert not any(b in r.text for b in benchmark for r in after.values())
        elif name == "secrets":
            assert not gone and not any(base_spans(r.text) for r in after.values())
            assert all(before[d].text == after[d].text for d in after if not base_spans(before[d].text))
        else:
            assert len(gone) < 0.3 * len(before)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_entry_names():
    names = entry.queries()
    assert sum(n.startswith("op") for n in names) == 13 and "pipeline" in names
    assert "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    """The query over given tables, and its SQL over the same."""
    folder = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    result = entry.queries()[name](spark, folder)
    twin = duck.sql(ORACLE[name])
    assert sorted(twin.columns) == sorted(result.columns)
    picked = ", ".join(sorted(result.columns))
    expected = twin.query("t", f"SELECT {picked} FROM t").fetchall()
    actual = [tuple(r) for r in result.select(*sorted(result.columns)).collect()]
    assert sorted(actual, key=str) == sorted(expected, key=str)
    duck.close()
