"""From documents to packed training sequences, in stages that are each written out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinelane.llm import decontam, near_dedup, packing, secret_scan, toxicity
from kinelane.llm.common import shipped, stored, table
from kinelane.llm.queries import CATEGORIES

#: Hundredths of five-word shingles from which on two documents are near copies.
NEAR_PERCENT = 85

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain of classifiers does not reject; it learns from them."""
    shipped(spark)
    links = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.judge(docs, links, CATEGORIES).where("not toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    shipped(spark)
    return near_dedup.one_of_each_group(docs, NEAR_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without items of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a sequence."""
    shipped(spark)
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: Classifiers, signatures and tokenizers have no SQL form; tests hold them to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
