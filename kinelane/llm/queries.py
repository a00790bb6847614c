"""The registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinelane.llm import (
    decontam,
    huffman,
    manifest,
    near_dedup,
    packing,
    page_text,
    piece_codec,
    quality_rules,
    secret_scan,
    spelling,
    token_counts,
    toxicity,
    url_rules,
)
from kinelane.llm.common import table

#: Label columns that the toxicity chain goes through; the last is its verdict.
CATEGORIES = ["quality", "toxic"]


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op3_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extracted(table(spark, sf_dir, "pages"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), 85)


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    links = toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)
    return toxicity.judge(docs.select("doc_id", "text"), links, CATEGORIES).drop("text")


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.counted(table(spark, sf_dir, "documents"), str(path))


def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, benchmark)


def op9_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return huffman.round_trip(table(spark, sf_dir, "documents"), str(path), end_id=2)


def op10_exact_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), str(path))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return piece_codec.digests(piece_codec.round_trip(table(spark, sf_dir, "documents"), str(path)))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verified(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_url_rules, op2_secret_scan, op3_page_text, op4_minhash_near_dedup, op5_toxicity_chain,
        op6_host_quality, op7_token_counts, op8_template_decontamination, op9_huffman_ids,
        op10_exact_packing, op11_spelling_variants, op12_piece_codec, op13_merkle_manifest,
    )
}
ORACLE: dict[str, str] = {
    "op1_url_rules": url_rules.ORACLE,
    "op2_secret_scan": secret_scan.ORACLE,
    "op4_minhash_near_dedup": near_dedup.ORACLE,
    "op6_host_quality": quality_rules.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
