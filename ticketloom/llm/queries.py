"""Registered queries of this package: each runs its operator over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketloom.llm import backoff, bpe, language, mixing, neardup, packing, piecewise, quality, secret_scan, spelling, substrings, tries, url_rules
from ticketloom.llm.oracles import ORACLES  # noqa: F401


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def identifier_words(name: str = "byte_bpe_50k.json") -> list[str]:
    """Words of three letters and more of a public tokenizer's vocabulary, in its order."""
    import json
    import re

    with open(tokenizer_path(name), encoding="utf-8") as f:
        ids = json.load(f)["model"]["vocab"]
    return list(dict.fromkeys(w for w in (re.sub("[^A-Za-z]", "", t) for t in sorted(ids, key=ids.get)) if len(w) > 2))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_held_out(documents(spark, sf_dir))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.compare_with_next(documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_digests(documents(spark, sf_dir))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(documents(spark, sf_dir), words=identifier_words())


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_held_out(documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("n_candidates")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), tokenizer_path())


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("node_key")


def op12_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_quality, op2_language, op3_near_duplicates, op4_fingerprints, op5_substring_dedup, op6_secrets, op7_lm_score, op8_packing, op9_url_filter, op10_bpe,
    op11_prefix_trie, op12_mix, op13_spelling,
)}
