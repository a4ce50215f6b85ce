"""From raw documents to packed training batches, in five stages.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns a
DataFrame; `run` writes it as Parquet to the shared folder and reads it again for the next one. All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm import language, neardup, packing, secret_scan, substrings
from ticketloom.llm.frames import staged
from ticketloom.llm.queries import identifier_words


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`lang` becomes the language that the text is in; documents without one (no text, no letters) go. The automata learn from the labelled rows."""
    return language.with_language(docs, docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays, once."""
    return neardup.one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words and more that an earlier document has are taken out; documents left empty go."""
    return sized(substrings.without_repeats(docs)).where("length(text) > 0")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return sized(secret_scan.redact(docs, words=identifier_words()))


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, with their text, in token-budget batches of like length."""
    return packing.pack(docs, with_text=True)


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("language ID", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("secret scan", redact_secrets),
    ("packing", pack_batches),
]

#: Suffix automata, the packing program and zstandard sizes are beyond SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
