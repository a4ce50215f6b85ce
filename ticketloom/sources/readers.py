"""Readers: text files, ticket CSV, ticket lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators.tickets import read_ticket_lines


def read_text_docs(spark: SparkSession, path: str, max_chars: int | None = None) -> DataFrame:
    """One row per ``.txt`` file: filename, path, content. ``max_chars`` keeps the head only."""
    content = F.col("value") if max_chars is None else F.substring("value", 1, max_chars)
    return (
        spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
        .select(
            F.col("_metadata.file_name").alias("filename"),
            F.col("_metadata.file_path").alias("path"),
            content.alias("content"),
        )
    )


def read_tickets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tickets of a CSV with a header; it must have a ``ticket_text`` column."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if "ticket_text" not in df.columns:
        raise ValueError("CSV must have a 'ticket_text' column")
    return df


def read_ticket_file(spark: SparkSession, path: str) -> DataFrame:
    """One ticket per non-blank line of text files."""
    return read_ticket_lines(spark.read.text(path), "value")


SMALL_SPLIT = 64 * 1024 * 1024
SPREAD_ROWS = 50_000


def spread_small(df: DataFrame, source: DataFrame) -> DataFrame:
    """Spread ``df`` over all cores, in tasks of about ``SPREAD_ROWS`` rows, when its source has splits too few for that.

    A small file is one scan task however many cores there are, and a split of narrow rows holds millions of them, each
    of which may become a text to be scored. Where a source has more than 64 MB per core and its splits hold few rows, as
    with documents, nothing is shuffled. Rows are counted from the files' footers.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    rows = source.count()
    if size >= cores * SMALL_SPLIT and rows / (size / SMALL_SPLIT) <= 2 * SPREAD_ROWS:
        return df
    return df.repartition(max(cores, -(-rows // SPREAD_ROWS)))
