"""Reload of the knowledge base from its source files, by file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.operators import kb
from ticketloom.sources import sinks

CHUNKS, LOADS = "chunks", "loads"


def read_kb(spark: SparkSession, path: str) -> DataFrame:
    """The chunks of every loaded file."""
    return sinks.read_keyed(spark, f"{path}/{CHUNKS}")


def read_loads(spark: SparkSession, path: str) -> DataFrame:
    """(filename, content_hash, loaded_at) of every loaded file, also of those without a chunk."""
    return sinks.read_keyed(spark, f"{path}/{LOADS}")


def reload_kb(
    docs: DataFrame, path: str, loaded_at: Column, mode: str = "incremental", remove_missing: bool = True,
    buckets: int = 64,
) -> None:
    """Bring the chunk table up to date with ``docs`` (filename, content).

    ``incremental`` chunks new and changed files only, ``full`` all of them. The chunks of a file are replaced
    together, so a shrunk file leaves none behind. With ``remove_missing``, ``docs`` is the whole source and files
    it lacks lose their chunks. The load table is written last: a run that failed before that is repeated whole
    and changes nothing twice. A repeated file name fails the job before anything is written; null contents are
    empty, null file names are skipped.
    """
    if mode not in sinks.MODES:
        raise ValueError(f"mode must be one of {sinks.MODES}, not {mode!r}")
    spark = docs.sparkSession
    docs = docs.filter(F.col("filename").isNotNull()).withColumn("content", F.coalesce("content", F.lit("")))
    hashes = sinks.stage(
        sinks.one_per_key(docs.select("filename", kb.content_hash(F.col("content")).alias("content_hash")), "filename"),
        "hashes")
    known = sinks.has_rows(spark, f"{path}/{LOADS}")
    old = read_loads(spark, path) if known else hashes.limit(0)
    both = ["filename", "content_hash"]
    fresh = hashes if mode == "full" else hashes.join(old.select(both), both, "left_anti")
    fresh = sinks.stage(fresh, "fresh")
    keys = fresh.select("filename")
    if remove_missing and known:
        keys = keys.unionByName(old.select("filename").join(hashes.select("filename"), "filename", "left_anti"))
    keys = sinks.stage(keys, "reloaded")
    if keys.isEmpty():
        return
    chunks = kb.chunk_documents(docs.join(fresh.select("filename"), "filename", "left_semi"), loaded_at)
    sinks.replace_rows(sinks.stage(chunks, "chunks"), keys, f"{path}/{CHUNKS}", "filename", buckets)
    loads = sinks.stage(fresh.withColumn("loaded_at", loaded_at.cast("timestamp")), "loads")
    sinks.replace_rows(loads, keys, f"{path}/{LOADS}", "filename", buckets)
