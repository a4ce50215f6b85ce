"""Streaming: incremental index upkeep and classification of arriving tickets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticketloom.operators.scoring import score_tickets
from ticketloom.sources import sinks


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of every key, as a partial aggregate (no sort, no full group)."""
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(key).agg(newest).select(key, "row.*")


def sync_index(
    spark: SparkSession, source_path: str, index_path: str, checkpoint: str,
    embed: Callable[[DataFrame], DataFrame], schema: str, key: str = "doc_id",
    content: str = "content", version: str = "created_at", files_per_batch: int = 1000,
    buckets: int = 64, removed: str | None = None,
) -> StreamingQuery:
    """Bring an index up to date with new files of a chunk table, then stop.

    Each batch keeps the newest row per key, drops rows no newer than the newest one
    seen for the key (files may come late) and rows whose content the index already
    has, embeds the rest and upserts them into the keyed index table. The newest version
    seen of each key is kept in a keyed table of its own, ``seen_path``, and moves on with rows
    of equal content too, so that what is older than such a row stays away. A batch run
    again after a failure finds its rows in place and changes nothing.

    ``removed`` names a boolean column of the source that marks rows as deleted. A deleted row stays in
    the index with its key and version, so that older rows that come late do not bring it back; of equal
    versions the deletion counts. ``read_index`` leaves such rows out. Rows without a key are left out, and ``embed``
    must give the same rows each time.
    """
    rank = [version, *([removed] if removed else [])]

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.filter(F.col(key).isNotNull())
        if removed:
            batch = batch.withColumn(removed, F.coalesce(removed, F.lit(False)))
            batch = batch.withColumn(content, F.when(~F.col(removed), F.coalesce(content, F.lit(""))))
        batch = batch.withColumn("content_hash", F.md5(F.encode(F.col(content), "utf-8")))
        # what is newest, and what of it is new, is found by hashes; contents are shuffled for changed rows only
        digest = F.unhex("content_hash")
        hashes = batch.groupBy(key, *rank).agg(F.min(digest).alias("low_hash"), F.max(digest).alias("high_hash"))
        newest = sinks.stage(latest_per_key(hashes, key, rank), "newest")
        if newest.isEmpty():
            return

        def held(path: str, *columns: Column) -> DataFrame:
            # Only rows in the buckets of this batch's keys are read, and of those the batch's own.
            return sinks.read_keyed(spark, path, newest.select(key), key, buckets).select(key, *columns).join(newest.select(key), key, "left_semi")

        fresh = newest
        if sinks.has_rows(spark, seen_path(index_path)):
            fresh = fresh.join(held(seen_path(index_path), F.col(version).alias("seen_version")), key, "left").filter(
                F.col("seen_version").isNull() | (F.col(version) > F.col("seen_version"))).drop("seen_version")
        if sinks.has_rows(spark, index_path):
            have = held(index_path, F.col("content_hash").alias("have_hash"), F.col(version).alias("have_version"), F.lit(True).alias("have"))
            fresh = fresh.join(have, key, "left").filter(F.col("have").isNull() | (F.col(version) > F.col("have_version"))).drop("have_version")
            fresh = fresh.withColumn("have", F.col("have").isNotNull())
        else:
            fresh = fresh.withColumns({"have_hash": F.lit(None).cast("string"), "have": F.lit(False)})
        fresh = sinks.stage(fresh, "fresh")
        same = F.col("have") & F.col("low_hash").eqNullSafe(F.col("high_hash")) & F.col("low_hash").eqNullSafe(F.unhex("have_hash"))
        wanted = fresh.filter(~same)
        if not wanted.isEmpty():
            wanted = wanted.select(key, "have", "have_hash", F.struct(*rank).alias("newest"))
            rows = batch.join(wanted, key).filter(F.struct(*rank).eqNullSafe(F.col("newest"))).drop("newest")
            # rows of one key and version: the greatest content counts, which the index may have
            rows = latest_per_key(rows, key, [content]).filter(~(F.col("have") & F.col("content_hash").eqNullSafe(F.col("have_hash"))))
            changed = sinks.stage(rows.drop("have", "have_hash"), "changed")
            if not changed.isEmpty():
                if removed:
                    live = embed(changed.filter(~F.col(removed)))
                    added = live.unionByName(changed.filter(removed), allowMissingColumns=True)
                else:
                    added = embed(changed)
                sinks.replace_rows(added, changed.select(key), index_path, key, buckets)
        if not fresh.isEmpty():
            sinks.replace_rows(fresh.select(key, version), fresh.select(key), seen_path(index_path), key, buckets)

    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_path)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def seen_path(index_path: str) -> str:
    """Where the newest version seen of each key is kept."""
    return f"{index_path.rstrip('/')}-seen"


def read_index(spark: SparkSession, path: str, removed: str | None = None) -> DataFrame:
    """The rows of an index that are not deleted."""
    index = sinks.read_keyed(spark, path)
    return index if removed is None else index.filter(~F.col(removed)).drop(removed)


def classify_stream(tickets: DataFrame, text: str = "ticket_text", sender: str | None = None) -> DataFrame:
    """Classification and metadata of a stream of tickets: stateless, rows in, rows out; each ticket is scored once."""
    fields = {
        "classification": ("category", "priority", "assigned_team", "confidence"),
        "metadata": ("priority_score", "urgency_level", "affected_systems", "technical_keywords", "user_impact",
                     "requires_escalation"),
    }
    structs = {out: F.struct(*[F.col(f"scored.{f}").alias(f) for f in names]) for out, names in fields.items()}
    return score_tickets(tickets, text, sender).withColumns(structs).drop("scored")


def once_each(tickets: DataFrame, key: str = "ticket_id", at: str = "submitted_date", delay: str = "7 days") -> DataFrame:
    """A stream in which a ticket that is delivered again within ``delay`` of its time counts once, across batches and restarts.

    The state holds the keys of the last ``delay`` only: a key goes once the watermark has passed its time. Tickets that come later
    than that are dropped as late. Rows without a time have no place in the watermark and are left out.
    """
    timed = tickets.filter(F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp"))
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def start_append(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to parquet files; ``once`` takes what is there and stops."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
