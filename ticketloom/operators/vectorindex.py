"""A persisted index for approximate vector search: lists around coarse centres, dealt to shards.

Centres are trained by spherical k-means on a bounded sample, the `SAMPLE_ROWS` rows whose ids hash lowest. Every
row goes to the list of its nearest centre. Lists are packed into shards of about `SHARD_ROWS` rows; a list that is
larger, as when a third of all rows are copies, is cut into parts by id. A query goes to the shards that hold one of
its `probes` nearest lists, once to each, and is compared exactly with the rows of these lists. How many lists a
query needs is measured on the sample: enough that `RECALL` of the true neighbours there are met. A sparser sample
has farther neighbours than all rows, so the whole needs no more; the share of rows compared follows the data.

The index is written once and read by every search; its vectors are shuffled once for each search and once
more for every `QUERY_ROWS` queries that meet in a shard.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.operators import blocks as B
from ticketloom.sources import sinks

SAMPLE_ROWS, SAMPLE_QUERIES = 20_000, 256
MOST_LISTS, ROUNDS = 4096, 10
RECALL = 0.96
SHARD_ROWS, SMALL_SHARD, QUERY_ROWS = 65_536, 512, 16_384
ASK_ROWS = 2_048  # queries of a shard that are looked at in one step


@dataclass
class VectorIndex:
    """centres: one row a list; probes: lists that a query asks; shards: of each list; rows: (shard, list, corpus_id, vec)."""

    centres: np.ndarray
    probes: int
    shards: list[list[int]]
    rows: DataFrame


def slices(batch: pa.RecordBatch, lists: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose likeness to all centres is looked at in one step."""
    step = max(1, B.CELLS // max(1, lists))
    return (batch.slice(at, step) for at in range(0, batch.num_rows, step))


def train(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Unit centres by spherical k-means; a centre that loses its rows takes the row farthest from its own."""
    rng = np.random.default_rng(seed)
    if not len(sample):
        return np.zeros((0, 0))
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        near = sample @ centres.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centres)) == 0)
        sums[empty] = sample[near.max(axis=1).argsort(kind="stable")[: len(empty)]]
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.divide(sums, norms, out=centres.copy(), where=norms > 0)
    return centres


def needed_probes(sample: np.ndarray, centres: np.ndarray, k: int) -> int:
    """Lists to ask so that RECALL of the k nearest of some sample rows are met within the sample."""
    if len(sample) < 2:
        return len(centres)
    asked = np.linspace(0, len(sample) - 1, min(SAMPLE_QUERIES, len(sample))).astype(int)
    near = sample[asked] @ sample.T
    near[np.arange(len(asked)), asked] = -np.inf
    k = min(k, len(sample) - 1)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
    own = (sample @ centres.T).argmax(axis=1)
    toward = sample[asked] @ centres.T
    rank = (-toward).argsort(axis=1, kind="stable").argsort(axis=1)
    met = np.sort(rank[np.arange(len(asked))[:, None], own[best]].ravel())
    return int(met[math.ceil(RECALL * len(met)) - 1]) + 1


def build(corpus: DataFrame, path: str | None = None, k: int = 3, corpus_id: str = "doc_id", vector: str = "embedding",
          lists: int | None = None, seed: int = 42) -> VectorIndex:
    """Train and write an index; about the square root of the rows many lists, if not told. Rows without a vector are left out."""
    spark = corpus.sparkSession
    path = path or sinks.scratch_dir(spark, "vectorindex")
    rows = corpus.select(F.col(corpus_id).alias("corpus_id"), F.col(vector).alias("vec")).filter("vec IS NOT NULL")
    total = rows.count()
    drawn = rows.orderBy(F.xxhash64("corpus_id"), "corpus_id").limit(SAMPLE_ROWS).select("vec").toArrow()
    sample = B.unit_rows(drawn["vec"]) if drawn.num_rows else np.zeros((0, 0))
    lists = lists or max(1, min(MOST_LISTS, math.isqrt(total), len(sample)))
    centres = train(sample, lists, seed)
    probes = needed_probes(sample, centres, k)
    schema = T.StructType([*rows.schema.fields, T.StructField("list", T.IntegerType())])

    def place(batches):
        for batch in (part for whole in batches for part in slices(whole, len(centres))):
            own = (B.unit_rows(pa.chunked_array([batch.column("vec")])) @ centres.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32))], names=[*batch.schema.names, "list"])

    placed = sinks.stage(rows.mapInArrow(place, schema), "lists")
    sizes = {r["list"]: r["n"] for r in placed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    cores = spark.sparkContext.defaultParallelism
    shard_rows = max(SMALL_SHARD, min(SHARD_ROWS, -(-total // cores)))
    shards, filled, last = [], 0, 0
    for own in range(len(centres)):
        parts = max(1, -(-sizes.get(own, 0) // shard_rows))
        at = []
        for _ in range(parts):
            n = sizes.get(own, 0) / parts
            if filled and filled + n > shard_rows:
                last, filled = last + 1, 0
            at.append(last)
            filled += n
        shards.append(at)
    meta = spark.createDataFrame([(probes, len(sample) and sample.shape[1], centres.astype("<f8").tobytes(), shards)],
                                 "probes int, dims int, centres binary, shards array<array<int>>")
    meta.write.parquet(f"{path}/meta")
    table = spark.createDataFrame([(k, s) for k, s in enumerate(shards)], "list int, shards array<int>")
    part = F.pmod(F.xxhash64("corpus_id"), F.size("shards")).cast("int")
    # as many rows as there are lists: MOST_LISTS, if not told otherwise
    dealt = placed.join(F.broadcast(table) if len(shards) <= MOST_LISTS else table, "list").withColumn("shard", F.element_at("shards", part + 1))
    dealt.select("shard", "list", "corpus_id", "vec").write.parquet(f"{path}/rows")
    return load(spark, path)


def load(spark: SparkSession, path: str) -> VectorIndex:
    """An index written by ``build``."""
    r = spark.read.parquet(f"{path}/meta").collect()[0]
    centres = np.frombuffer(bytes(r["centres"]), "<f8").reshape(-1, max(r["dims"], 1))
    return VectorIndex(centres, r["probes"], [list(s) for s in r["shards"]], spark.read.parquet(f"{path}/rows"))


def search(index: VectorIndex, queries: DataFrame, k: int = 3, query_id: str = "query_id", vector: str = "embedding",
           exclude_same_id: bool = False, probes: int | None = None) -> DataFrame:
    """(query_id, corpus_id, score, rank): the k best of the lists that each query asks; scores are exact cosines, ties go to the smaller id."""
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vec")).filter("vec IS NOT NULL")
    centres, shards, probes = index.centres, index.shards, probes or index.probes
    schema = T.StructType([*asked.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("lists", T.ArrayType(T.IntegerType()))])

    def route(batches):
        for batch in (part for whole in batches for part in slices(whole, len(centres)) if len(centres)):
            near = B.unit_rows(pa.chunked_array([batch.column("vec")])) @ centres.T
            chosen = np.argsort(-near, axis=1, kind="stable")[:, :probes]
            who, at, wanted = [], [], []
            for q, own in enumerate(chosen.tolist()):
                by_shard: dict[int, list[int]] = {}
                for one in own:
                    for s in shards[one]:
                        by_shard.setdefault(s, []).append(one)
                who += [q] * len(by_shard)
                at += by_shard
                wanted += by_shard.values()
            yield pa.RecordBatch.from_arrays([*(c.take(pa.array(who)) for c in batch.columns), pa.array(at, pa.int32()), pa.array(wanted, pa.list_(pa.int32()))],
                                             names=[*batch.schema.names, "shard", "lists"])

    routed = sinks.stage(asked.mapInArrow(route, schema), "routed")
    parts = routed.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    sent = routed.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    rows = index.rows.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    fields = [asked.schema["query_id"], index.rows.schema["corpus_id"], T.StructField("score", T.DoubleType())]
    scored = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        who, row, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if q.num_rows and c.num_rows:
            c = c.sort_by([("list", "ascending"), ("corpus_id", "ascending")])
            own, c_rows = c["list"].to_numpy(), B.unit_rows(c["vec"])
            # a list and the queries that ask it, then the best of all lists
            kinds, begin = np.unique(own, return_index=True)
            # equal scores: the smaller id, which is not the smaller place across lists
            place = np.empty(c.num_rows, np.int64)
            place[pa.compute.array_sort_indices(c["corpus_id"].combine_chunks()).to_numpy()] = np.arange(c.num_rows)
            best = []
            for at in range(0, q.num_rows, ASK_ROWS):
                part = q.slice(at, ASK_ROWS)
                q_rows, wanted = B.unit_rows(part["vec"]), part["lists"].combine_chunks()
                asks = np.repeat(np.arange(part.num_rows), wanted.value_lengths().to_numpy(zero_copy_only=False))
                lists = wanted.flatten().to_numpy()
                order = np.argsort(lists, kind="stable")
                asks, lists = asks[order], lists[order]
                same = B.same_rows(part["query_id"], c["corpus_id"]) if exclude_same_id else None
                found = []
                for one, a, b in zip(kinds.tolist(), begin.tolist(), [*begin[1:].tolist(), len(own)], strict=True):
                    those = asks[slice(*np.searchsorted(lists, [one, one + 1]))]
                    if len(those):
                        x, y, s = B.best_cosines(q_rows[those], c_rows[a:b], k, None if same is None else same[those] - a)
                        found.append((those[x], y + a, s))
                if found:
                    x, y, s = (np.concatenate(f) for f in zip(*found, strict=True))
                    x, y, s = B.first_of_each(x, y, s, place[y], k)
                    best.append((x + at, y, s))
            if best:
                who, row, score = (np.concatenate(f) for f in zip(*best, strict=True))
        return pa.table({"query_id": q["query_id"].take(pa.array(who)), "corpus_id": c["corpus_id"].take(pa.array(row)), "score": pa.array(score)})

    keys = ["shard", "part"]
    met = sent.select(*keys, "query_id", "vec", "lists").groupBy(*keys).cogroup(rows.select(*keys, "list", "corpus_id", "vec").groupBy(*keys)).applyInArrow(run, scored)
    return B.best_of(met, k)
