"""Block-wise top-k: every query against every corpus row without a cross join.

Both sides are cut into blocks of bounded size by a hash of their id. Queries are
copied to every corpus block and the corpus to every query block, so that each
pair of blocks meets in exactly one group. A group scores its block with numpy and
emits at most k rows per query; all pairs are never written. Because blocks are cut
by id hash, copies, hot keys and hot words spread evenly over them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORPUS_BLOCK = 16384
QUERY_BLOCK = 4096
SMALL_BLOCK = 512
DIGITS = 6
SLACK = 1e-9
CELLS, NUMBERS = 1_000_000, 2_000_000  # of one matrix product, and of the rows that are added up again


def blocks_for(count: Column, rows: int, cores: int = 1) -> Column:
    """Blocks of about ``rows`` rows; a small input is cut further to occupy the cores."""
    busy = F.least(F.lit(cores), F.ceil(count / SMALL_BLOCK))
    return F.greatest(F.ceil(count / rows), busy, F.lit(1)).cast("int")


def block_count(df: DataFrame, rows: int, cores: int = 1) -> Column:
    """Number of blocks, as a lazily evaluated scalar."""
    return df.agg(blocks_for(F.count("*"), rows, cores)).scalar()


def block_of(key: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), blocks).cast("int")


def all_blocks(blocks: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), blocks - 1))


def result_table(q: pa.Table, c: pa.Table, picked: tuple[np.ndarray, np.ndarray, np.ndarray], schema: pa.Schema) -> pa.Table:
    """(query_id, corpus_id, score) rows of the picked positions."""
    columns = [q["query_id"].take(pa.array(picked[0])), c["corpus_id"].take(pa.array(picked[1])), pa.array(picked[2])]
    return pa.table(columns, names=["query_id", "corpus_id", "score"]).cast(schema)


def blockwise_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    score: Callable[[pa.Table, pa.Table], tuple[np.ndarray, np.ndarray, np.ndarray]],
    keys: list[str] | None = None,
    corpus_rows: int = CORPUS_BLOCK,
    query_rows: int = QUERY_BLOCK,
    corpus_count: Column | None = None,
    ranked: bool = True,
) -> DataFrame:
    """Top k (query_id, corpus_id, score, rank) over all blocks; the unranked top k of each if not ``ranked``.

    ``score`` gets a query and a corpus table, the corpus in id order. With ``keys``
    the inputs already carry the block columns. A known ``corpus_count`` saves a pass.
    """
    if keys is None:
        keys = ["q_block", "c_block"]
        cores = queries.sparkSession.sparkContext.defaultParallelism
        n_q = block_count(queries, query_rows)
        if corpus_count is None:
            n_c = block_count(corpus, corpus_rows, cores)
        else:
            n_c = blocks_for(corpus_count, corpus_rows, cores)
        queries = queries.withColumn("q_block", block_of("query_id", n_q)).withColumn("c_block", all_blocks(n_c))
        corpus = corpus.withColumn("c_block", block_of("corpus_id", n_c)).withColumn("q_block", all_blocks(n_q))
    fields = [queries.schema["query_id"], corpus.schema["corpus_id"], T.StructField("score", T.DoubleType())]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        target = pa.schema([
            ("query_id", q.schema.field("query_id").type),
            ("corpus_id", c.schema.field("corpus_id").type),
            ("score", pa.float64()),
        ])
        if q.num_rows == 0 or c.num_rows == 0:
            return target.empty_table()
        c = c.sort_by("corpus_id")
        return result_table(q, c, score(q, c), target)

    partial = queries.groupBy(*keys).cogroup(corpus.groupBy(*keys)).applyInArrow(run, schema)
    return best_of(partial, k) if ranked else partial


def best_of(partial: DataFrame, k: int) -> DataFrame:
    """Global top k per query of per-block top-k rows, by unrounded scores; one rank limit runs before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("corpus_id"))
    best = partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.withColumn("score", F.round("score", DIGITS))


def unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    sizes = np.unique(pc.list_value_length(vectors).to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes[:5].tolist()}")
    flat = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.nan_to_num(flat.reshape(len(vectors), -1), copy=False)
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=rows, where=norms > 0)


def same_rows(ids: pa.ChunkedArray, others: pa.ChunkedArray) -> np.ndarray:
    """The place of each id among others, far below 0 where it is not there."""
    return pc.fill_null(pc.index_in(ids, value_set=others.combine_chunks()), -(1 << 31)).to_numpy(zero_copy_only=False).astype(np.int64)


def first_of_each(who: np.ndarray, row: np.ndarray, score: np.ndarray, place: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query; ties go to the lower place."""
    order = np.lexsort((place, -score, who))
    who, row, score = who[order], row[order], score[order]
    begin = np.flatnonzero(np.diff(who, prepend=-1))
    nth = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who))))
    return who[nth < k], row[nth < k], score[nth < k]


def best_cosines(q_rows: np.ndarray, c_rows: np.ndarray, k: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the k best rows for each query, ranked as they are; ties go to the lower row.

    A matrix product finds the rows within ``SLACK`` of the k-th best; their scores are added up again row by row, so
    that copies have one score wherever they stand. ``skip`` is a row that a query may not find.
    """
    out = []
    step, pairs = max(1, CELLS // max(1, len(c_rows))), max(1, NUMBERS // max(1, c_rows.shape[1]))
    for at in range(0, len(q_rows), step):
        block = q_rows[at:at + step] @ c_rows.T
        if skip is not None:
            own = np.flatnonzero((skip[at:at + step] >= 0) & (skip[at:at + step] < len(c_rows)))
            block[own, skip[at + own]] = -np.inf
        floor = np.partition(block, block.shape[1] - k, axis=1)[:, block.shape[1] - k] if block.shape[1] > k else np.full(len(block), -np.inf)
        who, row = np.nonzero((block >= floor[:, None] - SLACK) & (block > -np.inf))
        exact = np.concatenate([(c_rows[row[i:i + pairs]] * q_rows[at + who[i:i + pairs]]).sum(axis=1) for i in range(0, len(who), pairs)] or [np.zeros(0)])
        best = first_of_each(who, row, exact, row, k)
        out.append((best[0] + at, best[1], best[2]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def cosine_scorer(k: int, exclude_same_id: bool) -> Callable:
    def score(q: pa.Table, c: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        skip = same_rows(q["query_id"], c["corpus_id"]) if exclude_same_id else None
        return best_cosines(unit_rows(q["vec"]), unit_rows(c["vec"]), k, skip)

    return score
