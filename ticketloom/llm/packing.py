"""Packing by optimal length buckets.

Documents are cut into pieces of at most `max_tokens` words. A dynamic program over the histogram of
all piece lengths chooses the bucket widths that minimise padding, and inside each bucket batches fill
a token budget. The histogram has at most max_tokens + 1 rows, so it is the only thing the driver sees.
Places in a bucket are counted in hashed shares of it with offsets, so that a bucket that holds most
pieces is no single task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.frames import partitions, staged
from ticketloom.llm.wordarrays import map_texts, text_bytes, words

MAX_TOKENS, BUCKETS, BUDGET = 4096, 16, 65_536


def bucket_widths(lengths: dict[int, int], buckets: int) -> list[int]:
    """Widths, ascending, at most `buckets`, the last the greatest length, with the least padding in all.

    Of equally good choices the one whose last bucket begins earliest is taken. No lengths: none.
    """
    size = np.array(sorted(lengths), np.int64)
    n = len(size)
    if not n:
        return []
    count = np.concatenate([[0], np.cumsum([lengths[int(s)] for s in size])])
    total = np.concatenate([[0], np.cumsum([lengths[int(s)] * int(s) for s in size])])
    # best[j]: least padding of the first j lengths in the buckets so far
    best = np.concatenate([[0], size * count[1:] - total[1:]])
    back = [np.zeros(n + 1, np.int64)]
    for _ in range(1, min(buckets, n)):
        new, come = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            cost = best[:j] + size[j - 1] * (count[j] - count[:j]) - (total[j] - total[:j])
            come[j] = int(cost.argmin())
            new[j] = cost[come[j]]
        best = new
        back.append(come)
    out, j = [], n
    for come in reversed(back):
        if j:
            out.append(int(size[j - 1]))
            j = int(come[j])
    return out[::-1]


def cut_pieces(docs: DataFrame, id_col: str, text_col: str, max_tokens: int, with_text: bool) -> DataFrame:
    """(id, piece, start, n_tokens[, text]): pieces of each row's words; a text without words is one empty piece.

    The texts of a row's pieces, one after another, are the row's text to the letter.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, offsets = text_bytes(batch.column(1))
        starts, _, first = words(raw, offsets)
        n = np.diff(first)
        pieces = np.maximum(-(-n // max_tokens), 1)
        row = np.repeat(np.arange(batch.num_rows), pieces)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = piece * max_tokens
        columns = [batch.column(0).take(pa.array(row)), pa.array(piece), pa.array(start), pa.array(np.minimum(n[row] - start, max_tokens))]
        if with_text:
            # a piece reaches from its first word to the next piece's; the first begins and the last ends with the text
            begin = np.where(piece > 0, np.append(starts, 0)[np.where(piece > 0, first[row] + start, -1)], offsets[row])
            end = np.where(piece + 1 < pieces[row], np.append(begin[1:], 0), offsets[row + 1])
            data = raw.tobytes()
            columns.append(pa.array([data[a:b].decode() for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "n_tokens", "text"][: len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece bigint, start bigint, n_tokens bigint" + (", text string" if with_text else "")
    return map_texts(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")), run, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, buckets: int = BUCKETS,
         budget: int = BUDGET, with_text: bool = False) -> DataFrame:
    """(id, piece, start, n_tokens, bucket, width, batch, slot, padding[, text]) for every piece of every row.

    A batch of a bucket has budget // width places (one at least); batches are numbered from 0 in each
    bucket and only the last may be short. Null texts have no words. Repeated rows are packed each;
    other columns are not read; an empty table gives none. `text` is the piece's part of the row's text, under the
    name of the text column. A long text becomes many pieces in one task.
    """
    pieces = staged(cut_pieces(docs, id_col, text_col, max_tokens, with_text), "pieces")
    histogram = {r["n_tokens"]: r["n"] for r in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    widths = bucket_widths(histogram, buckets)
    below = F.size(F.filter(F.lit(widths or [0]), lambda w: w < F.col("n_tokens")))
    placed = pieces.withColumn("bucket", below).withColumn("width", F.element_at(F.lit(widths or [0]), below + 1).cast("long")) \
        .withColumn("share", F.pmod(F.xxhash64("id", "piece"), F.lit(partitions(docs.sparkSession))))
    sizes = placed.groupBy("bucket", "share").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("offset", F.sum("n").over(Window.partitionBy("bucket").orderBy("share")) - F.col("n")).drop("n")
    number = F.row_number().over(Window.partitionBy("bucket", "share").orderBy("id", "piece", "n_tokens")) - 1
    placed = placed.withColumn("own", number).join(offsets, ["bucket", "share"]).withColumn("place", F.col("own") + F.col("offset"))
    places = F.greatest(F.floor(F.lit(budget) / F.greatest("width", F.lit(1))), F.lit(1)).cast("long")
    return placed.withColumn("places", places).select(
        F.col("id").alias(id_col), "piece", "start", "n_tokens", "bucket", "width", F.floor(F.col("place") / F.col("places")).alias("batch"),
        (F.col("place") % F.col("places")).alias("slot"), (F.col("width") - F.col("n_tokens")).alias("padding"),
        *([F.col("text").alias(text_col)] if with_text else []))
