"""Substring dedup with fixed-block anchors: repeated passages of 20 words and more are removed.

Every document is cut into reference blocks of ten words, next to each other. Any 20 words in a row
hold a whole block, so a passage that repeats an earlier one shows a ten-word window equal to a block:
every rolling window probes the index of blocks. Hits are extended by comparing the 20-word windows
around them, and each of these that also starts earlier is removed; windows that overlap add up to the
maximal repeats.

The work goes by slices, a few megabytes of neighbouring texts that one task reads. A slice sends each
distinct window hash once to that hash's bucket, however often it occurs, and gets back one bit for
each; so a passage that a third of all documents share costs a bucket one entry per slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import partitions, ship, staged
from ticketloom.llm.wordarrays import slices, text_bytes, windows, word_hashes, words

WINDOW, BLOCK = 20, 10
SLICE = 4 << 20
LAST = np.iinfo(np.int64).max  # a null id sorts after all others


class Slice:
    """Word windows of some documents, in order of id, then of reading."""

    def __init__(self, texts: pa.Array, ids: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.order, self.ids = order, ids[order]
        raw, offsets = text_bytes(texts.take(pa.array(order)))
        self.raw, self.offsets = raw, offsets
        self.starts, self.ends, self.first = words(raw, offsets)
        h = word_hashes(raw, self.starts, self.ends)
        self.short, self.short_at = windows(h, self.first, BLOCK)
        self.long, self.long_at = windows(h, self.first, WINDOW)
        self.doc = np.repeat(np.arange(len(ids)), np.diff(self.first))
        long_enough = np.diff(self.first) >= WINDOW
        keep = long_enough[self.doc[self.short_at]] if len(self.short_at) else np.zeros(0, bool)
        self.short, self.short_at = self.short[keep], self.short_at[keep]

    def probes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct rolling windows in hash order, whether each is a block somewhere, whether it occurs twice, and each window's place among them."""
        kinds, which, times = np.unique(self.short, return_inverse=True, return_counts=True)
        block = np.zeros(len(kinds), bool)
        block[which[(self.short_at - self.first[self.doc[self.short_at]]) % BLOCK == 0]] = True
        return kinds, block, times > 1, which

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """20-word windows that hold a hit: their distinct hashes, the first of each, and windows that an earlier one here equals.

        hit: for each rolling window. Results are indexes into `long`.
        """
        marks = np.zeros(len(self.starts) + 1, np.int64)
        marks[self.short_at[hit] + 1] = 1
        seen = np.cumsum(marks)
        at = self.long_at
        chosen = np.flatnonzero(seen[np.minimum(at + WINDOW - BLOCK + 1, len(seen) - 1)] > seen[at])
        kinds, lead = np.unique(self.long[chosen], return_index=True)
        later = np.ones(len(chosen), bool)
        later[lead] = False
        return kinds, chosen[lead], chosen[later]

    def removed(self, repeats: np.ndarray) -> np.ndarray:
        """Words covered by the given 20-word windows."""
        change = np.zeros(len(self.starts) + 1, np.int64)
        np.add.at(change, self.long_at[repeats], 1)
        np.add.at(change, self.long_at[repeats] + WINDOW, -1)
        return np.cumsum(change)[:-1] > 0


def bucket_edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted hashes begins; buckets are equal ranges."""
    bounds = np.array([(k << 64) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(hashes, bounds), [len(hashes)]]).astype(np.int64)


def over_slices(docs: DataFrame, fn: Callable[[str, pa.RecordBatch], Iterator[tuple]], schema: str) -> DataFrame:
    """Apply fn to named slices of (id, text, ...). Names and cuts are the same whenever the table is read."""
    fields = [c.split() for c in schema.split(", ")]
    names, kinds = [f[0] for f in fields], [{"int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[f[1]] for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in slices(batch, 1, SLICE):
                rows = list(fn(f"{task}-{number}", piece))
                number += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.mapInArrow(run, schema)


def ids_of(piece: pa.RecordBatch) -> np.ndarray:
    return piece.column(0).fill_null(LAST).to_numpy()


def send_probes(buckets: int) -> Callable:
    def send(name: str, piece: pa.RecordBatch) -> Iterator[tuple]:
        kinds, block, twice, _ = Slice(piece.column(1), ids_of(piece)).probes()
        edges = bucket_edges(kinds, buckets)
        low = kinds.astype(np.uint32)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            s, e = edges[b], edges[b + 1]
            yield b, name, low[s:e].tobytes() + np.packbits(block[s:e]).tobytes() + np.packbits(twice[s:e]).tobytes()

    return send


def size_of_probes(blob: bytes) -> int:
    """Entries of 32 bits with two flags each, flags in whole bytes."""
    n = len(blob) * 8 // 34
    while 4 * n + 2 * ((n + 7) // 8) < len(blob):
        n += 1
    while 4 * n + 2 * ((n + 7) // 8) > len(blob):
        n -= 1
    return n


def meet_probes(table: pa.Table) -> pa.Table:
    """Which entries of each slice equal a block somewhere and occur more than once."""
    names, blobs = table.column("slice").to_pylist(), table.column("payload").to_pylist()
    sizes = [size_of_probes(b) for b in blobs]
    low = np.concatenate([np.frombuffer(b, np.uint32, n) for b, n in zip(blobs, sizes, strict=True)])
    flags = [[np.unpackbits(np.frombuffer(b, np.uint8, (n + 7) // 8, 4 * n + k * ((n + 7) // 8)), count=n) for b, n in zip(blobs, sizes, strict=True)] for k in (0, 1)]
    block, twice = (np.concatenate(f) for f in flags)
    _, which = np.unique(low, return_inverse=True)
    times, blocks = np.bincount(which, weights=1 + twice.astype(np.int64)), np.bincount(which, weights=block)
    hit = ((times > 1) & (blocks > 0))[which]
    return answers(table, names, sizes, hit)


def send_windows(buckets: int) -> Callable:
    def send(name: str, s: Slice, hit: np.ndarray) -> Iterator[tuple]:
        kinds, lead, _ = s.candidates(hit)
        docs = s.doc[s.long_at[lead]].astype(np.uint32)
        edges = bucket_edges(kinds, buckets)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            f, t = edges[b], edges[b + 1]
            own, number = np.unique(docs[f:t], return_inverse=True)
            yield b, name, b"".join((np.array([t - f, len(own)], np.uint32).tobytes(), kinds[f:t].tobytes(), s.ids[own].tobytes(), number.astype(np.uint32).tobytes()))

    return send


def meet_windows(table: pa.Table) -> pa.Table:
    """Which entries of each slice have an equal window at a smaller id; equal ids go by slice."""
    table = table.sort_by("slice")
    names, blobs = table.column("slice").to_pylist(), table.column("payload").to_pylist()
    hashes, ids, sizes = [], [], []
    for blob in blobs:
        n, m = (int(x) for x in np.frombuffer(blob, np.uint32, 2))
        hashes.append(np.frombuffer(blob, np.uint64, n, 8))
        own = np.frombuffer(blob, np.int64, m, 8 + 8 * n)
        ids.append(own[np.frombuffer(blob, np.uint32, n, 8 + 8 * n + 8 * m)])
        sizes.append(n)
    h, i = np.concatenate(hashes), np.concatenate(ids)
    order = np.lexsort((i, h))  # stable: slices stay in order
    first = np.ones(len(h), bool)
    first[1:] = h[order][1:] != h[order][:-1]
    later = np.zeros(len(h), bool)
    later[order] = ~first
    return answers(table, names, sizes, later)


def answers(table: pa.Table, names: list[str], sizes: list[int], bits: np.ndarray) -> pa.Table:
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.table({"slice": pa.array(names, pa.string()), "bucket": table.column("bucket"), "n": pa.array(sizes, pa.int32()),
                     "bits": pa.array([np.packbits(bits[s:e]).tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)], pa.binary())})


ANSWERS = "slice string, bucket int, n int, bits binary"
SENT = "bucket int, slice string, payload binary"


def bits_of(answer: dict[int, tuple[int, bytes]], edges: np.ndarray) -> np.ndarray:
    """Answers of all buckets in order of the entries; they have to fit what was sent."""
    out = np.zeros(int(edges[-1]), bool)
    for b in np.flatnonzero(np.diff(edges)).tolist():
        n, bits = answer[b]
        if n != edges[b + 1] - edges[b]:
            raise RuntimeError("the table was not read as before: its slices differ")
        out[edges[b] : edges[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
    return out


def pack_slice(name: str, piece: pa.RecordBatch) -> Iterator[tuple]:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in piece.columns], schema=piece.schema))
    yield name, "text", -1, 0, sink.getvalue().to_pybytes()


def joined_slices(docs: DataFrame, found: DataFrame, fn: Callable[[str, Slice, pa.Table, dict], pa.Table], schema: str, buckets: int) -> DataFrame:
    """Bring each slice's answers to its texts: fn gets the slice, its rows in their order and the answers by kind."""
    texts = over_slices(docs, pack_slice, "slice string, kind string, bucket int, n int, bits binary")

    def run(table: pa.Table) -> pa.Table:
        answer: dict[str, dict] = {"probes": {}, "windows": {}}
        rows = None
        for kind, b, n, bits in zip(*(table.column(c) for c in ("kind", "bucket", "n", "bits")), strict=True):
            if kind.as_py() == "text":
                rows = pa.ipc.open_stream(bits.as_buffer()).read_all().combine_chunks()
            else:
                answer[kind.as_py()][b.as_py()] = (n.as_py(), bits.as_py())
        s = Slice(rows.column(1).combine_chunks() if isinstance(rows.column(1), pa.ChunkedArray) else rows.column(1), rows.column(0).fill_null(LAST).to_numpy())
        name = table.column("slice")[0].as_py()
        return fn(name, s, rows.take(pa.array(s.order)), answer)

    return texts.unionByName(found).groupBy("slice").applyInArrow(run, schema)


def hits(s: Slice, answer: dict, buckets: int) -> np.ndarray:
    kinds, _, _, which = s.probes()
    return bits_of(answer["probes"], bucket_edges(kinds, buckets))[which] if len(kinds) else np.zeros(0, bool)


def repeats(docs: DataFrame, finish: Callable[[Slice, pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """Apply finish(slice, rows in its order, removed words) to all slices of (id, text, ...)."""
    spark = docs.sparkSession
    ship(spark)
    buckets = 2 * partitions(spark)
    probes = over_slices(docs, send_probes(buckets), SENT).groupBy("bucket").applyInArrow(meet_probes, ANSWERS)
    probes = staged(probes, "probes").select("slice", F.lit("probes").alias("kind"), "bucket", "n", "bits")
    send = send_windows(buckets)

    def extend(name: str, s: Slice, rows: pa.Table, answer: dict) -> pa.Table:
        out = list(send(name, s, hits(s, answer, buckets)))
        return pa.table({c: pa.array([r[k] for r in out], t) for k, (c, t) in enumerate((("bucket", pa.int32()), ("slice", pa.string()), ("payload", pa.binary())))})

    later = joined_slices(docs, probes, extend, SENT, buckets).groupBy("bucket").applyInArrow(meet_windows, ANSWERS)
    later = staged(later, "windows").select("slice", F.lit("windows").alias("kind"), "bucket", "n", "bits")

    def last(name: str, s: Slice, rows: pa.Table, answer: dict) -> pa.Table:
        kinds, lead, here = s.candidates(hits(s, answer, buckets))
        elsewhere = lead[bits_of(answer["windows"], bucket_edges(kinds, buckets))] if len(kinds) else lead
        return finish(s, rows, s.removed(np.concatenate([elsewhere, here]).astype(np.int64)))

    return joined_slices(docs, probes.unionByName(later), last, schema, buckets)


def kept_words(s: Slice, d: int, gone: np.ndarray) -> bytes:
    """The kept words of one document, joined by one space."""
    own = s.raw[s.offsets[d] : s.offsets[d + 1]].tobytes().split()
    drop = gone[s.first[d] : s.first[d + 1]]
    return b" ".join(w for w, g in zip(own, drop.tolist(), strict=True) if not g) if drop.any() else b" ".join(own)


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) per row.

    Windows of 20 words never cross documents and are judged on the input: one is removed if its words
    also start earlier, at a smaller id or before it in its document. Of rows with equal ids the one
    read first is earlier; null ids (ids are longs) come after all others; null texts have no words.
    Other columns are not read; an empty table gives none.
    """

    def finish(s: Slice, rows: pa.Table, gone: np.ndarray) -> pa.Table:
        counts = np.diff(s.first)
        upto = np.concatenate([[0], np.cumsum(gone)])
        digests = [hashlib.sha256(kept_words(s, d, gone)).hexdigest() for d in range(len(counts))]
        return pa.table({"id": rows.column(0), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(upto[s.first[1:]] - upto[s.first[:-1]], pa.int64()),
                         "kept_sha256": pa.array(digests, pa.string())})

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return repeats(chosen, finish, "id bigint, n_words bigint, n_removed bigint, kept_sha256 string").withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns with repeated passages taken out of the texts, as `repeat_digests` finds them.

    Texts without repeats stay as they are, others become their kept words joined by one space.
    """
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    chosen = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col), *rest)

    def finish(s: Slice, rows: pa.Table, gone: np.ndarray) -> pa.Table:
        texts = rows.column(1).to_pylist()
        for d in range(len(texts)):
            if gone[s.first[d] : s.first[d + 1]].any():
                texts[d] = kept_words(s, d, gone).decode()
        return rows.set_column(1, text_col, pa.array(texts, pa.string()))

    return repeats(chosen, finish, chosen.schema).select(*docs.columns)
