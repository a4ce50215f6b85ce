"""Context-triggered piecewise hashing: fingerprints that stay alike when part of a text changes.

A rolling hash over seven bytes cuts a text where its value hits the block size; each piece becomes
one of 64 letters. A fingerprint holds the block size and two signatures, for that size and its
double, and two fingerprints compare where they share a size: by edit distance (insertions and
deletions), if some seven letters in a row agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import partitions, ship
from ticketloom.llm.wordarrays import BYTE_CODES, INVERSES, ODD, POWERS, SPAN, _INVERSE, _powers, map_texts, mix, slices

WINDOW, LETTERS, SMALLEST, LONGEST = 7, 56, 3, 64
RUN = 7
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def block_size(n: int) -> int:
    """The smallest 3 * 2**k at which a text of n bytes falls into about 56 pieces or fewer."""
    size = SMALLEST
    while size * LETTERS < n:
        size *= 2
    return size


def rolling(raw: np.ndarray) -> np.ndarray:
    """Hash of the seven bytes up to each byte."""
    codes = BYTE_CODES[raw]
    out = np.zeros(len(raw), np.uint64)
    for k in range(min(WINDOW, len(raw))):
        out[k:] += codes[: len(raw) - k] * POWERS[k]
    return mix(out) >> np.uint64(32)


class Prefixes:
    """Hash of any stretch of some bytes, the same wherever it stands."""

    def __init__(self, raw: np.ndarray) -> None:
        n = len(raw)
        powers, self.inverses = (POWERS, INVERSES) if n < SPAN else (_powers(ODD, n + 1), _powers(_INVERSE, n + 1))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_CODES[raw] * powers[:n], out=self.sums[1:])

    def of(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[begins]) * self.inverses[begins] + (ends - begins).astype(np.uint64))


def signature(roll: np.ndarray, prefixes: Prefixes, size: int, longest: int) -> bytes:
    """One letter for each piece; the last letter stands for all that follows `longest` - 1 pieces."""
    cuts = np.flatnonzero(roll % np.uint64(size) == np.uint64(size - 1)) + 1
    ends = np.append(cuts[: longest - 1], len(roll))
    if len(ends) > 1 and ends[-1] == ends[-2]:
        ends = ends[:-1]
    begins = np.concatenate([[0], ends[:-1]])
    return ALPHABET[(prefixes.of(begins, ends) & np.uint64(63)).astype(np.int64)].tobytes()


def fingerprint(data: bytes) -> str:
    """size:signature:signature at double size; an empty text gives 3::."""
    if not data:
        return f"{SMALLEST}::"
    raw = np.frombuffer(data, np.uint8)
    roll, prefixes, size = rolling(raw), Prefixes(raw), block_size(len(raw))
    fine = signature(roll, prefixes, size, LONGEST)
    while len(fine) < LETTERS // 2 and size > SMALLEST:
        size //= 2
        fine = signature(roll, prefixes, size, LONGEST)
    return f"{size}:{fine.decode()}:{signature(roll, prefixes, 2 * size, LONGEST).decode()}"


def likeness(left: list[str], right: list[str]) -> np.ndarray:
    """From 0 to 1 for pairs of fingerprints; equal ones give 1, without a common block size 0."""
    out = np.zeros(len(left))
    pairs, owner = [], []
    for k, (a, b) in enumerate(zip(left, right, strict=True)):
        if a == b:
            out[k] = 1.0
            continue
        sa, a1, a2 = a.split(":")
        sb, b1, b2 = b.split(":")
        na, nb = int(sa), int(sb)
        for u, x in ((na, a1), (2 * na, a2)):
            for v, y in ((nb, b1), (2 * nb, b2)):
                if u == v and x and y:
                    pairs.append((x, y))
                    owner.append(k)
    for at in range(0, len(pairs), 4096):
        some = pairs[at : at + 4096]
        np.maximum.at(out, owner[at : at + 4096], similarity([p[0] for p in some], [p[1] for p in some]))
    return out


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(t) for t in texts])
    grid = np.zeros((len(texts), LONGEST), np.uint8)
    for k, t in enumerate(texts):
        grid[k, : len(t)] = np.frombuffer(t.encode(), np.uint8)
    return grid, sizes


def similarity(left: list[str], right: list[str]) -> np.ndarray:
    """1 - edit distance / both lengths for signatures of up to 64 letters that share a run; else 0. Bit-parallel."""
    a, na = letters(left)
    b, nb = letters(right)
    n = len(left)
    rows = np.arange(n)
    masks = np.zeros((n, 128), np.uint64)
    for j in range(LONGEST):
        live = j < na
        masks[rows[live], a[live, j]] |= np.uint64(1 << j)
    v = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    for j in range(int(nb.max(initial=0))):
        u = v & masks[rows, b[:, j]]
        v = np.where(j < nb, (v + u) | (v - u), v)
    full = np.where(na < 64, (np.uint64(1) << np.minimum(na, 63).astype(np.uint64)) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
    common = np.bitwise_count(~v & full).astype(float)
    return np.where(share_run(a, na, b, nb), 2 * common / (na + nb), 0.0)


def share_run(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether the two signatures have some seven letters in a row in common (all of it, if shorter)."""

    def runs(grid: np.ndarray, sizes: np.ndarray, side: int) -> np.ndarray:
        code = np.zeros((len(grid), LONGEST - RUN + 1), np.int64)
        for k in range(RUN):
            code = (code << 8) | grid[:, k : k + LONGEST - RUN + 1]
        code = (code << 1) | side
        spare = -2 - 2 * np.arange(code.shape[1]) * 2 - side * 2
        return np.where(np.arange(code.shape[1]) < np.maximum(sizes - RUN + 1, 1)[:, None], code, spare)

    both = np.sort(np.concatenate([runs(a, na, 0), runs(b, nb, 1)], axis=1), axis=1)
    return (((both[:, 1:] >> 1) == (both[:, :-1] >> 1)) & ((both[:, 1:] & 1) != (both[:, :-1] & 1))).any(axis=1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of each row's whole text; a null text is empty."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([fingerprint(t.encode()) for t in texts], pa.string())],
                                          names=["id", "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), text_col), run, f"id {kind}, n_chars bigint, fingerprint string").withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and likeness to that and to the next document.

    The next document has the next smaller id (a long); after the smallest comes the largest, and a
    single document follows itself. Rows with equal ids follow by their text's hash; null ids come
    last, null texts are empty. Other columns are not read; an empty table gives none.

    Texts are shuffled once: ids are cut into ranges, each range is sorted in one task, and the first
    row of a range is also sent to the range before it. Only the ranges' bounds, at most one per
    shuffle partition, reach the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    lowest = -(2**63)
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    parts = partitions(spark)
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("k"))
    cut = ids.agg(F.expr(f"percentile_approx(k, array({', '.join(str(i / parts) for i in range(1, parts))}), 10000)").alias("q")).collect()[0]["q"] if parts > 1 else None
    bounds = sorted(set(cut or []))  # range r holds ids in (bounds[r - 1], bounds[r]]; read from the last range to the first
    low, high = F.lit([lowest, *bounds][1:] or [lowest]), len(bounds)
    k = F.coalesce("id", F.lit(lowest))
    place = (F.lit(high) - F.size(F.filter(low, lambda b: b < k)) if bounds else F.lit(0)).cast("int")
    ranged = keyed.withColumn("k", k).withColumn("part", place)
    heads = ids.withColumn("part", (F.lit(high) - F.size(F.filter(low, lambda b: b < F.col("k"))) if bounds else F.lit(0)).cast("int")) \
        .groupBy("part").agg(F.max("k").alias("k")).collect()
    first = {r["part"]: r["k"] for r in heads}
    order = sorted(first)
    before = {p: order[i - 1] for i, p in enumerate(order)}  # the range before the first is the last
    # rows of a range's largest id also go to the range before it, marked; that task takes the first of them
    targets = F.array(F.struct(F.col("part").alias("to"), F.lit(False).alias("ahead")))
    extra = F.create_map(*[x for p in order for x in (F.lit(first[p]), F.lit(before[p]))]) if order else None
    if extra is not None:
        to = F.try_element_at(extra, F.col("k"))
        targets = F.when(to.isNotNull(), F.concat(targets, F.array(F.struct(to.alias("to"), F.lit(True).alias("ahead"))))).otherwise(targets)
    sent = ranged.withColumn("target", F.explode(targets)).select("id", "t", "k", F.col("target.to").alias("to"), F.col("target.ahead").alias("ahead"))
    n = max(1, len(bounds) + 1)
    sent = sent.repartitionById(n, F.col("to")).sortWithinPartitions("to", "ahead", F.desc("k"), F.xxhash64("t"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        closed = False
        for batch in batches:
            for piece in slices(batch, 1, 4 << 20):
                rows, texts = zip(piece.column(0).to_pylist(), piece.column(2).to_pylist(), strict=True), piece.column(1).to_pylist()
                todo = []
                for (i, ahead), t in zip(rows, texts, strict=True):
                    if ahead and closed:
                        continue
                    here = (i, t, fingerprint(t.encode()))
                    if held is not None:
                        todo.append((held, here))
                    held, closed = here, bool(ahead)
                yield compared(todo)

    out = sent.select("id", "t", "ahead").mapInArrow(run, COMPARED)
    return out.withColumnRenamed("id", id_col)


COMPARED = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compared(pairs: list[tuple]) -> pa.RecordBatch:
    texts = [edited(a[1], b[1]).encode() for a, b in pairs]
    own, changed = [a[2] for a, _ in pairs], [fingerprint(t) for t in texts]
    return pa.RecordBatch.from_arrays([
        pa.array([a[0] for a, _ in pairs], pa.int64()), pa.array([len(a[1]) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()), pa.array(own, pa.string()), pa.array(changed, pa.string()),
        pa.array(likeness(own, changed)), pa.array(likeness(own, [b[2] for _, b in pairs])),
    ], names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
