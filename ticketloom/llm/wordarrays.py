"""Texts of an Arrow column as byte arrays: words, word hashes and word windows in numpy.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, so words never cross documents.
Work arrays are some twenty times the text in size: callers pass slices of a few megabytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ticketloom.llm.frames import ship

SLICE_BYTES = 2 << 20
SPAN = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * ODD)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS, INVERSES = _powers(ODD, 2 * SPAN), _powers(_INVERSE, 2 * SPAN)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and where each begins; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in the bytes, and each document's first word."""
    inside = ~SPACE[raw]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    heads = offsets[:-1][(offsets[:-1] > 0) & (offsets[:-1] < len(raw))]
    begin[heads] = inside[heads]
    end[heads - 1] = inside[heads - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + SPAN, side="right")))
        span = int(ends[to - 1] - low)
        powers, inverses = (POWERS, INVERSES) if span <= SPAN else (_powers(ODD, span), _powers(_INVERSE, span))
        sums = np.zeros(span + 1, np.uint64)
        np.cumsum(BYTE_CODES[raw[low : low + span]] * powers[:span], out=sums[1:])
        s, e = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * inverses[s] + (e - s).astype(np.uint64))
        at = to
    return out


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `width` words within one document, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = hashes[:n].copy()
    for k in range(1, width):
        total = total * ODD + hashes[k : k + n]
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return mix(total[at]), at


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces whose texts have about `most` bytes at most, one row at least."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str, text: int = 1,
              most: int = SLICE_BYTES) -> DataFrame:
    """Apply `fn` to slices of a few megabytes; it returns a batch or yields some."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, text, most):
                out = fn(piece)
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
