"""BPE encoding with content-defined chunk reuse.

A rolling hash over the bytes cuts every text where its content says so, so passages that documents
share fall into the same chunks, wherever they stand. A chunk is encoded once per worker and kept.
Cuts fall anywhere, also inside words: of a chunk only whole words count, its two rims are kept as
bytes, and at each join the word lying across it is put together and encoded anew. Words between
white space are encoded independently by the tokenizer (its pattern never crosses white space and
its normaliser does not compose across it), so after this repair the ids agree with those of the
whole text. A tokenizer whose pieces do cross white space is refused.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.wordarrays import BYTE_CODES, map_texts, mix, text_bytes

WINDOW = 12
CUT_BITS = 7
#: Entries that a worker keeps of each kind; when there are more, that kind is forgotten and filled anew.
MAX_PIECES, MAX_CHUNKS = 500_000, 60_000

BLANK = b" \t\n\x0b\x0c\r"

#: Words of Latin-1 letters, digits and ASCII marks fall into these pieces; the tokenizer's own pattern
#: agrees with this on them. Apostrophes and special tokens are left to the tokenizer itself.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~]+")
PLAIN_LINE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:-@\[-`{-~ \t-\r]*")
PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")

_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_REST = [b for b in range(256) if b not in _PRINTED]
#: The byte-level alphabet: printed bytes stand for themselves, the rest follow from 256 on.
BYTE_CHARS = {b: chr(b) for b in _PRINTED} | {b: chr(256 + k) for k, b in enumerate(_REST)}
LATIN = {chr(c): "".join(BYTE_CHARS[b] for b in chr(c).encode()) for c in range(128, 256)}
BYTE_LEVEL = str.maketrans(LATIN)


def cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Ends of chunks: each document's end and where the hash of the last bytes has low bits of zero."""
    roll = np.zeros(len(raw), np.uint64)
    codes = BYTE_CODES[raw]
    for k in range(WINDOW):
        roll[k:] += np.left_shift(codes[: len(raw) - k], np.uint64(5 * k))
    cut = (mix(roll) & np.uint64((1 << CUT_BITS) - 1)) == 0
    return np.union1d(np.flatnonzero(cut) + 1, offsets[1:])


def joined(parts: list[tuple[str, str, int]]) -> tuple[str, str, int]:
    """Ids, tokens and their number in a row; parts without tokens leave no gap."""
    parts = [x for x in parts if x[2]]
    return " ".join([x[0] for x in parts]), " ".join([x[1] for x in parts]), sum([x[2] for x in parts])


class Encoder:
    """Encodes with one tokenizer file, keeping words and chunks."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_independent(spec)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: whether PIECES cuts as this tokenizer does
        split = json.dumps(spec["pre_tokenizer"]) + json.dumps(spec["normalizer"])
        self.simple = r"|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+" in split and '"Lowercase"' in split and '"ByteLevel"' in split
        self.plain = Tokenizer(self.tokenizer.model)
        self.tokens = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.pieces: dict[str | bytes, tuple[str, str, int]] = {}
        self.chunks: dict[bytes, tuple[str, str, int]] = {}

    def encoded(self, ids: list[int]) -> tuple[str, str, int]:
        return " ".join(map(str, ids)), " ".join([self.tokens[i] for i in ids]), len(ids)

    def cut(self, text: bytes) -> list[str | bytes]:
        """What to encode of whole words: plain pieces as str, other words as bytes."""
        line = text.decode()
        if self.simple and PLAIN_LINE.fullmatch(line) and "<|" not in line:
            return PIECES.findall(line.lower())
        out: list[str | bytes] = []
        for word in text.split():
            w = word.decode()
            out += PIECES.findall(w.lower()) if self.simple and PLAIN.fullmatch(w) and "<|" not in w else [word]
        return out

    def learn(self, keys: set[str | bytes]) -> None:
        """Encode what is missing; afterwards all the given keys are known."""
        if len(self.pieces) > MAX_PIECES:
            self.pieces = {}
        missing = keys - self.pieces.keys()
        odd = [k for k in missing if isinstance(k, bytes)]
        plain = [k for k in missing if isinstance(k, str)]
        for keys_, texts, tool in ((odd, [k.decode() for k in odd], self.tokenizer),
                                   (plain, [k if k.isascii() else k.translate(BYTE_LEVEL) for k in plain], self.plain)):
            for at in range(0, len(keys_), 8192):
                found = tool.encode_batch_fast(texts[at : at + 8192], add_special_tokens=False)
                for k, e in zip(keys_[at : at + 8192], found, strict=True):
                    self.pieces[k] = self.encoded(e.ids)

    def texts(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[str, str, int]]:
        """Ids, decoded text and number of ids of each document."""
        data = raw.tobytes()
        ends = cuts(raw, offsets).tolist()
        chunks = [data[b:e] for b, e in zip([0, *ends[:-1]], ends, strict=True)]
        if len(self.chunks) > MAX_CHUNKS:
            self.chunks = {}
        rims: dict[bytes, tuple[bytes, bytes | None]] = {}
        inner: dict[bytes, list[str | bytes]] = {}
        wanted: set[str | bytes] = set()
        for chunk in chunks:
            if chunk in rims or not chunk:
                continue
            rims[chunk], body = rim_words(chunk)
            if body and chunk not in self.chunks:
                inner[chunk] = keys = self.cut(body)
                wanted.update(keys)
        # chunks in a row, and the words across their joins encoded anew
        of_doc = np.searchsorted(offsets[1:], np.asarray(ends), side="left").tolist()
        plan: list[list] = [[] for _ in range(len(offsets) - 1)]
        open_word, last = b"", 0

        def close(word: bytes, doc: int) -> None:
            keys = self.cut(word)
            wanted.update(keys)
            plan[doc] += keys

        for chunk, doc in zip(chunks, of_doc, strict=True):
            if doc != last:
                if open_word:
                    close(open_word, last)
                open_word, last = b"", doc
            if not chunk:
                continue
            head, tail = rims[chunk]
            open_word += head
            if tail is not None:
                if open_word:
                    close(open_word, doc)
                plan[doc].append((chunk,))
                open_word = tail
        if open_word:
            close(open_word, last)
        self.learn(wanted)
        pieces = self.pieces
        for chunk, keys in inner.items():
            self.chunks[chunk] = joined([pieces[k] for k in keys])
        nothing = ("", "", 0)
        return [joined([self.chunks.get(k[0], nothing) if isinstance(k, tuple) else pieces[k] for k in keys]) for keys in plan]


def rim_words(chunk: bytes) -> tuple[tuple[bytes, bytes | None], bytes]:
    """((word at the front edge, word at the back edge), what is between); no back edge: there is no white space."""
    head, body = b"", chunk
    if chunk[0] not in BLANK:
        parts = chunk.split(None, 1)
        head, body = parts[0], parts[1] if len(parts) > 1 else b""
        if len(head) == len(chunk):
            return (head, None), b""
    if not body or chunk[-1] in BLANK:
        return (head, b""), body
    parts = body.rsplit(None, 1)
    return (head, parts[-1]), parts[0] if len(parts) > 1 else b""


def check_independent(spec: dict) -> None:
    """Refuse a tokenizer that this reuse does not fit: it must drop white space and decode by plain joining."""
    split = json.dumps(spec.get("pre_tokenizer"))
    if spec.get("decoder") is not None or spec.get("post_processor") is not None or spec["model"].get("dropout") is not None:
        raise ValueError("the tokenizer has a decoder, post-processor or dropout")
    if '"Removed"' not in split or "\\\\s" not in split or '"add_prefix_space": true' in split:
        raise ValueError("the tokenizer does not drop white space between pieces")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    gc.disable()  # millions of small kept tuples, no cycles: searching them costs more than the encoding
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>, decoded) of each whole text. A null text is empty and has no ids.

    Repeated rows are encoded each; other columns are not read; an empty table gives none. The
    tokenizer file must be readable at that path on every executor.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        done = encoder(tokenizer_path).texts(*text_bytes(batch.column(1)))
        return pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([[int(x) for x in ids.split()] for ids, _, _ in done], pa.list_(pa.int32())),
            pa.array([text for _, text, _ in done], pa.string()),
        ], names=["id", "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), text_col), run, f"id {kind}, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encode_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): as `encode`, but only digests leave the task."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        done = encoder(tokenizer_path).texts(*text_bytes(batch.column(1)))
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array([n for _, _, n in done], pa.int64()),
            pa.array([_sha(ids) for ids, _, _ in done]), pa.array([_sha(text) for _, text, _ in done]),
        ], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), text_col), run,
                     f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", most=4 << 20).withColumnRenamed("id", id_col)
