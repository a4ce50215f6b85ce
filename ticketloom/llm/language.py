"""Language identification by cross-parsing: suffix automata of labelled text, one per language.

A document is parsed greedily against each automaton: a phrase goes on while the automaton knows it
as a substring of the language's text, then a new one begins. Phrases per letter, times the bits that
name a place in that text, estimate the cross entropy; the smallest wins. Texts are parsed in runs of
`BLOCK` letters (a phrase ends where its run ends) so that many runs advance together in numpy.

Learning reads a bounded sample: `train_docs` labelled texts for each language, the ones whose text
hashes lowest, each with a stretch of `train_letters / train_docs` letters from its middle. Everything
else covers whole texts.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.wordarrays import map_texts

TRAIN_DOCS, TRAIN_LETTERS, MAX_LANGUAGES = 64, 16_384, 64
BLOCK = 2048
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def letters_of(text: str) -> np.ndarray:
    """Lower-case letters, with one space (32) for each run of anything else between them."""
    p = points(text)
    good = letter_table()[p]
    p = np.where(good, p, np.uint32(32))
    keep = good.copy()
    keep[1:] |= good[:-1]
    return p[keep]


class Automata:
    """Suffix automata of some texts, each over its own text's alphabet, with failing steps resolved into a table."""

    def __init__(self, texts: dict[str, np.ndarray]) -> None:
        self.names = sorted(texts)
        self.alphabets = [np.unique(texts[n]) for n in self.names]
        self.tables = [self._table(np.searchsorted(a, texts[n]).tolist(), len(a) + 1) for n, a in zip(self.names, self.alphabets, strict=True)]
        self.bits = [float(np.log2(max(2, len(texts[n])))) for n in self.names]

    @staticmethod
    def _table(text: list[int], size: int) -> np.ndarray:
        """next state times alphabet size, doubled; odd when a new phrase begins with the letter. The last letter stands for those the text lacks."""
        steps: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(steps)
            steps.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = new
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(steps)
                    steps.append(dict(steps[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and steps[p].get(c) == q:
                        steps[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        between = len(steps)  # before a phrase: every letter begins one; also after a letter that the text lacks
        table = np.full((between + 1, size), -1, np.int32)
        for s, to in enumerate(steps):
            if to:
                table[s, list(to)] = list(to.values())
        begin = np.where(table[0] >= 0, table[0], between)
        return np.where(table >= 0, table * size * 2, begin[None, :] * size * 2 + 1).astype(np.int32).ravel()

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text in each language."""
        out = np.zeros((len(texts), len(self.names)), np.int64)
        runs = [(d, t[k : k + BLOCK]) for d, t in enumerate(texts) for k in range(0, len(t), BLOCK)]
        runs.sort(key=lambda r: -len(r[1]))
        if not runs:
            return out
        sizes = np.array([len(r) for _, r in runs])
        going = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
        doc = np.array([d for d, _ in runs])
        # letters that occur here, by number; each language has its own classes for them
        points, flat = np.unique(np.concatenate([r for _, r in runs]), return_inverse=True)
        grid = np.zeros((int(sizes[0]), len(runs)), np.uint8 if len(points) < 256 else np.uint16 if len(points) < 65536 else np.uint32)
        at = 0
        for k, (_, r) in enumerate(runs):
            grid[: len(r), k] = flat[at : at + len(r)]
            at += len(r)
        for lang, (alphabet, table) in enumerate(zip(self.alphabets, self.tables, strict=True)):
            size = len(alphabet) + 1
            place = np.searchsorted(alphabet, points)
            known = alphabet[np.minimum(place, size - 2)] == points
            classes = np.where(known, place, size - 1).astype(np.uint8 if size < 256 else np.uint16 if size < 65536 else np.uint32)
            state, count = np.full(len(runs), len(table) - size, np.int32), np.zeros(len(runs), np.int32)
            own = classes[grid]
            for t, n in enumerate(going.tolist()):
                step = table.take(state[:n] + own[t, :n])
                count[:n] += step & 1
                state[:n] = step >> 1
            np.add.at(out[:, lang], doc, count)
        return out


def training_texts(labelled: DataFrame, lang_col: str, text_col: str, train_docs: int, train_letters: int) -> dict[str, np.ndarray]:
    """Letters to learn each language from; at most train_docs stretches of text reach the driver for each.

    Equal texts of one language count once, so copies do not fill a sample.
    """
    stretch = max(1, train_letters // train_docs)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    names = [r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    cut = rows.select("lang", F.xxhash64("text").alias("h"), F.expr(f"substring(text, int(greatest(1, (length(text) - {2 * stretch}) div 2)), {2 * stretch})").alias("part"))
    first = Window.partitionBy("lang").orderBy("h")
    lowest = cut.select("lang", "h").distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= train_docs)
    last = {r["lang"]: r["h"] for r in lowest.groupBy("lang").agg(F.max("h").alias("h")).collect()}
    if not last:
        return {}
    ends = F.create_map(*[x for n, h in sorted(last.items()) for x in (F.lit(n), F.lit(h))])
    chosen = cut.where(F.col("h") <= F.element_at(ends, F.col("lang"))).groupBy("lang", "h").agg(F.min("part").alias("part"))
    parts: dict[str, list[np.ndarray]] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["lang"], r["h"])):
        parts.setdefault(r["lang"], []).append(np.append(letters_of(r["part"])[:stretch], np.uint32(32)))
    texts = {n: np.concatenate(p) for n, p in parts.items()}
    return {n: t for n, t in texts.items() if (t != 32).any()}


def identify(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             train_docs: int = TRAIN_DOCS, train_letters: int = TRAIN_LETTERS) -> DataFrame:
    """(id, lang_pred, score): the language of each row's whole text.

    `und` with score 0 for a null text, one without letters, or when nothing is labelled. The score is
    the winner's share of 2 ** -entropy over all languages; equal entropies go to the smaller name.
    Repeated rows are judged each; other columns are not read; an empty table gives none; a long text is
    parsed in runs of `BLOCK` letters. The tables sent to executors hold at most 2 * train_letters states for
    each of MAX_LANGUAGES languages, each as wide as the letters of that language's own sample.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(learn(labelled, text_col, lang_col, train_docs, train_letters))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score = decide(restored(shipped.value), batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(F.col(id_col).alias("id"), text_col), run,
                     f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def with_language(docs: DataFrame, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  train_docs: int = TRAIN_DOCS, train_letters: int = TRAIN_LETTERS) -> DataFrame:
    """The rows whose language `identify` tells, with it in `lang_col` and all other columns as they are; rows that it calls `und` go."""
    shipped = docs.sparkSession.sparkContext.broadcast(learn(labelled, text_col, lang_col, train_docs, train_letters))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, _ = decide(restored(shipped.value), batch.column(batch.schema.get_field_index(text_col)))
        at = batch.schema.get_field_index(lang_col)
        told = pa.RecordBatch.from_arrays([pa.array(names, pa.string()) if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)
        return told.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))

    return map_texts(docs, run, docs.schema, text=docs.columns.index(text_col))


def learn(labelled: DataFrame, text_col: str, lang_col: str, train_docs: int, train_letters: int) -> dict:
    """The tables of the automata, as plain arrays to send."""
    return vars(Automata(training_texts(labelled, lang_col, text_col, train_docs, train_letters)))


def restored(parts: dict) -> Automata:
    model = Automata.__new__(Automata)
    vars(model).update(parts)
    return model


def decide(m: Automata, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    texts = [letters_of(t or "") for t in column.to_pylist()]
    sizes = np.array([len(t) for t in texts])
    if not m.names:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    entropy = m.phrases(texts) * np.array(m.bits) / np.maximum(sizes, 1)[:, None]
    best = entropy.argmin(axis=1)
    share = np.exp2(entropy.min(axis=1, keepdims=True) - entropy)
    return [m.names[b] if n else UNKNOWN for b, n in zip(best, sizes, strict=True)], np.where(sizes > 0, 1 / share.sum(axis=1), 0.0)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; null stays null."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def identify_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learns from the documents of the other folds."""
    pred = identify(docs, docs.where(fold() != 0))
    return pred.select("doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score")
