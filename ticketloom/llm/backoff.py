"""Language-model scores from a weighted backoff automaton of words, with a word-frequency base beside them.

States are contexts of two words, one word and none that training rows have; an arc for each word seen after
a context carries the logarithm of its smoothed probability, and a failure arc leads to the context without
its oldest word and carries what absolute discounts leave for other words there: discount times the context's
distinct continuations over its count. Below single words stands the spelling of the word. Every run of one,
two and three tokens of the training rows is counted, so what is learned grows with the corpus.

Slices of documents send each of their distinct runs once, to the bucket of its context; buckets add them up
and answer with the counts of the runs and of their contexts, which are exactly the arcs and failure arcs that
the slice can need. Each slice builds this part of the automaton and is walked once from left to right, with
the state carried along. Contexts that hold a larger share of all tokens than a bucket should are found first
and dealt by context and word; their few totals are added up apart.

Spelling is a weighted backoff automaton too, of order 4 over 40 classes of bytes (65,641 states at most), with
failing steps resolved into a table. Long texts are walked as runs side by side, each entered over the symbols
before it, which reaches the very state carried there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import partitions, ship, staged
from ticketloom.llm.wordarrays import LOWER, ODD, SPACE, mix, slices, text_bytes, word_hashes, words

A = 40
END, GAP = 0, 1
BLOCK = 2048
SLICE = 4 << 20
END_WORD = np.uint64(0x5851F42D4C957F2D)
WALK = 256  # tokens of one run of the walk
#: A run's key: 36 bits that choose the bucket, its order less one, whether its context is hot, and 25 more bits.
ROUTE, ORDER, HOT = np.uint64(28), np.uint64(26), np.uint64(25)
LOW = (np.uint64(1) << HOT) - np.uint64(1)
HEAD = {"n_words": np.int64, "which": np.uint32, "kinds": np.uint64, "spelled": np.float32}


def byte_classes() -> np.ndarray:
    """Class of each byte: letters alone, '.' and ',' alone, digits, other marks and bytes of longer code points in groups."""
    out = np.full(256, 32, np.int64)
    out[33:127] = 31
    out[97:123] = np.arange(2, 28)
    out[48:58] = 28
    out[ord(".")], out[ord(",")] = 29, 30
    out[0x80:0xA0], out[0xA0:0xB0], out[0xB0:0xC0] = 36, 37, 38
    out[0xC0:], out[0xC2], out[0xC3] = 35, 33, 34
    return out


CLASSES = byte_classes()


class Stream:
    """Symbols of some texts: words with a gap between them, an end after the last."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray) -> None:
        raw = LOWER[raw]
        self.starts, self.ends, self.first = words(raw, offsets)
        self.raw = raw
        inside = ~SPACE[raw]
        upto = np.concatenate([[0], np.cumsum(inside)])
        self.bytes = raw[inside]
        counts = np.diff(self.first)
        marks = np.full(len(self.starts), GAP)
        marks[self.first[1:][counts > 0] - 1] = END
        at = np.concatenate([upto[self.ends], upto[offsets[:-1][counts == 0]]])
        marks = np.concatenate([marks, np.full(int((counts == 0).sum()), END)])
        self.symbols = np.insert(CLASSES[self.bytes], at, marks)
        self.sizes = np.diff(upto[offsets]) + np.maximum(counts, 1)
        self.heads = np.concatenate([[0], np.cumsum(self.sizes)])
        self.n_words = counts

    def fourgrams(self, chosen: np.ndarray) -> np.ndarray:
        """Counts of four symbols in a row in the chosen documents; ends stand before a document."""
        place = np.arange(len(self.symbols)) - np.repeat(self.heads[:-1], self.sizes)
        code = np.zeros(len(self.symbols), np.int64)
        for k in (3, 2, 1, 0):
            before = np.zeros_like(code)
            before[k:] = self.symbols[: len(code) - k]
            code = code * A + np.where(place >= k, before, END)
        return np.bincount(code[np.repeat(chosen, self.sizes)], minlength=A**4)


class Automaton:
    """States for the contexts seen in training, failure arcs, and the table with failing steps resolved."""

    def __init__(self, counts: np.ndarray, byte_counts: np.ndarray) -> None:
        """counts: of four symbols, by code; byte_counts: of each byte, for bytes that share a class."""
        n = [counts.reshape(A, A, A, A)]
        for _ in range(3):
            n.insert(0, n[0].sum(axis=0))  # n[k]: counts of k symbols and the next
        number, contexts = {0: np.zeros(1, np.int64)}, [np.zeros(1, np.int64)]
        size = 1
        for k in (1, 2, 3):
            seen = np.flatnonzero(n[k].reshape(A**k, A).sum(axis=1))
            number[k] = np.full(A**k, -1, np.int64)
            number[k][seen] = size + np.arange(len(seen))
            contexts.append(seen)
            size += len(seen)
        self.weight = np.zeros((size, A), np.float64)
        self.next = np.zeros((size, A), np.int32)
        unigram = (n[0] + 0.5) / (n[0].sum() + 0.5 * A)
        self.weight[0] = np.log10(unigram)
        self.next[0] = np.maximum(number[1], 0)
        for k in (1, 2, 3):
            c = contexts[k]
            if not len(c):
                continue
            own, states = n[k].reshape(A**k, A)[c].astype(float), number[k][c]
            fail = number[k - 1][c % A ** (k - 1)]
            total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
            lower = np.power(10.0, self.weight[fail])
            arc = np.log10((own + kinds * lower) / (total + kinds))
            back = np.log10(kinds / (total + kinds))
            self.weight[states] = np.where(own > 0, arc, back + self.weight[fail])
            # the longest known context that ends with the symbol
            longer = c[:, None] * A + np.arange(A)
            to = number[k + 1][longer] if k < 3 else number[3][longer % A**3]
            self.next[states] = np.where(to >= 0, to, self.next[fail])
        within = np.zeros(A)
        np.add.at(within, CLASSES, byte_counts + 0.5)
        self.spelling = np.log10((byte_counts + 0.5) / within[CLASSES])

    def spell(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """log10 probability of the bytes of each word and the gap after it, where a word begins."""
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        s = Stream(raw[np.repeat(starts - offsets[:-1], ends - starts) + np.arange(offsets[-1])], offsets)
        s.symbols = np.where(s.symbols == END, GAP, s.symbols)
        begin = 0
        for _ in range(3):
            begin = self.next[begin, GAP]
        rest = np.delete(self.weight[begin], [END, GAP])
        return self.score(s, GAP) - np.log10(np.power(10.0, rest).sum())

    def score(self, s: Stream, before: int = END) -> np.ndarray:
        """log10 probability of each document after symbols `before`."""
        docs, begins = [], []
        for d in np.flatnonzero(s.sizes).tolist():
            b = range(int(s.heads[d]), int(s.heads[d + 1]), BLOCK)
            begins += b
            docs += [d] * len(b)
        doc, begin = np.array(docs, np.int64), np.array(begins, np.int64)
        size = np.minimum(s.heads[doc + 1] - begin, BLOCK)
        order = np.argsort(-size, kind="stable")
        doc, begin, size = doc[order], begin[order], size[order]
        state, total = np.zeros(len(doc), np.int64), np.zeros(len(doc))
        head = s.heads[doc]
        flat, hop = self.weight.ravel(), (self.next.astype(np.int64) * A).ravel()
        for back in (3, 2, 1):
            symbol = np.where(begin - back >= head, s.symbols[np.maximum(begin - back, 0)], before)
            state = hop.take(state + symbol)
        going = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right") if len(size) else np.zeros(0, np.int64)
        for t, n in enumerate(going.tolist()):
            arc = state[:n] + s.symbols.take(begin[:n] + t)
            total[:n] += flat.take(arc)
            state[:n] = hop.take(arc)
        out = np.zeros(len(s.sizes))
        np.add.at(out, doc, total)
        spelled = np.concatenate([[0.0], np.cumsum(self.spelling[s.bytes])])
        edge = np.concatenate([[0], np.cumsum(s.sizes - np.maximum(s.n_words, 1))])
        return out + np.diff(spelled[edge])


class Heavy:
    """Counts of the keys that hold more than one in `size` of all seen; a count may be too low by that share.

    Of each lot only keys that may hold a share of it are told apart.
    """

    def __init__(self, size: int) -> None:
        self.size, self.total = size, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.total += len(keys)
        bins = (keys >> np.uint64(46)).astype(np.int64)
        keys = keys[np.bincount(bins, minlength=1 << 18)[bins] * self.size > len(keys)]
        kinds, n = np.unique(keys, return_counts=True)
        all_, which = np.unique(np.concatenate([self.keys, kinds]), return_inverse=True)
        counts = np.bincount(which, weights=np.concatenate([self.counts, n]), minlength=len(all_)).astype(np.int64)
        if len(all_) > self.size:
            counts -= np.partition(counts, len(counts) - self.size - 1)[len(counts) - self.size - 1]
            all_, counts = all_[counts > 0], counts[counts > 0]
        self.keys, self.counts = all_, counts


GRAM, BYTE, WORDS, DOCS, HEAVY = range(5)


def train(docs: DataFrame, text_col: str, train_when: Column, share: float = 1.0) -> tuple[np.ndarray, np.ndarray, int, int, np.ndarray, np.ndarray]:
    """Counts of four symbols, of bytes, of words and of documents over all training rows; the contexts with more than `share` of the tokens and their shares' number.

    Each task adds up its rows; Spark adds up the tasks. At most A**4 + 258 sums and 4 / share contexts reach the driver.
    """
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, spelled, n_words, n_docs = np.zeros(A**4, np.int64), np.zeros(256, np.int64), 0, 0
        heavy = Heavy(math.ceil(4 / share))
        for batch in batches:
            for piece in slices(batch, 0):
                raw, offsets = text_bytes(piece.column(0))
                s = Stream(raw, offsets)
                s.symbols[s.heads[1:][s.n_words > 0] - 1] = GAP  # spelling takes all words alike
                grams += s.fourgrams(np.ones(piece.num_rows, bool))
                spelled += np.bincount(s.bytes, minlength=256)
                n_words += len(s.starts)
                n_docs += piece.num_rows
                heavy.add(np.concatenate(contexts(*tokens_of(word_hashes(s.raw, s.starts, s.ends), s.n_words))[1:]))
        many = heavy.counts > share * heavy.total / 4
        found = [(GRAM, np.flatnonzero(grams), grams[grams > 0]), (BYTE, np.flatnonzero(spelled), spelled[spelled > 0]),
                 (WORDS, np.zeros(1), np.array([n_words])), (DOCS, np.zeros(1), np.array([n_docs])), (HEAVY, heavy.keys[many].view(np.int64), heavy.counts[many])]
        for kind, codes, n in found:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(codes.astype(np.int64)), pa.array(n)], names=["kind", "code", "n"])

    counted = docs.where(train_when).select(F.col(text_col).cast("string").alias("t")).mapInArrow(count, "kind int, code bigint, n bigint")
    sums = staged(counted.groupBy("kind", "code").agg(F.sum("n").alias("n")), "sums")
    out = [np.zeros(A**4, np.int64), np.zeros(256, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)]
    few = sums.where(F.col("kind") < HEAVY).toArrow()
    kind, code, n = (few.column(c).to_numpy() for c in ("kind", "code", "n"))
    for k, table in enumerate(out):
        table[code[kind == k]] = n[kind == k]
    n_words, n_docs = int(out[WORDS][0]), int(out[DOCS][0])
    # two contexts a token; lots, summaries and small shares of tasks may miss a quarter of the share each
    one = share * 2 * (n_words + n_docs)
    hot = sums.where((F.col("kind") == HEAVY) & (F.col("n") > one / 4)).select("code", "n").toArrow()
    keys, n = hot.column("code").to_numpy().view(np.uint64), hot.column("n").to_numpy()
    by = np.argsort(keys)
    return out[GRAM], out[BYTE], n_words, n_docs, keys[by], np.ceil(n[by] / max(one, 1.0)).astype(np.int64)


def tokens_of(h: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens, which are the words and an end after each document's, and where each document begins."""
    return np.insert(h, np.cumsum(n_words), END_WORD), np.concatenate([[0], np.cumsum(n_words + 1)])[:-1]


def shifted(x: np.ndarray, heads: np.ndarray, first) -> np.ndarray:
    """Of each token the value of the one before it; `first` at the head of a document."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[heads] = first
    return out


def contexts(tokens: np.ndarray, heads: np.ndarray) -> list[np.ndarray]:
    """Hashes of the contexts of no, one and two tokens before each token; ends stand before a document."""
    before = shifted(tokens, heads, END_WORD)
    return [np.zeros_like(tokens), mix(before + np.uint64(1)), mix(shifted(before, heads, END_WORD) * ODD + before + np.uint64(2))]


class HotContexts:
    """Contexts that are dealt by word to as many buckets as their share asks for: their hashes in order, and how many parts each has."""

    def __init__(self, hashes: np.ndarray, parts: np.ndarray, buckets: int) -> None:
        self.hashes, self.parts, self.buckets = hashes, parts.astype(np.uint64), np.uint64(buckets)
        self.words = np.uint64((1 << int(HOT)) // max(len(hashes), 1))  # how many words the low bits tell apart

    def keys(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Keys without the order: in the range of the part's bucket, told apart by the word; the low bits also hold the context's number."""
        number = np.searchsorted(self.hashes, context)
        part, rest = word % self.parts[number], mix(word ^ context * ODD)
        bucket = (mix(context + (part + np.uint64(1)) * ODD) >> np.uint64(32)) * self.buckets >> np.uint64(32)
        begin = ((bucket << np.uint64(32)) + self.buckets - np.uint64(1)) // self.buckets
        top = begin + (rest >> np.uint64(32)) % (np.uint64(1 << 32) // self.buckets)
        low = number.astype(np.uint64) * self.words + (rest >> np.uint64(4)) % self.words
        return top << np.uint64(32) | (rest & np.uint64(15)) << ROUTE | np.uint64(1) << HOT | low

    def codes(self, keys: np.ndarray) -> np.ndarray:
        """Order and number of the context of each hot key."""
        return ((keys >> ORDER & np.uint64(3)) << HOT | (keys & LOW) // self.words).astype(np.int64)


def gram_keys(tokens: np.ndarray, heads: np.ndarray, hot: HotContexts) -> list[np.ndarray]:
    """Keys of the runs of one, two and three tokens that end at each token.

    Runs of one token are routed by the token, others by their context, so that a context's runs are neighbours; hot contexts by themselves.
    """
    word = mix(tokens)
    out = []
    for k, c in enumerate(contexts(tokens, heads)):
        head = np.uint64(k) << ORDER
        key = (mix(c + np.uint64(k)) if k else word) >> ROUTE << ROUTE | head | (word if not k else word >> np.uint64(1)) & LOW
        wide = np.flatnonzero(found_in(hot.hashes, c)) if k else np.zeros(0, np.int64)
        key[wide] = hot.keys(c[wide], word[wide]) | head
        out.append(key)
    return out


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def found_in(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def own_contexts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keys in order: the number of each one's context, and which numbers are contexts of one or two tokens that are not hot."""
    code = keys >> HOT
    new = np.ones(len(keys), bool)
    new[1:] = code[1:] != code[:-1]
    code = code[new]
    return np.cumsum(new) - 1, (code >> np.uint64(1) & np.uint64(3) > 0) & (code & np.uint64(1) == 0)


def squeezed(x: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def restored(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers; cumsum takes them back."""
    return np.diff(x, prepend=np.zeros(1, x.dtype))


def texts_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(name, piece, bytes, begin and end of words, words of each document, word hashes) of slices; the name holds a digest of the slice."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for piece in slices(batch, 1, SLICE):
            raw, offsets = text_bytes(piece.column(1))
            raw = LOWER[raw]
            starts, ends, first = words(raw, offsets)
            h, n_words = word_hashes(raw, starts, ends), np.diff(first)
            tokens, _ = tokens_of(h, n_words)
            digest = int((mix(tokens) * (np.arange(len(tokens), dtype=np.uint64) * ODD + np.uint64(1))).sum())
            yield f"{task}-{number}-{digest:x}", piece, raw, starts, ends, n_words, h
            number += 1


class WordAutomaton:
    """The part of the automaton that a slice needs. Arcs are the slice's runs; states are contexts, by the number of the run they are.

    State 0 is the context of no word, 1 + r the one that is run r, and the last one the context before a document.
    """

    def __init__(self, which: np.ndarray, heads: np.ndarray, size: np.ndarray, n_runs: int, single: np.ndarray, count: np.ndarray,
                 context: np.ndarray, follow: np.ndarray, discount: list[float]) -> None:
        """which, count, context and follow have a row for each order and a column for each token: the run that ends there, how often it is
        seen, and how often its context is, and with how many followers. single: log p of each token alone.
        """
        self.which, self.heads, self.size = which, heads, size
        end = which[0][heads[0] + size[0] - 1] + 1 if len(size) else 0
        self.start = n_runs + 1
        one, two = shifted(which[0] + 1, heads, end), shifted(which[1] + 1, heads, self.start)
        self.known = np.zeros(n_runs + 2, bool)
        self.known[one[context[1] > 0]] = True
        self.known[two[context[2] > 0]] = True
        self.known[0] = True
        self.fail, self.back = np.zeros(n_runs + 2, np.int64), np.zeros(n_runs + 2)
        self.source, self.to = np.full(n_runs, -1), np.zeros(n_runs, np.int64)
        self.weight = np.zeros(n_runs)
        last = np.where(self.known[which[0] + 1], which[0] + 1, 0)  # what is known of the token alone
        self.source[which[0]], self.weight[which[0]], self.to[which[0]] = 0, single, last
        own = np.exp(single)
        with np.errstate(divide="ignore"):
            for k, state in ((1, one), (2, two)):
                some = context[k] > 0
                rest = np.divide(discount[k] * follow[k], context[k], out=np.ones(len(own)), where=some)
                own = np.divide(np.maximum(count[k] - discount[k], 0), context[k], out=np.zeros(len(own)), where=some) + rest * own
                self.back[state[some]] = np.log(rest[some])
                seen = count[k] > 0
                run = which[k][seen]
                self.source[run], self.weight[run] = state[seen], np.log(own[seen])
                pair = which[1][seen] + 1
                self.to[run] = np.where(self.known[pair], pair, last[seen])
        self.fail[two] = np.where(self.known[one], one, 0)
        # how many words a state holds
        self.words = np.zeros(n_runs + 2, np.int8)
        self.words[one], self.words[two] = 1, 2

    def walk(self) -> np.ndarray:
        """log p of each document in one pass from left to right; runs of `WALK` tokens go side by side, entered in the state carried there."""
        parts = -(-self.size // WALK)
        doc = np.repeat(np.arange(len(self.size)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = self.heads[doc] + nth * WALK
        length = np.minimum(self.heads[doc] + self.size[doc] - begin, WALK)
        order = np.argsort(-length, kind="stable")
        doc, begin, length = doc[order], begin[order], length[order]
        # two tokens before decide the state: the context of both, of the last one, or of none
        end = self.which[0][self.heads[0] + self.size[0] - 1] + 1 if len(self.size) else 0
        inside = begin > self.heads[doc]
        two = np.where(inside, self.which[1][begin - 1] + 1, self.start)
        one = np.where(inside, self.which[0][begin - 1] + 1, end)
        state = np.where(self.known[two], two, np.where(self.known[one], one, 0))
        total = np.zeros(len(doc))
        going = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right") if len(length) else []
        for t, n in enumerate(going):
            at, here = begin[:n] + t, state[:n]
            arc = np.zeros(n, np.int64)
            open_ = np.arange(n)
            for k in (2, 1, 0):
                # an arc of this order may leave the state; without it the failure arc is taken, if the state is a context of so many words
                mine = self.which[k][at[open_]]
                there = self.source[mine] == here[open_]
                arc[open_[there]] = mine[there]
                open_ = open_[~there]
                if not len(open_):
                    break
                fails = self.words[here[open_]] == k
                total[open_[fails]] += self.back[here[open_[fails]]]
                here[open_[fails]] = self.fail[here[open_[fails]]]
            total[:n] += self.weight[arc]
            state[:n] = self.to[arc]
        return np.bincount(doc, weights=total, minlength=len(self.size))


def score_documents(docs: DataFrame, train_when: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of each row's whole text.

    A null text is empty: one end token. Rows for which `train_when` is null are not learned from. With
    nothing to learn from, all counts are zero and only spelling is left. Repeated rows are learned
    from and scored each; other columns are not read; an empty table gives none. A very long text is a slice
    of its own and held in memory. The table is read three times and must give the same slices; if it
    changes meanwhile, the job fails.
    """
    spark = docs.sparkSession
    ship(spark)
    train_when = F.coalesce(train_when, F.lit(False))
    buckets = 4 * partitions(spark)
    grams, spelled, n_train_words, n_train_docs, hashes, parts = train(docs, text_col, train_when, 1 / buckets)
    hot = HotContexts(hashes, parts, buckets)
    model = Automaton(grams, spelled)
    shipped = spark.sparkContext.broadcast((model.weight, model.next, model.spelling))
    heavy = spark.sparkContext.broadcast(hot)
    total = n_train_words + n_train_docs

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, piece, _, _, _, n_words, h in texts_in(batches):
            learned = piece.column(2).to_numpy(zero_copy_only=False).astype(bool)
            keys, which = np.unique(np.concatenate(gram_keys(*tokens_of(h, n_words), heavy.value)), return_inverse=True)
            times = np.bincount(which, weights=np.tile(np.repeat(learned, n_words + 1), 3), minlength=len(keys)).astype(np.int64)
            edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1, dtype=np.uint64))
            own = [(b, slice(*edges[b : b + 2])) for b in np.flatnonzero(np.diff(edges)).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in own], pa.int32()), pa.array([name] * len(own), pa.string()),
                                              pa.array([squeezed(steps(keys[at])) for _, at in own], pa.binary()),
                                              pa.array([squeezed(times[at]) for _, at in own], pa.binary())], names=["bucket", "slice", "keys", "times"])

    def tally(table: pa.Table) -> pa.Table:
        names, bucket = table.column("slice").to_pylist(), table.column("bucket")[0].as_py()
        keys = [np.cumsum(restored(x.as_py(), np.uint64), dtype=np.uint64) for x in table.column("keys")]
        edges = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        kinds, which = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        own = np.concatenate([restored(x.as_py(), np.int64) for x in table.column("times")])
        c = np.bincount(which, weights=own, minlength=len(kinds)).astype(np.int64)
        order = (kinds >> ORDER & np.uint64(3)).astype(np.int64)
        sums = np.array([[np.count_nonzero(c[order == k]), np.count_nonzero(c[order == k] == 1), np.count_nonzero(c[order == k] == 2)] for k in range(3)])
        of, plain = own_contexts(kinds)
        first = np.flatnonzero(np.diff(of, prepend=-1))
        followed, follow = np.add.reduceat(c, first), np.add.reduceat((c > 0).astype(np.int64), first)
        blobs, more = [], []
        for k in range(len(names)):
            mine = which[edges[k] : edges[k + 1]]
            blobs.append(squeezed(c[mine]))
            ctx = of[mine]
            ctx = ctx[np.diff(ctx, prepend=-1) != 0]
            ctx = ctx[plain[ctx]]
            more.append((squeezed(followed[ctx]), squeezed(follow[ctx])))
        # hot contexts: what this bucket holds of each
        wide = kinds >> HOT & np.uint64(1) == 1
        code, at = np.unique(heavy.value.codes(kinds[wide]), return_inverse=True)
        n, m = np.bincount(at, weights=c[wide], minlength=len(code)), np.bincount(at, weights=c[wide] > 0, minlength=len(code))
        parts = [{"code": int(x), "n": int(y), "m": int(z)} for x, y, z in zip(code.tolist(), n.tolist(), m.tolist(), strict=True)]
        kind = pa.list_(pa.struct([("code", pa.int64()), ("n", pa.int64()), ("m", pa.int64())]))
        return pa.table({"slice": pa.array([*names, None], pa.string()), "bucket": pa.array([bucket] * (len(names) + 1), pa.int32()),
                         "counts": pa.array([*blobs, None], pa.binary()), "contexts": pa.array([*(m[0] for m in more), None], pa.binary()),
                         "follows": pa.array([*(m[1] for m in more), None], pa.binary()),
                         "found": pa.array([None] * len(names) + [sums.ravel().tolist()], pa.list_(pa.int64())), "wide": pa.array([None] * len(names) + [parts], kind)})

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Automaton.__new__(Automaton)
        m.weight, m.next, m.spelling = shipped.value
        for name, piece, raw, starts, ends, n_words, h in texts_in(batches):
            kinds, at, which = np.unique(h, return_index=True, return_inverse=True)
            spelled = m.spell(raw, starts[at], ends[at]).astype(np.float32)
            blobs = [squeezed(x) for x in (n_words.astype(np.int64), which.astype(np.uint32), steps(kinds), spelled)]
            ids = pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([name]), ids, *(pa.array([x], pa.binary()) for x in blobs)], names=["slice", "ids", *HEAD])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), train_when.alias("learn"))
    answers = ("slice string, bucket int, counts binary, contexts binary, follows binary, found array<bigint>, "
               "wide array<struct<code:bigint,n:bigint,m:bigint>>")
    counts = staged(rows.mapInArrow(scan, "bucket int, slice string, keys binary, times binary").groupBy("bucket").applyInArrow(tally, answers), "gramcounts")
    found = np.array([n or 0 for n in counts.agg(*(F.sum(F.col("found")[k]) for k in range(9))).collect()[0]]).reshape(3, 3)
    kinds = [int(n) for n in found[:, 0]]
    # absolute discounts from the runs seen once and twice; spelling needs its share of single words
    discount = [min(max(n1 / (n1 + 2 * n2), 0.1), 0.95) if n1 + n2 else 0.5 for n1, n2 in found[:, 1:].tolist()]
    each = np.log10(total + 0.5 * (kinds[0] + 1))
    wide = counts.select(F.inline("wide")).groupBy("code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).toArrow()
    by = np.argsort(wide.column("code").to_numpy())
    totals = spark.sparkContext.broadcast(tuple(wide.column(c).to_numpy()[by] for c in ("code", "n", "m")))

    def finish(head: pa.Table, counted: pa.Table) -> pa.Table:
        if head.num_rows != 1 or not counted.num_rows:
            raise RuntimeError("the documents changed while they were read")
        ids = head.column("ids").combine_chunks().flatten()
        n_words, named, kinds_, spelled = (restored(head.column(c)[0].as_py(), k) for c, k in HEAD.items())
        tokens, first = tokens_of(np.cumsum(kinds_, dtype=np.uint64)[named], n_words)
        keys, which = np.unique(np.concatenate(gram_keys(tokens, first, heavy.value)), return_inverse=True)
        which = which.reshape(3, -1)
        order = np.argsort(counted.column("bucket").to_numpy())
        c, followed, follow = (np.concatenate([restored(counted.column(x)[int(k)].as_py(), np.int64) for k in order]) for x in ("counts", "contexts", "follows"))
        of, plain = own_contexts(keys)
        per_context = np.zeros((2, len(plain)), np.int64)
        per_context[:, plain] = followed, follow
        per_run = per_context[:, of]
        hot_runs = np.flatnonzero(keys >> HOT & np.uint64(1) == 1)
        if len(hot_runs):
            codes, n, m = totals.value
            at = np.searchsorted(codes, heavy.value.codes(keys[hot_runs]))
            per_run[:, hot_runs] = n[at], m[at]
        count = c[which].astype(float)
        context, follow = per_run[0][which].astype(float), per_run[1][which].astype(float)
        end = len(kinds_)
        word = np.insert(named.astype(np.int64), np.cumsum(n_words), end)
        letters = np.append(spelled * np.log(10) + np.log((n_train_words + 0.5) / (total + 1)), np.log((n_train_docs + 0.5) / (total + 1)))
        with np.errstate(divide="ignore"):
            single = np.logaddexp(np.log(np.maximum(count[0] - discount[0], 0) / max(total, 1)), np.log(discount[0] * kinds[0] / total if total else 1.0) + letters[word])
        automaton = WordAutomaton(which, first, n_words + 1, len(keys), single, count, context, follow, discount)
        size = n_words + 1
        known = count[0]
        return pa.table({"id": ids, "n_tokens": pa.array(size), "n_known": pa.array(np.add.reduceat((known > 0).astype(np.int64), first)),
                         "train_tokens": pa.array(np.full(len(size), total), pa.int64()),
                         "base_score": pa.array(np.add.reduceat(np.log10(known + 0.5), first) - size * each),
                         "score": pa.array(automaton.walk() / np.log(10))})

    kind = docs.schema[id_col].dataType.simpleString()
    texts = rows.mapInArrow(heads, f"slice string, ids array<{kind}>, " + ", ".join(f"{c} binary" for c in HEAD))
    done = texts.groupBy("slice").cogroup(counts.where("slice IS NOT NULL").groupBy("slice")).applyInArrow(
        finish, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return done.withColumnRenamed("id", id_col)


def score_held_out(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the scores; learns from all documents whose fold is not 1."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    return score_documents(docs, fold != 1).withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
