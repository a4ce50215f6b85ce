"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, acceptor again.

Two words one edit apart share their first half or their last half: with m the shorter length, the first
m // 2 code points if the edit comes later, else the last m - m // 2. So words are dealt by these halves, and
reading a half leads to the initial state from which the rest is composed; for last halves words are read
backwards. The rests are packed into one minimised acceptor for a whole bucket of initial states. Composition
runs level by level over pairs of states: equal paths, and paths after their one edit. Each state knows how
many words it accepts, so a path carries the number of its word and no text. An edit stands as far right as
it can, and a pair that shares both halves counts only under the first, so each pair is met once. Only counts
and the best partner leave a task.

An initial state with very many words is split into blocks of words, and pairs of blocks are composed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import ship, staged
from ticketloom.llm.wordarrays import ODD, mix

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
ONE_IN = 199
GROUP_WORDS, BUCKET_WORDS, MOST_HOT = 16_384, 32_768, 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUNS = "[A-Za-zÀ-ÿ]+"


class Acceptor:
    """Minimal acceptor of sorted distinct byte strings with a root for each tag; `number` of a path counts the strings before it."""

    def __init__(self, tags: np.ndarray, strings: list[bytes]) -> None:
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        flat = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64)
        heads = np.cumsum(size) - size
        self.tags, first, node = np.unique(tags, return_index=True, return_inverse=True)
        self.first = first
        # trie nodes by level: the parent's place in the level above, the byte, whether a string ends
        rows, levels, ends = np.arange(len(strings)), [], []
        n, depth = len(self.tags), 0
        while True:
            final = np.zeros(n, bool)
            final[node[size[rows] == depth]] = True
            ends.append(final)
            going = size[rows] > depth
            rows, node = rows[going], node[going]
            if not len(rows):
                break
            char = flat[heads[rows] + depth]
            new = np.ones(len(rows), bool)
            new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
            levels.append((node[new], char[new]))
            node = np.cumsum(new) - 1
            n, depth = int(new.sum()), depth + 1
        # bottom up: a node's signature is made of its arcs; equal signatures are one state
        at = np.concatenate([[0], np.cumsum([len(f) for f in ends])])
        sign, words = np.zeros(at[-1], np.uint64), np.concatenate(ends).astype(np.int64)
        final = np.concatenate(ends)
        sign += final
        for d in range(len(levels), 0, -1):
            own = slice(at[d], at[d + 1])
            sign[own] = mix(sign[own] * ODD + np.uint64(1))
            parent, char = levels[d - 1]
            np.add.at(sign, at[d - 1] + parent, mix(sign[own] ^ mix(char.astype(np.uint64) + np.uint64(7))))
            np.add.at(words, at[d - 1] + parent, words[own])
        sign[: at[1]] = mix(sign[: at[1]] * ODD + np.uint64(1))
        _, model, state = np.unique(sign, return_index=True, return_inverse=True)
        parents = np.concatenate([at[d] + p for d, (p, _) in enumerate(levels)] or [np.zeros(0, np.int64)])
        chars = np.concatenate([c for _, c in levels] or [np.zeros(0, np.int64)])
        targets = np.arange(at[1], at[-1])
        # arcs of all nodes are in order of parent and byte, since strings are sorted
        begin = np.searchsorted(parents, np.arange(at[-1] + 1))
        same = model[state]
        if not (np.array_equal(np.diff(begin), np.diff(begin)[same]) and np.array_equal(final, final[same])):
            raise RuntimeError("two states share a signature")
        twin = begin[same][parents] + np.arange(len(parents)) - begin[parents]
        if not (np.array_equal(chars, chars[twin]) and np.array_equal(state[targets], state[targets[twin]])):
            raise RuntimeError("two states share a signature")
        # arcs of the states, in order of state and byte, with the number of words before each
        degree = np.diff(begin)[model]
        self.begin = np.concatenate([[0], np.cumsum(degree)])
        arc = np.repeat(begin[model], degree) + np.arange(self.begin[-1]) - np.repeat(self.begin[:-1], degree)
        self.char, self.to = chars[arc], state[targets[arc]]
        through = words[targets[arc]]
        upto = np.cumsum(through) - through
        owner = np.repeat(np.arange(len(model)), degree)
        self.skip = upto - np.repeat(upto[np.minimum(self.begin[:-1], max(len(upto) - 1, 0))], degree) + final[model][owner] if len(arc) else upto
        self.final, self.degree = final[model], degree
        self.roots = state[: len(self.tags)]
        self.key = owner * 256 + self.char

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of the given states, arc) for all their arcs."""
        d = self.degree[states]
        at = np.repeat(np.arange(len(states)), d)
        return at, np.repeat(self.begin[states] - (np.cumsum(d) - d), d) + np.arange(len(at))

    def arc(self, states: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arc of each state by its byte, and whether there is one."""
        want = states * 256 + chars
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return at, self.key[at] == want


def compose(a: Acceptor, subs: list[tuple[int, int]], inserts: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words (u, v) that differ by one replaced byte under `subs`, or of which v has one more under `inserts`.

    Both list pairs of roots. Under a root paired with itself each pair of words comes once.
    """
    out: list[tuple[np.ndarray, np.ndarray]] = []
    if not len(a.key):
        # only empty rests: nothing to replace or insert
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    roots = np.array([*subs, *inserts], np.int64).reshape(-1, 2)
    insert = np.arange(len(roots)) >= len(subs)
    once = roots[:, 0] == roots[:, 1]
    p, q, i, j = a.roots[roots[:, 0]], a.roots[roots[:, 1]], a.first[roots[:, 0]], a.first[roots[:, 1]]
    e = [np.zeros(0, np.int64)] * 5  # after the edit: states, numbers, and the byte the next may not be

    def both(p: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
        which, x = a.arcs(p)
        y, there = a.arc(q[which], a.char[x])
        which, x, y = which[there], x[there], y[there]
        return which, a.to[x], a.to[y], i[which] + a.skip[x], j[which] + a.skip[y], a.char[x]

    while len(p) or len(e[0]):
        which, s, t, u, v, char = both(*e[:4])
        free = char != e[4][which]
        new = [[s[free], t[free], u[free], v[free], np.full(int(free.sum()), -1)]]
        # an edit here: any two different bytes, or one more byte of the second word
        d = np.flatnonzero(~insert)
        at, x = a.arcs(p[d])
        back, y = a.arcs(q[d][at])
        at, x = d[at[back]], x[back]
        fit = np.where(once[at], a.char[x] < a.char[y], a.char[x] != a.char[y])
        at, x, y = at[fit], x[fit], y[fit]
        new.append([a.to[x], a.to[y], i[at] + a.skip[x], j[at] + a.skip[y], np.full(len(at), -1)])
        d = np.flatnonzero(insert)
        at, y = a.arcs(q[d])
        at = d[at]
        more = [p[at], a.to[y], i[at], j[at] + a.skip[y], a.char[y]]
        hit = a.final[more[0]] & a.final[more[1]]
        out.append((more[2][hit], more[3][hit]))
        e = [np.concatenate(c) for c in zip(*new, strict=True)]
        hit = a.final[e[0]] & a.final[e[1]]
        out.append((e[2][hit], e[3][hit]))
        e = [np.concatenate(c) for c in zip(e, more, strict=True)]
        which, p, q, i, j, _ = both(p, q, i, j)
        insert, once = insert[which], once[which]
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def near_in_bucket(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best) over all initial states of a bucket."""
    words, count = table.column("word").to_pylist(), table.column("n").to_numpy()
    raw = [w.encode("latin-1") for w in words]
    back = [w == "r" for w in table.column("way").to_pylist()]
    m, side = table.column("m").to_numpy(), table.column("side").to_numpy()
    names = list(zip(table.column("way").to_pylist(), m.tolist(), table.column("half").to_pylist(), table.column("i").to_pylist(), table.column("j").to_pylist(), strict=True))
    number: dict[tuple, int] = {}
    group = [number.setdefault(k, len(number)) for k in names]
    half = (m // 2).tolist()
    rest = [w[::-1][k - h :] if r else w[h:] for w, r, k, h in zip(raw, back, m.tolist(), half, strict=True)]
    tag = [4 * g + 2 * s + (len(w) > k) for g, s, w, k in zip(group, side.tolist(), raw, m.tolist(), strict=True)]
    order = sorted(range(len(raw)), key=lambda k: (tag[k], rest[k]))
    a = Acceptor(np.array([tag[k] for k in order], np.int64), [rest[k] for k in order])
    root = {t: k for k, t in enumerate(a.tags.tolist())}
    subs, inserts = [], []
    for key, g in number.items():
        own = [root.get(4 * g + t, -1) for t in range(4)]  # short and long words of both sides
        if key[3] == key[4]:
            subs.append((own[0], own[0]))
            inserts.append((own[0], own[1]))
        else:
            subs.append((own[0], own[2]))
            inserts += [(own[0], own[3]), (own[2], own[1])]
    u, v = compose(a, [p for p in subs if min(p) >= 0], [p for p in inserts if min(p) >= 0])
    order = np.array(order)
    u, v = order[u], order[v]
    if any(back):
        kinds: dict[bytes, int] = {}
        front = np.array([kinds.setdefault(w[:h], len(kinds)) for w, h in zip(raw, half, strict=True)])
        keep = ~np.array(back)[u] | (front[u] != front[v])
        u, v = u[keep], v[keep]
    u, v = np.concatenate([u, v]), np.concatenate([v, u])
    place = np.empty(len(raw), np.int64)
    place[sorted(range(len(raw)), key=raw.__getitem__)] = np.arange(len(raw))
    by = np.lexsort((place[v], -count[v], u))
    u, v = u[by], v[by]
    head = np.flatnonzero(np.diff(u, prepend=-1))
    near = np.diff(np.append(head, len(u)))
    own, best = u[head].tolist(), v[head].tolist()
    yield pa.RecordBatch.from_arrays([pa.array([words[k] for k in own], pa.string()), pa.array(near, pa.int64()), pa.array([words[k] for k in best], pa.string()),
                                      pa.array(count[v[head]], pa.int64())], names=["word", "n_near", "best", "best_n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
               one_in: int | None = ONE_IN) -> DataFrame:
    """(word, n): letter runs of whole texts, A-Z lowered; one in `one_in`, chosen by crc32 of id and run, loses a letter (None: none does).

    Runs of one text and words of all texts are counted where they are read before they are shuffled. A null id is an empty string there.
    """
    lowered = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUNS), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= least_length)
    if one_in:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        k = (F.col("h") % F.length("run")).cast("int")
        rest = F.concat(F.substring("run", F.lit(1), k), F.substring("run", k + 2, F.length("run")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % one_in == 0, rest).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)
    else:
        runs = runs.select(F.col("run").alias("word"))
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def near_words(words: DataFrame, group_words: int = GROUP_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(word, n_near, best, best_n), several rows a word, for distinct words with counts."""
    spark = words.sparkSession
    ship(spark)
    n = F.length("word")
    shorter = words.withColumn("m", F.explode(F.array(n, n - 1))).where((F.col("m") >= words.agg(F.min(n)).scalar()) & (F.col("m") > 0))
    half = F.array(F.struct(F.lit("f").alias("way"), F.expr("left(word, CAST(floor(m / 2) AS INT))").alias("half")),
                   F.struct(F.lit("r").alias("way"), F.expr("right(word, CAST(m - floor(m / 2) AS INT))").alias("half")))
    dealt = staged(shorter.select("word", "n", "m", F.inline(half)), "halves")
    key = ["way", "m", "half"]
    total = dealt.count()
    most = max(group_words, total // MOST_HOT)
    # more words than `most`: fewer than MOST_HOT initial states
    hot = dealt.groupBy(*key).agg(F.count("*").alias("c")).where(F.col("c") > most).select(*key, F.ceil(F.col("c") / most).cast("int").alias("blocks"))
    blocks = F.coalesce("blocks", F.lit(1))
    rows = dealt.join(F.broadcast(hot), key, "left").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("word", "n", *key, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    bucket = F.pmod(F.xxhash64(*key, "i", "j"), F.lit(max(1, -(-total // bucket_words))))

    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(near_in_bucket(table)))

    return rows.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(run, "word string, n_near bigint, best string, best_n bigint")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct words, of code points up to U+00FF, with counts.

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n (ties:
    first in code-point order) if its n is `ratio` times the word's or more. No words give an empty table.
    """
    words = staged(words.select("word", "n"), "vocabulary")
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("best"), F.lit(None).cast("long").alias("best_n"))
    found = near_words(words).withColumn("n", F.lit(None).cast("long")).select(none.columns)
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    rows = none.unionByName(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    formed = -F.col("b.less") >= F.col("n") * ratio
    rows = staged(rows.select("word", "n", "n_near", F.when(formed, F.col("b.best")).alias("form"), F.when(formed, -F.col("b.less")).alias("form_n")), "forms")
    # each step's count is at least `ratio` times the one before, so a chain has few steps; each round doubles those taken
    roots = staged(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if roots.join(onward, "root", "left_semi").isEmpty():
            break
        roots = staged(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`variants` of the `vocabulary` of all whole texts.

    Null and empty texts have no words; equal rows count each; a long text is one row's array of runs; other columns are
    not read; an empty table gives none.
    """
    return variants(vocabulary(docs, id_col, text_col))
