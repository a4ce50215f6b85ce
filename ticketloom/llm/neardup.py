"""Near duplicates by an LSH forest of sorted minhash signatures, confirmed on full shingle sets.

Documents with equal shingle sets are one class from the start. Each class has 128 minhash values;
each of `TREES` trees sorts the classes by its own order of these values. Neighbours in a sorted order
whose common prefix has at least `DEPTH` values are candidates: where many classes crowd under one
prefix, the nearest `REACH` in order share longer ones, so depth adapts to the region. More than `REACH`
classes that tie on all values of a key are sorted again by the next values, until no such crowd is left or
the signature is used up; those that tie on all of it stand side by side and are alike. Neighbours across
the bounds of ranges meet in a pass over the rows beside each bound. Candidates whose
signatures agree enough join clusters, and inside a cluster every pair is decided exactly on the full
sets, in blocks of bounded size. Only a spanning set of the confirmed links leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketloom.llm.frames import components, partitions, ship, staged
from ticketloom.llm.wordarrays import LOWER, ODD, map_texts, mix, text_bytes, windows, word_hashes, words

SHINGLE = 5
PERCENT = 75
VALUES, TREES, DEPTH, REACH = 128, 24, 4, 4
FURTHER = VALUES - 2 * DEPTH  # values that a crowd is sorted by at a time: all the others
#: Least share of equal minhash values of a candidate; pairs at the limit fall below it once in some 100,000.
LIKELY = 0.56
#: Shingles of one block of a cluster.
BLOCK = 4_000_000

FACTORS = (mix(np.arange(1, VALUES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
SHIFTS = (mix(np.arange(1000, 1000 + VALUES, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted, one after another; and where each document's begin."""
    raw = LOWER[raw]
    starts, ends, first = words(raw, offsets)
    h = word_hashes(raw, starts, ends)
    grams, at = windows(h, first, SHINGLE)
    edges = np.searchsorted(at, first)
    sets = []
    for d in range(len(offsets) - 1):
        n = first[d + 1] - first[d]
        if n >= SHINGLE:
            sets.append(np.unique(grams[edges[d] : edges[d + 1]]))
        elif n:
            total = np.full(1, n, np.uint64)
            for x in h[first[d] : first[d + 1]]:
                total = mix(total * ODD + x)
            sets.append(total)
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def set_keys(values: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set; zero for an empty one."""
    out = np.zeros((2, len(edges) - 1), np.uint64)
    full = np.flatnonzero(np.diff(edges))
    if len(full):
        out[0, full] = np.add.reduceat(mix(values), edges[full])
        out[1, full] = np.add.reduceat(mix(values ^ ODD), edges[full])
    return out[0].view(np.int64), out[1].view(np.int64)


def minhashes(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """128 values of 16 bits for each set."""
    full = np.flatnonzero(np.diff(edges))
    out = np.zeros((len(edges) - 1, VALUES), np.uint16)
    if len(full):
        x = (values >> np.uint64(32)).astype(np.uint32)
        work = np.empty_like(x)
        for k in range(VALUES):
            np.multiply(x, FACTORS[k], out=work)
            np.add(work, SHIFTS[k], out=work)
            out[full, k] = np.minimum.reduceat(work, edges[full]).astype(np.uint16)
    return out


def signed(docs: DataFrame) -> DataFrame:
    """(id, mark, n_shingles, k1, k2, sig) of (id, t, mark)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, edges = shingle_sets(*text_bytes(batch.column(1)))
        k1, k2 = set_keys(values, edges)
        sig = minhashes(values, edges)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.diff(edges)), pa.array(k1), pa.array(k2), pa.array([s.tobytes() for s in sig], pa.binary())],
                                          names=["id", "mark", "n_shingles", "k1", "k2", "sig"])

    return map_texts(docs, run, "id bigint, mark bigint, n_shingles bigint, k1 bigint, k2 bigint, sig binary")


def key_bytes(values: np.ndarray) -> pa.Array:
    """Rows of values as bytes that sort as they do."""
    raw = pa.py_buffer(np.ascontiguousarray(values).astype(">u2").tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * values.shape[1]), len(values), [None, raw]).cast(pa.binary())


def byte_rows(column: pa.Array) -> np.ndarray:
    """Bytes of equal length as rows of a matrix."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -1)


def signatures(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(byte_rows(column)).view(np.uint16)


ROWS = "tree int, run bigint, key binary, id bigint"
FOUND = "kind int, tree int, run bigint, key binary, a bigint, b bigint"
PAIR, CROWD, EDGE = range(3)


def tree_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Each tree's row of each class: its first DEPTH values make the run, the next DEPTH the key."""
    sig = signatures(batch.column(1))
    for t in range(TREES):
        own = np.roll(sig, -DEPTH * t, axis=1)
        prefix = np.frombuffer(np.ascontiguousarray(own[:, :DEPTH]).tobytes(), np.uint64)
        run = mix(prefix ^ mix(np.full(len(sig), t + 1, np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), t, np.int32)), pa.array(run.view(np.int64)), key_bytes(own[:, DEPTH : 2 * DEPTH]), batch.column(0)],
                                         names=["tree", "run", "key", "id"])


def further_rows(start: int):
    """Rows of a crowd with the tree's values from `start` on as key, at most FURTHER of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree = batch.column("tree").to_numpy().astype(np.int64)
            at = (DEPTH * tree[:, None] + np.arange(start, min(start + FURTHER, VALUES))) % VALUES
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("run"), key_bytes(np.take_along_axis(signatures(batch.column("sig")), at, axis=1)), batch.column("id")],
                                             names=["tree", "run", "key", "id"])

    return rows


def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order: pairs at most REACH apart in one run; rows of runs and keys that more than REACH + 1 share; the rows at both ends."""
    held: pa.Table | None = None
    seen = 0

    def out(kind: int, rows: pa.Table, a: pa.ChunkedArray, b: pa.ChunkedArray) -> list[pa.RecordBatch]:
        rows = rows.combine_chunks()
        return pa.Table.from_arrays([pa.array(np.full(rows.num_rows, kind, np.int32)), *(rows.column(c) for c in ("tree", "run", "key")), a, b],
                                    names=["kind", "tree", "run", "key", "a", "b"]).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        new_rows = pa.Table.from_batches([batch])
        if seen <= REACH:
            first = new_rows.slice(0, REACH + 1 - seen)
            yield from out(EDGE, first, first.column("id"), first.column("id"))
        seen += new_rows.num_rows
        old = 0 if held is None else held.num_rows
        table = (new_rows if held is None else pa.concat_tables([held, new_rows])).combine_chunks()
        run, ident = table.column("run").to_numpy(), table.column("id").to_numpy()
        a, b = [], []
        for k in range(1, REACH + 1):
            new = np.arange(max(k, old), len(run))
            new = new[run[new] == run[new - k]]
            a.append(ident[new])
            b.append(ident[new - k])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            nothing = pa.nulls(len(a))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), PAIR, np.int32)), nothing.cast(pa.int32()), nothing.cast(pa.int64()), nothing.cast(pa.binary()),
                                              pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["kind", "tree", "run", "key", "a", "b"])
        key = byte_rows(table.column("key").combine_chunks())
        new = np.arange(max(REACH + 1, old), len(run))
        new = new[(run[new] == run[new - REACH - 1])]
        new = new[(key[new] == key[new - REACH - 1]).all(axis=1)]
        if len(new):
            crowd = table.take(pa.array(np.unique((new[:, None] - np.arange(REACH + 2)).ravel())))
            yield from out(CROWD, crowd, crowd.column("id"), crowd.column("id"))
        held = table.slice(max(0, table.num_rows - REACH - 1))
    if held is not None:
        yield from out(EDGE, held, held.column("id"), held.column("id"))


def candidate_pairs(reps: DataFrame) -> DataFrame:
    """(a, b), distinct, of the forest over (id, sig)."""
    parts = partitions(reps.sparkSession)
    order = ["tree", "run", "key", "id"]
    found = []

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from tree_rows(batch)

    rows, start = reps.select("id", "sig").mapInArrow(trees, ROWS), 2 * DEPTH
    while True:
        met = staged(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(neighbours, FOUND), "neighbours")
        # as many rows as there are ranges, by a constant
        sides = met.where(F.col("kind") == EDGE).select("tree", "run", "key", F.col("a").alias("id")).distinct()
        across = staged(sides.coalesce(1).sortWithinPartitions(*order).mapInArrow(neighbours, FOUND), "bounds")
        both = met.unionByName(across)
        found.append(both.where(F.col("kind") == PAIR).select("a", "b"))
        crowd = staged(both.where(F.col("kind") == CROWD).select("tree", F.xxhash64("run", "key").alias("run"), F.col("a").alias("id")).distinct(), "crowd")
        if start >= VALUES or crowd.isEmpty():
            break
        rows = crowd.join(reps.select("id", "sig"), "id").select("tree", "run", "id", "sig").mapInArrow(further_rows(start), ROWS)
        start += FURTHER
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            left, right = signatures(batch.column("sa")), signatures(batch.column("sb"))
            good = np.flatnonzero((left == right).mean(axis=1) >= LIKELY)
            yield batch.select(["a", "b"]).take(pa.array(good))


def spanning_links(sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For each set the first set of its component under links of at least `percent` likeness, exactly.

    Overlaps are counted through postings of shared shingles. Sets already joined with the most
    overlapping one need no own search: a link that matters has an end outside.
    """
    n = len(sets)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets)
    kinds, which = np.unique(values, return_inverse=True)
    df = np.bincount(which, minlength=len(kinds))
    owner = np.repeat(np.arange(n), sizes)
    shared = df[which] > 1
    which, owner = which[shared], owner[shared]
    by = np.argsort(which, kind="stable")
    posted, begin = owner[by], np.searchsorted(which[by], np.arange(len(kinds) + 1))
    edges = np.searchsorted(owner, np.arange(n + 1))
    weight = np.bincount(owner, weights=df[which], minlength=n)
    order = np.argsort(-weight, kind="stable")
    leader = int(order[0])
    for i in order.tolist():
        if i != leader and find(i) == find(leader):
            continue
        own = which[edges[i] : edges[i + 1]]
        if not len(own):
            continue
        lens = begin[own + 1] - begin[own]
        at = np.repeat(begin[own] - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        common = np.bincount(posted[at], minlength=n)
        for j in np.flatnonzero(100 * common >= percent * (sizes + sizes[i] - common)).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each block of a sorted stream of (cluster, block, id, set)."""
    key, ids, sets = None, [], []

    def done() -> pa.RecordBatch | None:
        if len(ids) < 2:
            return None
        root = spanning_links(sets)
        own = np.flatnonzero(root != np.arange(len(root)))
        all_ids = np.array(ids, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(all_ids[root[own]]), pa.array(all_ids[own])], names=["a", "b"]) if len(own) else None

    for batch in batches:
        for c, b, i, s in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if (c, b) != key:
                if (out := done()) is not None:
                    yield out
                key, ids, sets = (c, b), [], []
            if not ids or ids[-1] != i:
                ids.append(i)
                sets.append(np.frombuffer(s, np.uint64))
    if (out := done()) is not None:
        yield out


def link_classes(texts: DataFrame, reps: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component) for every class that is linked with another one. texts: (id, t), reps: (id, n_shingles, k1, k2, sig)."""
    spark = texts.sparkSession
    ship(spark)
    parts = partitions(spark)

    pairs = candidate_pairs(reps)
    sig = reps.select(F.col("id"), "sig")
    both = pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a").join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
    clusters = components(both.select("a", "b", "sa", "sb").mapInArrow(likely, "a bigint, b bigint"))
    members = staged(clusters.join(reps.select(F.col("id").alias("node"), "n_shingles", "k1", "k2"), "node"), "members")
    blocks = members.groupBy("component").agg(F.ceil(F.sum("n_shingles") / block).cast("int").alias("blocks"))
    members = members.join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # members grow with the corpus, so their texts are always met by a shuffle, however few they are
    found = texts.join(members.select(F.col("node").alias("id"), "component", "blocks", "block", "k1", "k2").hint("merge"), "id")

    def sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        values, edges = shingle_sets(*text_bytes(batch.column("t")))
        keys = set_keys(values, edges)
        same = np.flatnonzero((keys[0] == batch.column("k1").to_numpy()) & (keys[1] == batch.column("k2").to_numpy()))
        rows = batch.select(["component", "blocks", "block", "id"]).take(pa.array(same))
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([values[edges[k] : edges[k + 1]].tobytes() for k in same], pa.binary())],
                                         names=["component", "blocks", "block", "id", "values"])

    kept = map_texts(found.select("component", "t", "blocks", "block", "id", "k1", "k2"), sets,
                     "component bigint, blocks int, block int, id bigint, values binary")
    # a cluster of one block meets itself; each of more blocks meets every other one, two blocks to a task
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.least(o, "block") * F.col("blocks") + F.greatest(o, "block"))
    meets = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(meets, lambda m: m != F.col("block") * (F.col("blocks") + 1)))
    sent = kept.withColumn("meet", F.explode(meets)).select("component", "meet", "id", "values")
    sent = sent.repartition(parts, "component", "meet").sortWithinPartitions("component", "meet", "id")
    return components(sent.mapInArrow(confirm, "a bigint, b bigint"))


def grouped(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    """(id, mark, n_shingles, component_id, linked) of every row; mark is a hash of the text, linked tells rows that may have partners."""
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("t"), F.xxhash64(text).alias("mark"))
    table = staged(signed(texts), "signed")
    full = table.where("id IS NOT NULL AND n_shingles > 0")
    reps = staged(full.groupBy("k1", "k2").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "classes")
    linked = link_classes(texts.where("id IS NOT NULL").select("id", "t"), reps.select("id", "n_shingles", "k1", "k2", "sig"), block)
    classes = reps.select("id", "k1", "k2").join(linked.withColumnRenamed("node", "id"), "id", "left") \
        .select("k1", "k2", F.coalesce("component", "id").alias("component_id"))
    out = table.drop("sig").join(classes, ["k1", "k2"], "left").withColumn("linked", (F.col("n_shingles") > 0) & F.col("id").isNotNull())
    own = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", "mark", "n_shingles", own.alias("component_id"), "linked")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ids are longs.

    Shingles are runs of five words after lower-casing A-Z; with fewer words the whole sequence is one,
    without words or text the set is empty and linked with nothing. Documents link when
    100 * common >= 75 * all; component_id is the smallest id reachable, kept marks it. Rows with a null
    id are linked with nothing, have no component and are kept. Repeated rows get equal results; rows of
    one id with different texts each follow their own text. Other columns are not read; an empty table
    gives none. A very long text is one slice of a task.
    """
    rows = grouped(docs, id_col, text_col, block)
    return rows.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows and columns of docs, one row of each group of near duplicates.

    Of a group a row with its smallest id stays; where several texts have that id, the text with the lowest hash, and of equal rows
    one. Rows without words, text or id are in no group and all stay.
    """
    rows = staged(grouped(docs, id_col, text_col, block), "groups")
    kept = rows.where("linked AND id = component_id").groupBy("id").agg(F.min("mark").alias("mark"), F.count("*").alias("n"))
    alone = rows.where("NOT linked").select("id", "mark", F.lit(1).cast("long").alias("n")).distinct()
    # rows of docs under names that no column of theirs can clash with
    mine = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("own"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"))
    chosen = kept.unionByName(alone).hint("merge")
    met = mine.join(chosen, F.col("own").eqNullSafe(F.col("id")) & F.col("hash").eqNullSafe(F.col("mark")))
    one = met.where("n = 1").select("row")
    # more than one row has the id, perhaps with other texts: of the equal ones only one stays
    more = met.where("n > 1").groupBy("own", "hash").agg(F.first("row").alias("row")).select("row")
    return one.unionByName(more).select("row.*")
