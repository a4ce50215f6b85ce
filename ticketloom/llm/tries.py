"""Prefix trie of conversations, packed in double arrays.

A turn is known by a 128-bit hash of its role and text, so texts are read once and never move. Rebuilt
conversations are cut into segments of `SEGMENT` turns; equal segments after equal beginnings become one
row with a count before anything is dealt. These rows are range partitioned in the order of their turns:
each range is a prefix shard, and a prefix that many share is split further down by the next turns. A
task takes its shard in slices, numbers the turns of a slice densely, packs BASE and CHECK arrays over
these numbers and walks every sequence through them; the cells are the nodes. Nodes that several slices
share, near the root as a rule, meet in one grouped aggregate by the hash of their path.

Subtree sums need no rounds over the levels. The smallest member of a node owns it, and who owns a node
owns all deeper nodes of its own path. So the sum over a subtree is the sum over the members of what each
owns there: a second walk carries these values, and the same merge adds them up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.llm.frames import partitions, ship, staged

SEGMENT = 256
MOST_HEAD = 8
ROOT = bytes(16)
HOT_SHARE = 1000
SLICE_TURNS = 1 << 18


class DoubleArray:
    """A trie over sequences of numbers from 1 on: the child of cell s by number c is BASE[s] + c if CHECK there is s."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """flat: all sequences one after another; sizes: their lengths. `levels` has (rows, cells) at each depth."""
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -2, np.int64)
        self.code = np.zeros(1, np.int64)
        self.low, self.end = 1, 1
        heads = np.cumsum(sizes) - sizes
        rows, state = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
        self.levels = [(rows, state)]
        width, depth = int(flat.max(initial=0)) + 1, 0
        while True:
            going = sizes[rows] > depth
            rows, state = rows[going], state[going]
            if not len(rows):
                return
            code = flat[heads[rows] + depth]
            arcs = np.unique(state * width + code)
            parents, at = np.unique(arcs // width, return_index=True)
            codes = np.split(arcs % width, at[1:])
            for parent, own in zip(parents.tolist(), codes, strict=True):
                self._place(parent, own)
            state = self.base[state] + code
            depth += 1
            self.levels.append((rows, state))

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.append(self.base, np.zeros(more, np.int64))
            self.check = np.append(self.check, np.full(more, -1, np.int64))
            self.code = np.append(self.code, np.zeros(more, np.int64))

    def _place(self, parent: int, codes: np.ndarray) -> None:
        """Give the children the lowest cells that are free for all of them, among the next few free ones, or cells behind all others."""
        span = int(codes[-1] - codes[0])
        self._grow(self.end + span + 1)
        free = self.low + np.flatnonzero(self.check[self.low : min(self.end, self.low + 256)] == -1)[:32]
        free = free[free + span < len(self.check)]
        fits = (self.check[free[:, None] + (codes - codes[0])] == -1).all(axis=1) if len(free) else np.zeros(0, bool)
        first = int(free[fits.argmax()]) if fits.any() else self.end
        cells = first - codes[0] + codes
        self.base[parent] = first - codes[0]
        self.check[cells], self.code[cells] = parent, codes
        self.end = max(self.end, int(cells[-1]) + 1)
        while self.low < self.end and self.check[self.low] != -1:
            self.low += 1
        self.low = max(self.low, self.end - 4096)

    def child(self, cell: int, code: int) -> int:
        """The cell reached from `cell` by `code`, or -1."""
        to = int(self.base[cell]) + code
        return to if 0 < to < self.end and self.check[to] == cell else -1


class Shard:
    """Sequences of one slice: starts and turns numbered in order of appearance, and the double array over them."""

    def __init__(self, piece: pa.RecordBatch) -> None:
        keys = piece.column("keys")
        sizes = pc.list_value_length(keys).to_numpy(zero_copy_only=False).astype(np.int64)
        turns = pc.dictionary_encode(pc.list_flatten(keys))
        starts = pc.dictionary_encode(piece.column("start"))
        self.turns, self.starts = turns.dictionary.to_pylist(), starts.dictionary.to_pylist()
        turn, start = (x.indices.to_numpy(zero_copy_only=False).astype(np.int64) for x in (turns, starts))
        self.heads = np.cumsum(sizes) - sizes
        self.sizes = sizes
        flat = np.insert(turn + len(self.starts) + 1, self.heads, start + 1)
        self.trie = DoubleArray(flat, sizes + 1)
        self.first = (piece.column("seg").to_numpy() * SEGMENT).astype(np.int64)
        self.paths = self._paths()

    def _paths(self) -> dict[int, bytes]:
        """Of each cell the hash of its turns since the start; the start's cell has none."""
        trie, out = self.trie, {}
        lead = len(self.starts) + 1
        for depth, (_, cells) in enumerate(trie.levels[1:]):
            for cell in np.unique(cells).tolist():
                out[cell] = hashlib.md5(out[int(trie.check[cell])] + self.turns[int(trie.code[cell]) - lead]).digest() if depth else ROOT
        return out

    def nodes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes], list[bytes | None]]]:
        """By level: turns since the start, rows, each row's cell as a place in the level, a row of each place, depths, node keys, parent keys.

        The start is a node of this shard only where it is the root.
        """
        for level, (rows, cells) in enumerate(self.trie.levels[1:]):
            if not level:
                at_root = self.first[rows] == 0
                rows, cells = rows[at_root], cells[at_root]
                if not len(rows):
                    continue
            kinds, one, which = np.unique(cells, return_index=True, return_inverse=True)
            one = rows[one]
            start = [self.starts[int(self.trie.code[c]) - 1] for c in self.trie.levels[1][1][one].tolist()]
            key = [s if not level else node_key(s, self.paths[c]) for s, c in zip(start, kinds.tolist(), strict=True)]
            above = [None if not level else s if level == 1 else node_key(s, self.paths[int(self.trie.check[c])]) for s, c in zip(start, kinds.tolist(), strict=True)]
            yield level, rows, which, one, self.first[one] + level, key, above


def node_key(start: bytes, path: bytes) -> bytes:
    return hashlib.md5(start + path).digest()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of a bounded number of turns."""
    for batch in batches:
        size = np.cumsum(pc.list_value_length(batch.column("keys")).to_numpy(zero_copy_only=False).astype(np.int64))
        edges = np.searchsorted(size // SLICE_TURNS, np.arange(0, (size[-1] // SLICE_TURNS if len(size) else -1) + 2))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def _binary(values: list) -> pa.Array:
    return pa.array(values, pa.binary())


NODE = "key binary, parent binary, depth bigint, size bigint, n bigint, conv_id bigint"


def count_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial nodes of each slice: members and the smallest of them."""
    for piece in _cut(batches):
        shard = Shard(piece)
        n, conv = (piece.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("n", "conv_id"))
        size = pc.list_flatten(piece.column("sizes")).to_numpy(zero_copy_only=False).astype(np.int64)
        for level, rows, which, one, depth, key, above in shard.nodes():
            members, least = np.zeros(len(key), np.int64), np.full(len(key), np.iinfo(np.int64).max)
            np.add.at(members, which, n[rows])
            np.minimum.at(least, which, conv[rows])
            own = size[shard.heads[one] + level - 1] if level else np.zeros(len(key), np.int64)
            yield pa.RecordBatch.from_arrays([_binary(key), _binary(above), *map(pa.array, (depth, own, members, least))],
                                             names=["key", "parent", "depth", "size", "n", "conv_id"])


def sum_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of what members own at each node and below it."""
    for piece in _cut(batches):
        shard = Shard(piece)
        later, leaves = (piece.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("later", "leaves"))
        owned = piece.column("owned")
        value = np.zeros(int(shard.sizes.sum()), np.int64)
        at = pc.list_flatten(owned)
        row = np.repeat(np.arange(piece.num_rows), pc.fill_null(pc.list_value_length(owned), 0).to_numpy(zero_copy_only=False))
        depth = at.field("depth").to_numpy(zero_copy_only=False).astype(np.int64)
        value[shard.heads[row] + depth - 1 - shard.first[row]] = at.field("w").to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(value)])
        ends = upto[shard.heads + shard.sizes]
        for level, rows, which, _, _, key, _ in shard.nodes():
            saved, n = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
            np.add.at(saved, which, later[rows] + ends[rows] - upto[shard.heads[rows] + max(level - 1, 0)])
            np.add.at(n, which, leaves[rows])
            yield pa.RecordBatch.from_arrays([_binary(key), pa.array(saved), pa.array(n)], names=["key", "saved", "leaves"])


def chain_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The key of the node each segment starts from; rows come by conversation and segment."""
    last, start = None, ROOT
    for batch in batches:
        out = []
        for conv, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
            start = start if conv == last else ROOT
            out.append(start)
            last, start = conv, node_key(start, digest)
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("seg"), _binary(out)], names=["conv_id", "seg", "start"])


def digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the id lists of each node, which come one after another in order."""
    last, state = None, None
    for batch in batches:
        keys, sums = [], []
        for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != last:
                if last is not None:
                    keys.append(last)
                    sums.append(state.hexdigest())
                last, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(("," + ids).encode())
        yield pa.RecordBatch.from_arrays([_binary(keys), pa.array(sums, pa.string())], names=["key", "ends_sha256"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([_binary([last]), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, key, size): turns numbered from 0, the order of equal turn numbers by hash. A long conversation spreads over ranges."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), key.alias("key"),
                                                             F.octet_length(text).cast("long").alias("size"))
    order = [F.col("turn").asc_nulls_first(), F.col("key")]
    dealt = staged(rows.repartitionByRange(partitions(conversations.sparkSession), "conv_id", *order).withColumn("part", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("part", "conv_id").agg(F.count("*").alias("n"))
    before = counts.select("part", "conv_id", (F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")).alias("before"))
    own = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy(*order)) - 1
    return dealt.withColumn("own", own).join(before, ["part", "conv_id"]).select("conv_id", (F.col("own") + F.col("before")).alias("pos"), "key", "size")


def folded(keys: Column) -> Column:
    return F.aggregate(keys, F.lit(ROOT), lambda s, k: F.unhex(F.md5(F.concat(s, k))))


def rebuilt_segments(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, seg, keys, sizes, length, start, end) of rebuilt conversations, and (conv_id, length) of all of them."""
    turns = staged(ordered_turns(conversations), "ordered")
    heads = staged(turns.groupBy("conv_id").agg(F.count("*").alias("n_own"), F.sort_array(F.collect_list(
        F.when(F.col("pos") < MOST_HEAD, F.struct("pos", "key", "size")))).alias("head")), "heads")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int")
    own = heads.select("conv_id", "n_own", taken.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    plan = own.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left").select("conv_id", "n_own", "h", F.slice("head", F.lit(1), F.col("h")).alias("head"))
    plan = plan.withColumn("n_head", F.when(F.col("head").isNull(), 0).otherwise(F.size("head")))
    plan = staged(plan.withColumn("length", F.col("n_head") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))), "plan")
    first = plan.select("conv_id", "length", F.posexplode("head").alias("pos", "x")).select("conv_id", F.col("pos").cast("long").alias("pos"), "x.key", "x.size", "length")
    rest = turns.join(plan.select("conv_id", "h", "n_head", "length"), "conv_id").where("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).cast("long").alias("pos"), "key", "size", "length")
    segments = first.unionByName(rest).groupBy("conv_id", F.floor(F.col("pos") / SEGMENT).cast("long").alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "key", "size"))).alias("x"), F.max("length").alias("length"))
    segments = segments.select("conv_id", "seg", F.transform("x", lambda x: x["key"]).alias("keys"), F.transform("x", lambda x: x["size"]).alias("sizes"), "length")
    segments = staged(segments.withColumn("digest", folded(F.col("keys"))), "segments")
    starts = segments.select("conv_id", "seg", "digest").repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(
        chain_starts, "conv_id bigint, seg bigint, start binary")
    end = F.unhex(F.md5(F.concat("start", "digest")))
    return segments.join(starts, ["conv_id", "seg"]).withColumn("end", end).drop("digest"), plan.select("conv_id", "length")


def shards(sequences: DataFrame) -> DataFrame:
    """Prefix shards: ranges in the order of the turns."""
    return sequences.repartitionByRange(partitions(sequences.sparkSession), "start", "keys").sortWithinPartitions("start", "keys")


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id). Ids meet in ranges of ids first, so a node with most conversations gets few long rows."""
    parts = partitions(ends.sparkSession)
    ranged = ends.repartitionByRange(parts, "conv_id").withColumn("part", F.spark_partition_id())
    lists = ranged.groupBy("key", "part").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    lists = lists.select("key", "part", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    return lists.repartition(parts, "key").sortWithinPartitions("key", "part").mapInArrow(digest_ends, "key binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node of the trie over rebuilt conversations (the root has depth 0).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, node_key). Rows without
    conv_id belong to no conversation and are left out; a null turn comes first, null role and text are empty; rows
    with one turn number are ordered by a hash of role and text, repeated rows are turns of their own. Ids are cast
    to bigint; `%` takes the sign of the id. Other columns are not read. An empty table gives none. A text of any
    length is hashed where it is read, and a conversation of any length is cut into segments.
    """
    spark = conversations.sparkSession
    ship(spark)
    segments, all_ = rebuilt_segments(conversations)
    segments = staged(segments, "chained")
    sequences = staged(segments.groupBy("end").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.first("start").alias("start"),
                                                   F.first("seg").alias("seg"), F.first("keys").alias("keys"), F.first("sizes").alias("sizes")), "sequences")
    turnless = all_.where("length = 0")
    zero, none = F.lit(0).cast("long"), F.lit(None)
    bare = turnless.select(F.lit(ROOT).alias("key"), none.cast("binary").alias("parent"), zero.alias("depth"), zero.alias("size"), F.lit(1).cast("long").alias("n"), "conv_id")
    nodes = shards(sequences.drop("end")).mapInArrow(count_members, NODE).unionByName(bare).groupBy("key").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("size").alias("size"), F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"))
    nodes = staged(nodes, "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, "key", "left").fillna(0, ["n_children"]), "nodes")

    # what each conversation owns, by segment, and what it owns further on
    weight = (F.col("n") - 1) * F.col("size")
    owned = nodes.where("depth > 0").groupBy("conv_id", F.floor((F.col("depth") - 1) / SEGMENT).cast("long").alias("seg")).agg(
        F.sort_array(F.collect_list(F.struct("depth", weight.alias("w")))).alias("owned"), F.sum(weight).alias("w"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    onward = Window.partitionBy("conv_id").orderBy(F.col("seg").desc())
    shares = segments.select("conv_id", "seg", "end").join(owned, ["conv_id", "seg"], "left").select(
        "end", "owned", (F.sum(F.coalesce("w", F.lit(0))).over(onward) - F.coalesce("w", F.lit(0))).alias("later"), F.max(F.coalesce("leaf", F.lit(0))).over(onward).alias("leaf"))
    shares = shares.where("owned IS NOT NULL OR later > 0 OR leaf > 0").groupBy("end").agg(
        F.first("owned", ignorenulls=True).alias("owned"), F.sum("later").alias("later"), F.sum("leaf").alias("leaves"))
    walked = staged(sequences.select("end", "start", "seg", "keys").join(shares, "end").drop("end"), "owned")
    sums = shards(walked).mapInArrow(sum_subtrees, "key binary, saved bigint, leaves bigint").groupBy("key").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    last = segments.where(F.col("seg") == F.floor((F.col("length") - 1) / SEGMENT)).select(F.col("end").alias("key"), "conv_id")
    digests = end_digests(staged(last.unionByName(turnless.select(F.lit(ROOT).alias("key"), "conv_id")), "ends"))

    # owners of parents: at most HOT_SHARE parents have more than that share of all nodes as children
    owners = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    hot = F.broadcast(owners.where(F.col("n_children") * HOT_SHARE > nodes.agg(F.count("*")).scalar()).drop("n_children"))
    below = nodes.where("parent IS NOT NULL")
    named = below.join(hot, "parent").unionByName(below.join(hot, "parent", "left_anti").join(owners.drop("n_children"), "parent")).unionByName(
        nodes.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return named.join(sums, "key", "left").join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.greatest(F.coalesce("leaves", F.lit(0)), F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        F.lower(F.hex("key")).alias("node_key"))
