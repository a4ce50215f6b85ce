"""Exact BM25 top k over an inverted index in shards, with score bounds.

The indexed rows are ordered by their frequent words, so that like rows are neighbours, and cut into
shards by range. A task turns a shard into postings by term, with the most that each term can add to a score
there. A query sums up its terms from the one that can add most on, until the terms left could not lift a row
without any of these to the k-th sum so far. The frequent words, which are left, are then looked up only in the
rows that can still reach it, fewer with each word. So the work follows the rows of the telling words.

Shards are met twice. First each query goes to the shard that its telling words point to, which gives
a floor for the k-th score. Then it goes to those other shards that can still hold a better row: words are
ordered by the most they can add, and a row that has only the leading words whose sum stays below the floor
cannot win, so only shards with one of the remaining words are asked, and of those the ones where the greatest weights
of the query's words in that shard reach the floor. The index is dealt once for each round, and once more for every
`QUERY_ROWS` queries that meet in one shard; no word is dropped.

Words travel as 64-bit hashes; a seed is taken under which no two words of the index share one. A query is what is left of
its words in the index: equal sets are searched once. The vocabulary is sent to the tasks, which then look words up and choose
shards in place; of a larger one the `MOST_SENT` most frequent words are, and only the rare ones, which few shards hold, are joined.
Both ways give the same. Where a shard could at best tie with a query's floor, it is asked only if it has a smaller id.

Contributions are whole multiples of 1 / STEPS, so sums do not depend on their order and equal rows tie.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.sources import sinks

BM25_K1 = 1.2
BM25_B = 0.75
STEPS = float(1 << 36)
SHARD_ROWS, SMALL_SHARD, BLOCK_ROWS = 65_536, 512, 64  # a word of one in `BLOCK_ROWS` rows or more is frequent
ALIKE = 4  # queries with the same frequent words that share their sums
QUERY_ROWS = 262_144
MOST_SENT, SENT_PLACES = 2_000_000, 16_000_000  # words of a vocabulary that are sent, and their places in shards
SHARD_CELLS = 4_000_000  # queries by shards that are looked at in one step
RARE = "array<struct<cap:double,term:bigint,idf:double,places:array<struct<shard:int,most:double>>>>"
ORDER_WORDS = 4096
ROUTE_WORDS, ROUTE_SHARDS = 8, 64
COLUMN_CELLS = 16_000_000  # numbers in the columns of a shard
DIGITS = 6


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths: the run of each place, and its place in the run."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def raised(least: float, sums: np.ndarray, k: int) -> float:
    """The k-th greatest of some sums, if that is more than `least`."""
    over = sums[sums > least]
    return float(np.partition(over, len(over) - k)[len(over) - k]) if len(over) >= k else least


class Shard:
    """Postings of some rows by term, and the search in them."""

    def __init__(self, rows: pa.Table, block: int = BLOCK_ROWS) -> None:
        self.block, self.n = block, rows.num_rows
        coded = pc.dictionary_encode(pc.list_flatten(rows["words"]).combine_chunks())
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        self.terms = coded.dictionary
        term = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(term, kind="stable")
        self.weight = pc.list_flatten(rows["weights"]).to_numpy(zero_copy_only=False)[order]
        self.row = np.repeat(np.arange(self.n), pc.list_value_length(rows["words"]).to_numpy(zero_copy_only=False))[order]
        self.at = np.append(0, np.cumsum(np.bincount(term, minlength=len(self.terms)))).astype(np.int64)
        ids = rows["corpus_id"].combine_chunks()
        by_id = pc.array_sort_indices(ids)
        self.sorted_ids = np.array(ids.take(by_id).to_pylist(), dtype=object)
        self.rank = np.empty(self.n, np.int64)
        self.rank[by_id.to_numpy()] = np.arange(self.n)

    def _weigh(self, term: np.ndarray, idf: np.ndarray) -> None:
        """What each posting of the asked terms adds to a score, the most of each term, and columns of the frequent ones."""
        each = np.zeros(len(self.terms))
        each[term] = idf
        counts = np.diff(self.at)
        self.value = np.floor(np.repeat(each, counts) * self.weight * STEPS)
        self.cap = np.maximum.reduceat(self.value, self.at[:-1]) if len(counts) else np.zeros(0)
        self.frequent = (each > 0) & (counts * self.block >= self.n)
        self.column = {}
        often = np.flatnonzero(self.frequent)
        for t in often[np.argsort(-counts[often], kind="stable")][: COLUMN_CELLS // max(1, self.n)].tolist():
            self.column[t] = np.zeros(self.n)
            self.column[t][self.row[self.at[t] : self.at[t + 1]]] = self.value[self.at[t] : self.at[t + 1]]

    def search(self, queries: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of the k best rows of each query above its floor, in order. A word has one idf in all queries."""
        words = pc.list_flatten(queries["words"]).combine_chunks()
        term = pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        idf = pc.list_flatten(queries["idfs"]).to_numpy(zero_copy_only=False)
        q = np.repeat(np.arange(queries.num_rows), pc.list_value_length(queries["words"]).to_numpy(zero_copy_only=False))
        known = term >= 0
        term, idf, q = term[known], idf[known], q[known]
        self._weigh(term, idf)
        heads = np.searchsorted(q, np.arange(queries.num_rows + 1))
        floors = pc.fill_null(queries["floor"], 0.0).to_numpy(zero_copy_only=False).astype(float).tolist()
        given = [0 if g is None else int(np.searchsorted(self.sorted_ids, g)) for g in queries["floor_id"].to_pylist()]
        sums, scratch = np.zeros(self.n), np.zeros(self.n)
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * queries.num_rows
        alike: dict[bytes, list[int]] = {}
        often = self.frequent[term]
        own, upto = term[often][np.lexsort((term[often], q[often]))], np.searchsorted(q[often], np.arange(queries.num_rows + 1)).tolist()
        for i in range(queries.num_rows):
            alike.setdefault(own[upto[i] : upto[i + 1]].tobytes(), []).append(i)
        order = np.lexsort((-self.cap[term], q))
        term, heads = term[order], heads.tolist()
        for shared, which in alike.items():
            if len(which) >= ALIKE:
                base = np.zeros(self.n)
                for t in np.frombuffer(shared, np.int64).tolist():
                    base[self.row[self.at[t] : self.at[t + 1]]] += self.value[self.at[t] : self.at[t + 1]]
                lead = self._first(np.flatnonzero(base >= max(raised(0.0, base, k), 1.0)), base, k)
            for i in which:
                own = term[heads[i] : heads[i + 1]]
                if len(which) >= ALIKE:
                    out[i] = self._beside(own[~self.frequent[own]].tolist(), base, lead, floors[i], given[i], k, scratch)
                else:
                    out[i] = self._best(own, floors[i], given[i], k, sums, scratch)
        who = np.repeat(np.arange(len(out)), [len(row) for row, _ in out])
        return who, np.concatenate([row for row, _ in out] or [np.zeros(0, np.int64)]), np.concatenate([score for _, score in out] or [np.zeros(0)])

    def _first(self, row: np.ndarray, sums: np.ndarray, k: int) -> np.ndarray:
        """The k best of some rows."""
        return row[np.lexsort((self.rank[row], -sums[row]))[:k]]

    def _beside(self, rare: list[int], base: np.ndarray, lead: np.ndarray, floor: float, before: int, k: int, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best rows for frequent terms that other queries have too, with their sums and best rows, and some rare terms.

        Rows without a rare term that are not among the best for the frequent ones are behind k others.
        """
        row = lead
        if rare:
            spans = [slice(self.at[t], self.at[t + 1]) for t in rare]
            for span in spans:
                scratch[self.row[span]] += self.value[span]
            row = np.unique(np.concatenate([lead, *[self.row[span] for span in spans]]))
        score = base[row] + scratch[row]
        if rare:
            scratch[row] = 0.0
        kept = score >= max(raised(floor, score, k), 1.0)
        if floor:
            kept &= (score > floor) | (self.rank[row] < before)
        row, score = row[kept], score[kept]
        by = np.lexsort((self.rank[row], -score))[:k]
        return row[by], score[by]

    def _best(self, term: np.ndarray, floor: float, before: int, k: int, sums: np.ndarray, scratch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best rows for terms in order of what they can add, the most first.

        A row counts if it scores more than `floor`, or as much with a rank below `before`. Terms are summed up over all their rows
        until those left could not lift a row without any to the k-th sum so far; then only rows that can still reach it are
        looked at, and fewer with each term.
        """
        rest = np.append(np.cumsum(self.cap[term][::-1])[::-1], 0.0).tolist()
        term, n, at, least, seen = term.tolist(), len(term), 0, floor, 0
        sums.fill(0.0)
        while at < n and rest[at] >= least:
            t = term[at]
            at += 1
            own = slice(self.at[t], self.at[t + 1])
            if t in self.column and 8 * (own.stop - own.start) >= self.n:
                sums += self.column[t]
                grown, seen = None, seen + self.n
            else:
                row = self.row[own]
                grown = sums[row]
                grown += self.value[own]
                sums[row] = grown
                seen += len(row)
            if not floor and at < n:
                if seen * 4 >= self.n:
                    grown, seen = sums, 0
                if grown is not None:
                    least = raised(least, grown, k)
        row = np.flatnonzero(sums >= max(least - rest[at], 1.0))
        score = sums[row]
        while True:
            if not floor:
                least = raised(least, score, k)
            most = score + rest[at]
            kept = most >= max(least, 1.0)
            if floor:
                kept &= (most > floor) | (self.rank[row] < before)
            row, score = row[kept], score[kept]
            if at == n or not len(row):
                break
            t = term[at]
            at += 1
            if t in self.column:
                score += self.column[t][row]
            else:
                own = slice(self.at[t], self.at[t + 1])
                scratch[self.row[own]] = self.value[own]
                score += scratch[row]
                scratch[self.row[own]] = 0.0
        by = np.lexsort((self.rank[row], -score))[:k]
        return row[by], score[by]


def idf_of(n_docs: int) -> Column:
    return F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))


def weight_of(n, n_words, mean: float):
    """The part of a word's score that its row decides; of columns or of arrays."""
    return n * (BM25_K1 + 1) / (n + BM25_K1 * (1 - BM25_B + BM25_B * n_words / mean))


def term_of(word: Column, seed: int) -> Column:
    return F.xxhash64(word) if seed == 0 else F.xxhash64(word, F.lit(seed))


def sharded(rows: DataFrame, frequent: list[int], shards: int) -> DataFrame:
    """Add `shard` and `pos`, the place in the order of the words; rows of one shard are a range of it."""
    value_set = pa.array(frequent, pa.int64())
    schema = T.StructType([*rows.schema.fields, T.StructField("place", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for batch in batches:
            lists = batch.column("words")
            rank = pc.index_in(lists.flatten(), value_set=value_set)
            owner = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            used = rank.is_valid().to_numpy(zero_copy_only=False)
            rank, owner = pc.fill_null(rank, -1).to_numpy(zero_copy_only=False)[used], owner[used]
            rank = rank[np.lexsort((rank, owner))]
            place = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32()), pa.array(rank, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, place], names=[*batch.schema.names, "place"])

    ranged = rows.mapInArrow(run, schema).repartitionByRange(shards, "place", "corpus_id").sortWithinPartitions("place", "corpus_id")
    numbered = ranged.drop("place").withColumn("pos", F.monotonically_increasing_id())
    return numbered.withColumn("shard", F.shiftright("pos", 33).cast("int"))


def meet(queries: DataFrame, shards: DataFrame, k: int, mean: float) -> DataFrame:
    """(query_id, corpus_id, score): the k best rows of its shard for each (query_id, shard, words, idfs, floor, floor_id)."""
    parts = queries.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts"))
    asked = queries.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int"))
    rows = shards.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    corpus_id = shards.schema["corpus_id"]
    schema = T.StructType([T.StructField("query_id", T.StringType()), T.StructField("corpus_id", corpus_id.dataType), T.StructField("score", T.DoubleType())])

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            who, row, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            c = c.sort_by("pos")
            n = pc.list_flatten(c["counts"]).to_numpy(zero_copy_only=False).astype(np.float64)
            n_words = np.repeat(c["n_words"].to_numpy(zero_copy_only=False), pc.list_value_length(c["counts"]).to_numpy(zero_copy_only=False))
            weights = pa.ListArray.from_arrays(np.append(0, np.cumsum(pc.list_value_length(c["counts"]).to_numpy(zero_copy_only=False))).astype(np.int32), weight_of(n, n_words, mean))
            c = pa.table({"corpus_id": c["corpus_id"], "words": c["words"], "weights": weights})
            who, row, score = Shard(c).search(q, k)
        return pa.table({"query_id": q["query_id"].take(pa.array(who)), "corpus_id": c["corpus_id"].take(pa.array(row)), "score": pa.array(score)})

    keys = ["shard", "part"]
    return asked.select(*keys, "query_id", "words", "idfs", "floor", "floor_id").groupBy(*keys).cogroup(
        rows.select(*keys, "pos", "corpus_id", "n_words", "words", "counts").groupBy(*keys)).applyInArrow(run, schema)


def top_rows(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("corpus_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class Prepared:
    """An index cut into shards with their smallest ids, what of its words is sent to the tasks, and a table of the rest, if any."""

    corpus_id: T.DataType
    mean: float
    seed: int
    shards: DataFrame
    n_shards: int
    lows: list
    sent: object
    rare: DataFrame | None


def prepare(index: DataFrame, shard_rows: int = SHARD_ROWS) -> Prepared:
    """Cut an ``index_terms`` table into shards; its words and shards are written once."""
    spark = index.sparkSession
    total = index.agg(F.count("*").alias("n"), F.avg("n_words").alias("mean")).collect()[0]
    n_rows, mean = total["n"], total["mean"] or 1.0
    weight = lambda n: weight_of(n.cast("double"), F.col("n_words"), F.lit(mean))
    postings = index.select("n_words", F.explode("terms").alias("t")).select(F.col("t.word").alias("word"), weight(F.col("t.n")).alias("weight"))
    counted = postings.groupBy("word").agg(F.count("*").alias("df"), F.max("weight").alias("most")).withColumn("idf", idf_of(n_rows))
    counted = sinks.stage(counted.withColumn("cap", F.floor(F.col("idf") * F.col("most") * STEPS).cast("double")), "vocabulary")
    seed, n_terms = 0, counted.count()
    while counted.select(term_of(F.col("word"), seed).alias("term")).distinct().count() < n_terms:
        seed += 1
    vocabulary = counted.withColumn("term", term_of(F.col("word"), seed))
    frequent = [r["term"] for r in vocabulary.orderBy(F.col("df").desc(), "word").limit(ORDER_WORDS).select("term").collect()]
    rows = index.select("corpus_id", "n_words", F.transform("terms", lambda t: term_of(t["word"], seed)).alias("words"), F.transform("terms", lambda t: t["n"].cast("int")).alias("counts"))
    n_shards = max(-(-n_rows // shard_rows), min(spark.sparkContext.defaultParallelism, -(-n_rows // SMALL_SHARD)), 1)
    shards = sinks.stage(sharded(rows, frequent, n_shards), "shards")
    each = shards.select("shard", "n_words", F.explode(F.arrays_zip("words", "counts")).alias("p"))
    lists = sinks.stage(each.groupBy(F.col("p.words").alias("term"), "shard").agg(F.max(weight(F.col("p.counts"))).alias("most")), "lists")
    lows: list = [None] * n_shards
    for r in shards.groupBy("shard").agg(F.min("corpus_id").alias("low")).toArrow().to_pylist():
        lows[r["shard"]] = r["low"]
    return Prepared(index.schema["corpus_id"].dataType, mean, seed, shards, n_shards, lows, *sent_words(vocabulary, lists, n_terms, n_shards))


def sent_words(vocabulary: DataFrame, lists: DataFrame, n_terms: int, n_shards: int) -> tuple[object, DataFrame | None]:
    """A broadcast of (terms in order, idfs, caps, heads of their places, shards, greatest weights), and a table of the words left out."""
    rare = None
    if n_terms > MOST_SENT or lists.limit(SENT_PLACES + 1).count() > SENT_PLACES:
        most, seen, at_least = min(MOST_SENT, SENT_PLACES // n_shards), 0, 1 << 62
        for r in vocabulary.groupBy("df").count().orderBy(F.col("df").desc()).collect():
            seen += r["count"]
            if seen > most:
                break
            at_least = r["df"]
        few = lists.join(vocabulary.where(F.col("df") < at_least).select("term", "cap", "idf"), "term")
        rare = sinks.stage(few.groupBy("term").agg(F.any_value("cap").alias("cap"), F.any_value("idf").alias("idf"), F.collect_list(F.struct("shard", "most")).alias("places")), "rare")
        vocabulary = vocabulary.where(F.col("df") >= at_least)
        lists = lists.join(vocabulary.select("term"), "term", "left_semi")
    words, places = vocabulary.select("term", "idf", "cap").toArrow().sort_by("term"), lists.select("term", "shard", "most").toArrow().sort_by("term")
    flat = lambda t, c: t[c].to_numpy()
    heads = np.append(np.searchsorted(flat(places, "term"), flat(words, "term")), places.num_rows)
    return vocabulary.sparkSession.sparkContext.broadcast((flat(words, "term"), flat(words, "idf"), flat(words, "cap"), heads, flat(places, "shard"), flat(places, "most"))), rare


def lists_of(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(flat))


def flat_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of lists, and the number of each list."""
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), counts)


def found_in(terms: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each value in the terms, which are in order, and whether it is there."""
    place = np.minimum(np.searchsorted(terms, flat), max(len(terms) - 1, 0))
    return place, terms[place] == flat if len(terms) else np.zeros(len(flat), bool)


def known(p: Prepared, queries: DataFrame, asked: Column, spent: tuple[str, ...] = ()) -> DataFrame:
    """Add ``known``, (query_id, words, rare): the asked words that the index has as terms, each once, by what they can add. Null without any.

    ``rare`` tells of those that are not sent. Columns in ``spent`` are dropped before anything is written or shuffled.
    """
    sent = p.sent

    def once(column: pa.Array) -> tuple[np.ndarray, ...]:
        """Distinct terms of each row by what they can add, with their rows, places among those sent, and whether they are."""
        flat, owner = flat_lists(column)
        place, there = found_in(sent.value[0], flat)
        cap = np.zeros(len(flat))
        cap[there] = sent.value[2][place[there]]
        order = np.lexsort((flat, cap, owner))
        flat, owner, cap, there = flat[order], owner[order], cap[order], there[order]
        first = np.ones(len(flat), bool)
        first[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        return flat[first], owner[first], cap[first], there[first]

    terms = F.transform(asked, lambda w: term_of(w, p.seed))
    if p.rare is None:

        def look_up(column: pa.Array) -> pa.Array:
            flat, owner, _, there = once(column)
            flat, owner = flat[there], owner[there]
            heads = np.searchsorted(owner, np.arange(len(column) + 1))
            ids = [hashlib.md5(flat[a:b].tobytes()).hexdigest() if b > a else None for a, b in zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True)]
            ids = pa.array(ids, pa.string())
            return pa.StructArray.from_arrays([ids, lists_of(flat, np.diff(heads))], names=["query_id", "words"], mask=ids.is_null())

        looked_up = F.arrow_udf(look_up, "struct<query_id:string,words:array<bigint>>")
        return queries.withColumn("known", looked_up(terms)).drop(*spent).withColumn("known", F.when(F.col("known").isNotNull(), F.struct("known.*", F.lit(None).cast(RARE).alias("rare"))))

    def part(column: pa.Array) -> pa.Array:
        flat, owner, cap, there = once(column)
        count = lambda own: np.bincount(owner[own], minlength=len(column))
        often = pa.StructArray.from_arrays([pa.array(cap[there]), pa.array(flat[there])], names=["cap", "term"])
        return pa.StructArray.from_arrays([lists_of(often, count(there)), lists_of(flat[~there], count(~there))], names=["often", "others"])

    parted = F.arrow_udf(part, "struct<often:array<struct<cap:double,term:bigint>>,others:array<bigint>>")
    rows = sinks.stage(queries.withColumn("parted", parted(terms)).drop(*spent).withColumn("row_no", F.monotonically_increasing_id()), "parted")
    others = rows.select("row_no", F.explode("parted.others").alias("term")).join(p.rare, "term")
    others = others.groupBy("row_no").agg(F.sort_array(F.collect_list(F.struct("cap", "term", "idf", "places"))).alias("rare"))
    slim = rows.withColumn("parted", F.col("parted.often")).join(others, "row_no", "left")
    words = F.sort_array(F.concat("parted", F.transform(F.coalesce("rare", F.array().cast(RARE)), lambda x: F.struct(x["cap"].alias("cap"), x["term"].alias("term")))))
    slim = slim.withColumn("parted", F.transform(words, lambda x: x["term"]))
    query_id = F.md5(F.array_join(F.col("parted").cast("array<string>"), " "))
    return slim.withColumn("known", F.when(F.size("parted") > 0, F.struct(query_id.alias("query_id"), F.col("parted").alias("words"), "rare"))).drop("parted", "rare", "row_no")


def steps(batches, n_shards: int):
    """Slices of batches that make few cells of queries by shards."""
    most = max(1, SHARD_CELLS // n_shards)
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            yield batch.slice(at, most)


def placed(sent: tuple[np.ndarray, ...], batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of the queries' words: their row, idf, cap and number of places; of each place: the word's number, the shard and the greatest weight."""
    terms, idfs, caps, heads, shards, mosts = sent
    flat, owner = flat_lists(batch.column("words"))
    place, there = found_in(terms, flat)
    idf, cap, head, counts = np.zeros(len(flat)), np.zeros(len(flat)), np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    idf[there], cap[there], head[there] = idfs[place[there]], caps[place[there]], heads[place[there]]
    counts[there] = heads[place[there] + 1] - head[there]
    rare = batch.column("rare").flatten()
    of = {f: rare.field(f) for f in ("term", "cap", "idf", "places")}
    term, at = np.unique(of["term"].to_numpy(zero_copy_only=False), return_index=True)
    left = np.flatnonzero(~there)
    place = at[found_in(term, flat[left])[0]] if len(left) else left
    sizes = pc.list_value_length(of["places"]).to_numpy(zero_copy_only=False)
    idf[left], cap[left] = of["idf"].to_numpy(zero_copy_only=False)[place], of["cap"].to_numpy(zero_copy_only=False)[place]
    counts[left], head[left] = sizes[place], (np.cumsum(sizes) - sizes)[place]
    few = of["places"].flatten()
    which, at = spread(counts)
    entry, own = head[which] + at, there[which]
    shard, most = np.zeros(len(which), np.int64), np.zeros(len(which))
    shard[own], most[own] = shards[entry[own]], mosts[entry[own]]
    shard[~own], most[~own] = few.field("shard").to_numpy(zero_copy_only=False)[entry[~own]], few.field("most").to_numpy(zero_copy_only=False)[entry[~own]]
    return owner, idf, cap, counts, which, shard, most


def routed(p: Prepared, q: DataFrame) -> DataFrame:
    """Add `idfs`, and `shard`: the one that the query's telling words point to, if any."""
    schema = T.StructType([*q.schema.fields, *T.StructType.fromDDL("idfs array<double>, shard int").fields])
    sent, n_shards = p.sent, p.n_shards

    def run(batches):
        for batch in steps(batches, n_shards):
            owner, idf, _, counts, which, shard, most = placed(sent.value, batch)
            own = np.bincount(owner, minlength=batch.num_rows)
            tells = (np.cumsum(own)[owner] - np.arange(len(owner)) <= ROUTE_WORDS) & (counts <= ROUTE_SHARDS)
            at = tells[which]
            sums = np.bincount(owner[which[at]] * n_shards + shard[at], weights=idf[which[at]] * most[at], minlength=batch.num_rows * n_shards).reshape(-1, n_shards)
            best = pa.array(sums.argmax(axis=1), pa.int32(), mask=sums.max(axis=1) == 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists_of(idf, own), best], names=schema.names)

    return q.mapInArrow(run, schema)


def open_shards(p: Prepared, q: DataFrame) -> DataFrame:
    """Add `others`: the shards beside `seen` that can hold a row which comes before the one at the floor."""
    schema = T.StructType([*q.schema.fields, T.StructField("others", T.ArrayType(T.IntegerType()))])
    sent, n_shards, lows = p.sent, p.n_shards, p.lows

    def run(batches):
        for batch in steps(batches, n_shards):
            owner, idf, cap, _, which, shard, most = placed(sent.value, batch)
            floor = pc.fill_null(batch.column("floor"), 0.0).to_numpy(zero_copy_only=False)
            upto = np.cumsum(cap)
            first = np.searchsorted(owner, np.arange(batch.num_rows))
            upto -= np.append(0.0, upto)[first][owner]
            cell, size = owner[which] * n_shards + shard, batch.num_rows * n_shards
            bound = np.bincount(cell, weights=np.floor(idf[which] * most * STEPS), minlength=size).reshape(-1, n_shards)
            needed = np.bincount(cell[(upto >= floor[owner])[which]], minlength=size).reshape(-1, n_shards) > 0
            open_ = needed & (bound >= floor[:, None])
            open_[np.arange(batch.num_rows), batch.column("seen").to_numpy(zero_copy_only=False)] = False
            ids = batch.column("floor_id").to_pylist()
            tied = open_ & (bound == floor[:, None])
            for i, s in zip(*(x.tolist() for x in np.nonzero(tied)), strict=True):
                if ids[i] is not None and (lows[s] is None or not lows[s] < ids[i]):
                    open_[i, s] = False
            who, other = np.nonzero(open_)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists_of(other.astype(np.int32), np.bincount(who, minlength=batch.num_rows))], names=schema.names)

    return q.mapInArrow(run, schema)


def best_rows(p: Prepared, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, corpus_id, score) of each distinct (query_id, words, rare) of ``known``.

    Scores are ranked as they are and rounded where they are shown; ties go to the smaller id.
    """
    q = queries.groupBy("query_id").agg(F.first("words").alias("words"), F.first("rare").alias("rare"))
    other = F.pmod(F.xxhash64("query_id"), F.lit(p.n_shards)).cast("int")
    first = sinks.stage(routed(p, q).withColumn("shard", F.coalesce("shard", other)), "first")
    no_id = F.lit(None).cast(p.corpus_id)
    hits = sinks.stage(meet(first.select("query_id", "shard", "words", "idfs", F.lit(None).cast("double").alias("floor"), no_id.alias("floor_id")), p.shards, k, p.mean), "hits")
    if p.n_shards > 1:
        floors = top_rows(hits, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("floor"), F.col("corpus_id").alias("floor_id"))
        rest = sinks.stage(open_shards(p, first.withColumnRenamed("shard", "seen").join(floors, "query_id", "left")).where("size(others) > 0"), "rest")
        rest = rest.select("query_id", F.explode("others").alias("shard"), "words", "idfs", "floor", "floor_id")
        hits = hits.unionByName(meet(rest, p.shards, k, p.mean))
    return top_rows(hits, k).withColumn("score", F.round(F.col("score") / STEPS, DIGITS))
