"""Retrieval: exact and approximate vector top-k, lexical top-k, history, contexts."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import policy
from ticketloom.functions import text as X
from ticketloom.operators import blocks as B
from ticketloom.operators import textindex as I
from ticketloom.operators import vectorindex as V
from ticketloom.sources import sinks


# --- vectors -----------------------------------------------------------------------


def vector_topk(
    queries: DataFrame, corpus: DataFrame, k: int = 3, query_id: str = "query_id",
    corpus_id: str = "doc_id", vector: str = "embedding", exclude_same_id: bool = False,
    corpus_rows: int = B.CORPUS_BLOCK, query_rows: int = B.QUERY_BLOCK,
) -> DataFrame:
    """Exact top k by cosine similarity: (query_id, corpus_id, score, rank).

    Rows without a vector neither ask nor are found; zero vectors and missing numbers
    count as zeros; vectors of different lengths fail the job.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vec")).filter("vec IS NOT NULL")
    c = corpus.select(F.col(corpus_id).alias("corpus_id"), F.col(vector).alias("vec")).filter("vec IS NOT NULL")
    return B.blockwise_topk(q, c, k, B.cosine_scorer(k, exclude_same_id), None, corpus_rows, query_rows)


def vector_topk_approx(
    queries: DataFrame, corpus: DataFrame, k: int = 3, query_id: str = "query_id",
    corpus_id: str = "doc_id", vector: str = "embedding", exclude_same_id: bool = False,
    lists: int | None = None, seed: int = 42, path: str | None = None,
) -> DataFrame:
    """Approximate top k: an index of the corpus is built, written to ``path``, and searched (``vectorindex``).

    Scores are exact cosines. Null vectors neither ask nor are found; vectors of different lengths fail the job.
    An index that is there already is searched by ``vectorindex.load`` and ``search``.
    """
    return V.search(V.build(corpus, path, k, corpus_id, vector, lists, seed), queries, k, query_id, vector, exclude_same_id)


def fit_embedder(chunks: DataFrame, text: str = "content", dims: int = 256) -> PipelineModel:
    """Fit hashed TF-IDF vectors. They are lexical, not semantic."""
    stages = [
        HashingTF(inputCol="embed_words", outputCol="embed_tf", numFeatures=dims),
        IDF(inputCol="embed_tf", outputCol="embed_idf"),
        Normalizer(inputCol="embed_idf", outputCol="embed_vec", p=2.0),
    ]
    return Pipeline(stages=stages).fit(chunks.select(X.search_words(F.coalesce(F.col(text), F.lit(""))).alias("embed_words")))


def embed_text(
    chunks: DataFrame, model: PipelineModel, text: str = "content", out: str = "embedding"
) -> DataFrame:
    """Add unit-length lexical vectors as array<float>."""
    worded = chunks.withColumn("embed_words", X.search_words(F.coalesce(F.col(text), F.lit(""))))
    return (
        model.transform(worded)
        .withColumn(out, vector_to_array("embed_vec", "float32"))
        .drop("embed_words", "embed_tf", "embed_idf", "embed_vec")
    )


# --- text --------------------------------------------------------------------------


def index_terms(df: DataFrame, id_col: str = "doc_id", text: str = "content") -> DataFrame:
    """(corpus_id, n_words, terms) of a text table; write it once to search it often."""
    tokens = X.search_words(F.coalesce(F.col(text), F.lit("")))
    return df.select(
        F.col(id_col).alias("corpus_id"),
        X.let(
            tokens,
            lambda w: F.struct(
                F.size(w).alias("n_words"),
                F.transform(X.word_counts(w), lambda x: F.struct(x["word"].alias("word"), x["n"].alias("n"))).alias(
                    "terms"
                ),
            ),
        ).alias("t"),
    ).select("corpus_id", "t.n_words", "t.terms")


def asked_words(text: Column) -> Column:
    """Sorted distinct search words of a query text."""
    return F.sort_array(F.array_distinct(X.search_words(F.coalesce(text, F.lit("")))))


def asked_key(words: Column) -> Column:
    """Key of a set of query words; null for none, which nothing answers."""
    return F.when(F.size(words) > 0, F.md5(F.array_join(words, " ")))


def known_answers(
    keyed: DataFrame, prepared: I.Prepared, k: int, details: DataFrame | None = None, detail_key: str = "doc_id",
) -> DataFrame:
    """(query_id, hits) of every distinct ``known`` set of words."""
    hits = I.best_rows(prepared, keyed.where("known IS NOT NULL").select("known.*"), k)
    shown = ["rank", "corpus_id", "score"]
    if details is not None:
        extra = [c for c in details.columns if c != detail_key]
        hits = hits.join(details.select(F.col(detail_key).alias("corpus_id"), *extra), "corpus_id")
        shown += extra
    return hits.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct(*shown))).alias("hits"))


def text_answers(
    queries: DataFrame, index: DataFrame, k: int = 3, text: str = "text",
    details: DataFrame | None = None, detail_key: str = "doc_id", shard_rows: int = I.SHARD_ROWS,
) -> DataFrame:
    """(asked, hits): the exact BM25 top k of every distinct set of query words, by its ``asked_key``.

    No word is left out for being frequent. ``hits`` is array<struct<rank, corpus_id, score, ...>>,
    with the other columns of ``details`` looked up by ``detail_key``.
    """
    prepared = I.prepare(index, shard_rows)
    sets = queries.select(asked_words(F.col(text)).alias("asked_words")).withColumn("asked", asked_key(F.col("asked_words")))
    keyed = I.known(prepared, sets.filter("asked IS NOT NULL").dropDuplicates(["asked"]), F.col("asked_words")).filter("known IS NOT NULL")
    answers = known_answers(keyed, prepared, k, details, detail_key)
    return keyed.select("asked", "known.query_id").join(answers, "query_id").select("asked", "hits")


def with_top_text(
    queries: DataFrame, index: DataFrame, k: int = 3, text: str = "text", out: str = "hits",
    details: DataFrame | None = None, detail_key: str = "doc_id", shard_rows: int = I.SHARD_ROWS, words: str | None = None,
) -> DataFrame:
    """Add the exact BM25 top k of an ``index_terms`` table to each query row; null where nothing matched.

    ``words`` names a column with the search words of the text, if there is one; it is dropped.
    Only words that the index has tell queries apart, so many texts share few answers; these are written, and their true size
    decides between a broadcast and a shuffle. The rows are written with their known words, so that each is computed once.
    """
    prepared = I.prepare(index, shard_rows)
    asked = X.search_words(F.coalesce(F.col(text), F.lit(""))) if words is None else F.col(words)
    keyed = sinks.stage(I.known(prepared, queries, asked, () if words is None else (words,)), "asked")
    answers = sinks.stage(known_answers(keyed, prepared, k, details, detail_key), "answers")
    keyed = keyed.withColumn("query_key", F.col("known.query_id")).drop("known")
    return keyed.join(answers.select(F.col("query_id").alias("query_key"), F.col("hits").alias(out)), "query_key", "left").drop("query_key")


def with_text_hits(
    queries: DataFrame, answers: DataFrame, text: str = "text", out: str = "hits"
) -> DataFrame:
    """Add the ``text_answers`` hits to each query row; null where nothing matched.

    One join on the word set: no second pass by query id. Write ``answers`` first
    (``sinks.stage``) and its true size decides between a broadcast and a shuffle.
    """
    return (
        queries.withColumn("asked", asked_key(asked_words(F.col(text))))
        .join(answers.withColumnRenamed("hits", out), "asked", "left")
        .drop("asked")
    )


def text_topk(
    queries: DataFrame, index: DataFrame, k: int = 3, query_id: str = "query_id", text: str = "text",
    details: DataFrame | None = None, detail_key: str = "doc_id", shard_rows: int = I.SHARD_ROWS,
) -> DataFrame:
    """Exact BM25 top k of an ``index_terms`` table: (query_id, rank, corpus_id, score, details)."""
    slim = queries.select(F.col(query_id).alias("query_id"), X.search_words(F.coalesce(F.col(text), F.lit(""))).alias("asked_words"))
    found = with_top_text(slim, index, k, out="hits", details=details, detail_key=detail_key, shard_rows=shard_rows, words="asked_words")
    return found.select("query_id", F.inline("hits"))


def context_of(hits: Column, per_doc: int = 1000) -> Column:
    """Title and head of each hit's content, in rank order, or the no-context text."""
    texts = F.transform(
        hits, lambda h: F.concat(h["title"], F.lit("\n"), F.substring(h["content"], 1, per_doc))
    )
    return F.coalesce(F.array_join(texts, "\n\n"), F.lit(policy.NO_CONTEXT))


def build_context(tickets: DataFrame, hits: str = "hits", per_doc: int = 1000) -> DataFrame:
    """Add ``context`` from a column of ranked hits with title and content."""
    return tickets.withColumn("context", context_of(F.col(hits), per_doc))


# --- history -------------------------------------------------------------------------


def resolved(history: DataFrame) -> DataFrame:
    return history.filter(F.col("resolved_at").isNotNull())


def index_history(history: DataFrame) -> DataFrame:
    """``index_terms`` of the resolved tickets."""
    return index_terms(resolved(history), "ticket_id", "ticket_text")


def latest_rows(history: DataFrame, k: int, by: str | None = None) -> DataFrame:
    """The k latest resolved tickets, per ``by`` value or over all.

    The rank limit is applied inside each partition before the shuffle, so a hot team
    sends at most k rows per task.
    """
    history = resolved(history)
    if by is None:
        return history.orderBy(F.col("resolved_at").desc(), F.col("ticket_id")).limit(k).withColumn(
            "rank", F.row_number().over(Window.orderBy(F.col("resolved_at").desc(), F.col("ticket_id")))
        )
    order = Window.partitionBy(by).orderBy(F.col("resolved_at").desc(), F.col("ticket_id"))
    return history.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


HISTORY_COLUMNS = ("ticket_id", "ticket_text", "root_cause", "resolution", "resolution_time_hours", "resolved_at")


def history_lookup(history: DataFrame, k: int = 3, by: str = "team") -> DataFrame:
    """(history_team, recent): the k latest rows per team, and of any team under a null team.

    One row per team; stage it and joins broadcast it for as long as it is small.
    """
    slim = history.select(by, *HISTORY_COLUMNS)
    per_team = latest_rows(slim, k, by).withColumnRenamed(by, "history_team")
    any_team = latest_rows(slim, k).drop(by).withColumn("history_team", F.lit(None).cast("string"))
    return (
        per_team.unionByName(any_team)
        .groupBy("history_team")
        .agg(F.sort_array(F.collect_list(F.struct("rank", *HISTORY_COLUMNS))).alias("recent"))
    )


def recent_history(
    tickets: DataFrame, lookup: DataFrame, team: str = "assigned_team", out: str = "history"
) -> DataFrame:
    """Add recent resolved tickets of the ticket's team; any team's if it has none."""
    teams = lookup.filter(F.col("history_team").isNotNull()).select(
        F.col("history_team").alias(team), F.col("recent").alias("team_recent")
    )
    fallback = lookup.filter(F.col("history_team").isNull()).select("recent").scalar()
    return (
        tickets.join(teams, team, "left")
        .withColumn(out, F.coalesce("team_recent", fallback))
        .drop("team_recent")
    )


def similar_history(
    tickets: DataFrame, history: DataFrame, k: int = 3, key: str = "ticket_id", text: str = "ticket_text",
    index: DataFrame | None = None,
) -> DataFrame:
    """The k most similar resolved tickets by text, with their resolutions.

    ``index`` is a written ``index_history`` table, if there is one.
    """
    if index is None:
        index = index_history(history)
    details = history.select("ticket_id", "root_cause", "resolution", "resolution_time_hours", "resolved_at")
    return text_topk(tickets, index, k, key, text, details, "ticket_id").withColumnsRenamed(
        {"query_id": key, "corpus_id": "similar_ticket_id"}
    )


# --- index upkeep ----------------------------------------------------------------------


def index_gap(source: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys in the source but not the index (missing) and the reverse (orphaned)."""
    s = source.select(key).distinct().withColumn("in_source", F.lit(True))
    i = index.select(key).distinct().withColumn("in_index", F.lit(True))
    both = s.join(i, key, "full")
    return both.filter(F.col("in_source").isNull() | F.col("in_index").isNull()).select(
        key, F.when(F.col("in_index").isNull(), "missing").otherwise("orphaned").alias("status")
    )


def index_gap_counts(source: DataFrame, index: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row: source and index sizes, missing and orphaned counts."""
    s = source.select(key).distinct().withColumn("in_source", F.lit(True))
    i = index.select(key).distinct().withColumn("in_index", F.lit(True))
    return s.join(i, key, "full").agg(
        F.count("in_source").alias("source_rows"),
        F.count("in_index").alias("index_rows"),
        F.count_if(F.col("in_index").isNull()).alias("missing"),
        F.count_if(F.col("in_source").isNull()).alias("orphaned"),
    )
