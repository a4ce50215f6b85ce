"""One registered query per operator, over the views of ``fixtures``.

Arrays are shown as text joined with "|" so that every engine prints them alike.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.functions import scoring as S
from ticketloom.functions import sqlfuncs
from ticketloom.functions import text as X
from ticketloom.operators import kb, reload, retrieval, routing, rulebook, scoring, sla, stats, tickets
from ticketloom.operators.worktime import WorkCalendar, yearly
from ticketloom.plans import fixtures as fx
from ticketloom.sources import readers, sinks
from ticketloom.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LOADED_AT = "2024-01-01 00:00:00"
#: Mondays to Fridays from nine to five, without the days around the turn of the year and two in spring and autumn.
CALENDAR = WorkCalendar(holidays=yearly(range(1990, 2031), (1, 1), (5, 1), (10, 3), (12, 24), (12, 25), (12, 26), (12, 31)))


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def piped(col: str | Column) -> Column:
    return F.array_join(col, "|")


def _tickets(spark: SparkSession, sf: str) -> DataFrame:
    return tickets.build_tickets(fx.v_tickets(spark, sf)).withColumn(
        "submitted_date", F.col("submitted_date").cast("timestamp_ntz")
    )


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    return kb.chunk_documents(fx.v_kb_docs(spark, sf), F.lit(LOADED_AT))


def _scored(spark: SparkSession, sf: str, extract: bool = True) -> DataFrame:
    return scoring.score_tickets(_tickets(spark, sf), sender="submitted_by", extract=extract)


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, extract=False).select(
        "ticket_id", "ticket_text", "submitted_date", "expected_category", "expected_priority", "expected_team",
        F.col("scored.category").alias("category"), F.col("scored.priority").alias("priority"),
        F.col("scored.assigned_team").alias("assigned_team"), F.col("scored.confidence").alias("confidence"),
        F.col("scored.urgency_level").alias("urgency_level"),
    )


def _entries(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled runbook entries as searchable articles."""
    return kb.extract_kb_entries(fx.v_runbooks(spark, sf)).select(
        F.concat("filename", F.lit("#"), F.col("block_no").cast("string")).alias("doc_id"),
        F.col("entry_title").alias("title"),
        F.col("entry_text").alias("content"),
    )


def _scored_once(spark: SparkSession, sf: str, fields: Sequence[str]) -> DataFrame:
    """Tickets with some fields of their score and their words in ``words``, for the search."""
    return scoring.score_tickets(_tickets(spark, sf), sender="submitted_by", fields=fields, words="words")


def _with_entry_hits(spark: SparkSession, sf: str, df: DataFrame, k: int, words: str | None = None) -> DataFrame:
    """Tickets with their k best runbook entries in ``hits``."""
    entries = sinks.stage(_entries(spark, sf), "entries")
    index = sinks.stage(retrieval.index_terms(entries), "index")
    return retrieval.with_top_text(df, index, k, "ticket_text", details=entries, words=words)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.v_lines(spark, sf).select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("query_id"), "text"
    )


# --- sources and sinks ---------------------------------------------------------------


@query
def read_text_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as one text file each and read back whole."""
    path = sinks.scratch_dir(spark, "texts")
    source = fx.table(spark, sf, "documents")
    sinks.export_texts(source, path, "text", "doc_id", source.count())
    docs = readers.read_text_docs(spark, path)
    return docs.select(
        F.col("path").endswith(F.concat(F.lit("/"), "filename")).alias("named"),
        F.length("content").alias("chars"), F.md5(F.encode("content", "utf-8")).alias("content_hash"),
    )


@query
def read_tickets_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = sinks.scratch_dir(spark, "csv")
    sinks.export_results_csv(_tickets(spark, sf).select("ticket_id", "ticket_text", "submitted_by"), path)
    return readers.read_tickets_csv(spark, path).select("ticket_id", "ticket_text", "submitted_by")


@query
def read_ticket_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tickets.read_ticket_lines(fx.v_lines(spark, sf), "text", ["conv_id", "turn"])


@query
def build_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return _tickets(spark, sf)


@query
def write_table(spark: SparkSession, sf: str) -> DataFrame:
    """A full load of history, then an incremental load of the tickets, which is run again."""
    path = sinks.scratch_dir(spark, "table")
    sinks.write_table(fx.v_history(spark, sf).select("ticket_id", "ticket_text"), path, "full")
    for _ in range(2):
        sinks.write_table(_tickets(spark, sf).select("ticket_id", "ticket_text"), path, "incremental")
    return sinks.read_table(spark, path)


@query
def upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Loaded documents brought up to date with the new and changed ones."""
    loaded = fx.v_kb_loaded(spark, sf)
    fresh = kb.select_new_docs(fx.v_kb_docs(spark, sf), loaded).select("filename", "content_hash")
    return sinks.upsert(loaded, fresh, "filename")


@query
def upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert through two versions of a written table."""
    path = sinks.scratch_dir(spark, "upsert")
    sinks.upsert_table(fx.v_kb_loaded(spark, sf), path, "filename", buckets=8)
    fresh = kb.select_new_docs(fx.v_kb_docs(spark, sf), sinks.read_keyed(spark, path))
    sinks.upsert_table(fresh.select("filename", "content_hash"), path, "filename", buckets=8)
    return sinks.read_keyed(spark, path)


@query
def export_results_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = sinks.scratch_dir(spark, "results")
    batch = scoring.batch_classify(_tickets(spark, sf), sender="submitted_by")
    sinks.export_results_csv(batch, path)
    back = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return back.groupBy("category", "priority", "team", "urgency").agg(
        F.count("*").alias("tickets"), F.sum(F.length("ticket_text")).alias("preview_chars")
    )


@query
def export_analysis_json(spark: SparkSession, sf: str) -> DataFrame:
    """Whole analysis records with articles and history, written and read back."""
    path = sinks.scratch_dir(spark, "json")
    sinks.export_analysis_json(_analysis(spark, sf), path, "gzip")
    back = spark.read.schema(
        "ticket_id STRING, ticket STRING, "
        "classification STRUCT<category: STRING, priority: STRING, assigned_team: STRING, confidence: DOUBLE>, "
        "metadata STRUCT<priority_score: DOUBLE, urgency_level: STRING, affected_systems: ARRAY<STRING>, technical_keywords: ARRAY<STRING>, "
        "user_impact: STRING, requires_escalation: BOOLEAN>, knowledge_articles INT, "
        "articles ARRAY<STRUCT<rank: INT, corpus_id: STRING, title: STRING>>, "
        "history ARRAY<STRUCT<rank: INT, ticket_id: STRING, resolution: STRING>>, recommendations ARRAY<STRING>"
    ).json(path)

    def listed(column: str, key: str, text: str) -> Column:
        return F.coalesce(piped(F.transform(column, lambda x: F.concat(x[key], F.lit(":"), x[text]))), F.lit(""))

    m = F.col("metadata")
    return back.select(
        "ticket_id", "ticket", "classification.*", m["priority_score"].alias("priority_score"), m["urgency_level"].alias("urgency_level"),
        piped(m["affected_systems"]).alias("affected_systems"), piped(m["technical_keywords"]).alias("technical_keywords"),
        m["user_impact"].alias("user_impact"), m["requires_escalation"].alias("requires_escalation"), "knowledge_articles",
        listed("articles", "corpus_id", "title").alias("articles"), listed("history", "ticket_id", "resolution").alias("history"),
        piped("recommendations").alias("recommendations"),
    )


@query
def select_new_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs, loaded = fx.v_kb_docs(spark, sf), fx.v_kb_loaded(spark, sf)
    keys = sinks.stage(kb.new_doc_keys(docs, loaded), "keys")
    fresh = kb.select_new_docs(docs, loaded, keys)
    return fresh.select("filename", "content_hash", F.length("content").alias("chars"))


@query
def reload_kb(spark: SparkSession, sf: str) -> DataFrame:
    """Four loads of all documents: full; French ones cut, German ones gone; French ones back, Spanish ones gone; German ones back."""
    path = sinks.scratch_dir(spark, "kb")
    docs = fx.v_kb_docs(spark, sf).select("filename", "content", F.coalesce("lang", F.lit("")).alias("lang"))
    half = F.substring("content", F.lit(1), F.floor(F.length("content") / 2).cast("int"))
    cut = docs.withColumn("content", F.when(F.col("lang") == "fr", half).otherwise(F.col("content")))
    loads = (docs, cut.filter("lang <> 'de'"), docs.filter("lang NOT IN ('de', 'es')"), docs.filter("lang <> 'es'"))
    for n, source in enumerate(loads):
        reload.reload_kb(source.select("filename", "content"), path, F.lit(LOADED_AT), "incremental" if n else "full", buckets=8)
    loaded = reload.read_loads(spark, path).select("filename", "content_hash")
    chunks = reload.read_kb(spark, path).groupBy("filename").agg(
        F.count("*").alias("chunks"), F.count_distinct("doc_id").alias("ids"), F.sum("char_count").alias("chars"))
    return loaded.join(chunks, "filename", "left")


# --- projections and filters ---------------------------------------------------------


@query
def ticket_listing(spark: SparkSession, sf: str) -> DataFrame:
    return tickets.ticket_listing(
        _tickets(spark, sf), ["ticket_id", "subject", "expected_priority", "expected_team"], ["ticket_id"]
    )


@query
def ticket_listing_first(spark: SparkSession, sf: str) -> DataFrame:
    """The reports of the first fifteen tickets."""
    return tickets.ticket_listing(_tickets(spark, sf), ["ticket_id", "subject"], ["ticket_id"], 15)


@query
def ticket_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return tickets.ticket_by_id(_tickets(spark, sf), "EVT-000000000001").select(
        "ticket_id", "ticket_text", "submitted_by"
    )


@query
def drop_blank_tickets(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.v_kb_docs(spark, sf).select("filename", F.explode(F.split("content", "\n")).alias("ticket_text"))
    return tickets.drop_blank_tickets(lines).groupBy("filename").agg(
        F.count("*").alias("lines"), F.sum(F.length("ticket_text")).alias("chars")
    )


@query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return tickets.add_previews(docs, "text").drop("text")


@query
def display_values(spark: SparkSession, sf: str) -> DataFrame:
    events = fx.table(spark, sf, "events").select(
        "event_id",
        F.expr("nullif(event_type, 'view')").alias("kind"),
        F.col("value").cast("string").alias("score"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("code"),
        F.col("event_type").alias("word"),
        F.when(F.col("event_type") == "click", "").otherwise(F.col("value").cast("string")).alias("gap"),
    )
    return tickets.display_values(events, {"kind": "N/A"}, ["score", "code", "word", "gap"])


@query
def match_doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.v_kb_docs(spark, sf)
    old_style = docs.select(
        F.concat(kb.infer_doc_type(F.col("filename")), F.lit("_"),
                 F.lpad(F.col("source_id").cast("string"), 3, "0")).alias("doc_id")
    )
    ids = _chunks(spark, sf).select("doc_id").unionByName(old_style)
    return kb.match_doc_ids(ids, F.lit("Guide"), F.lit("CLOUD_GUIDE_4"))


# --- knowledge base --------------------------------------------------------------------


@query
def infer_doc_type(spark: SparkSession, sf: str) -> DataFrame:
    return fx.v_kb_docs(spark, sf).select("filename", kb.infer_doc_type(F.col("filename")).alias("doc_type"))


@query
def infer_kb_category(spark: SparkSession, sf: str) -> DataFrame:
    return fx.v_kb_docs(spark, sf).select("filename", kb.infer_kb_category(F.col("filename")).alias("category"))


@query
def doc_identity(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select(
        F.concat(F.lit("note "), "source", F.lit(" "), F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
        F.col("text").alias("content"),
    )
    return kb.doc_identity(docs).select("filename", "file_id", "doc_title", "doc_type", "category")


@query
def detect_headers(spark: SparkSession, sf: str) -> DataFrame:
    return kb.detect_headers(fx.v_kb_docs(spark, sf)).select("filename", "line_no", "is_header", "opens_section")


@query
def split_sections(spark: SparkSession, sf: str) -> DataFrame:
    return kb.split_sections(fx.v_kb_docs(spark, sf))


@query
def split_paragraphs(spark: SparkSession, sf: str) -> DataFrame:
    return kb.split_paragraphs(kb.split_sections(fx.v_kb_docs(spark, sf)))


@query
def pack_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return kb.pack_chunks(kb.split_sections(fx.v_kb_docs(spark, sf)))


@query
def extract_keywords(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.table(spark, sf, "documents")
    docs = readers.spread_small(source.select("doc_id", "text"), source)
    return kb.extract_keywords(docs, "text").select("doc_id", piped("keywords").alias("keywords"))


@query
def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).withColumns({
        "keywords": piped("keywords"),
        "created_at": F.col("created_at").cast("timestamp_ntz"),
    })


@query
def extract_kb_entries(spark: SparkSession, sf: str) -> DataFrame:
    return kb.extract_kb_entries(fx.v_runbooks(spark, sf)).select(
        "filename", "block_no", "entry_title", "priority", piped("affected_systems").alias("affected_systems"),
        piped("steps").alias("steps"), "avg_resolution_minutes", "escalation",
    )


# --- scoring ------------------------------------------------------------------------------


@query
def match_rules(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.match_rules(_tickets(spark, sf), sender="submitted_by").select(
        "ticket_id", F.array_join(F.col("fired_rules").cast("array<string>"), "|").alias("fired_rules"),
        "set_priority", "min_priority", "rule_urgency", "rule_category", "rule_team",
        piped("notify").alias("notify"), piped("actions").alias("actions"),
    )


@query
def match_rule_table(spark: SparkSession, sf: str) -> DataFrame:
    """The policy's rules given as a table."""
    matched = rulebook.match_rule_table(_tickets(spark, sf), rulebook.rule_table(spark), sender="submitted_by")
    return matched.select(
        "ticket_id", F.array_join(F.col("fired_rules").cast("array<string>"), "|").alias("fired_rules"),
        "set_priority", "min_priority", "rule_urgency", "rule_category", "rule_team",
        piped("notify").alias("notify"), piped("actions").alias("actions"),
    )


@query
def score_team_table(spark: SparkSession, sf: str) -> DataFrame:
    """The team that most keywords of a table speak for."""
    scores = rulebook.score_team_table(_tickets(spark, sf), rulebook.keyword_table(spark))
    return scores.filter("best").select("ticket_id", F.col("team").alias("best_team"))


@query
def score_teams(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_teams(_tickets(spark, sf)).select(
        "ticket_id",
        piped(F.transform("team_scores", lambda s: F.concat(s["team"], F.lit("="), s["score"].cast("string")))).alias("scores"),
        "best_team",
    )


@query
def classify_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.classify_tickets(_tickets(spark, sf), sender="submitted_by").select(
        "ticket_id", "classification.category", "classification.priority",
        "classification.assigned_team", "classification.confidence",
    )


@query
def priority_from_score(spark: SparkSession, sf: str) -> DataFrame:
    """Bands of a score, there and back, over all events."""
    score = F.least(F.col("value") / 100, F.lit(1.0))
    return fx.table(spark, sf, "events").select(
        "event_id",
        scoring.priority_from_score(score).alias("priority"),
        scoring.score_from_priority(scoring.priority_from_score(score)).alias("band_score"),
    )


@query
def extract_entities(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.extract_entities(_tickets(spark, sf)).select(
        "ticket_id", piped("affected_systems").alias("affected_systems"),
        piped("technical_keywords").alias("technical_keywords"),
    )


@query
def user_impact(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.user_impact(_tickets(spark, sf)).select("ticket_id", "user_impact")


@query
def urgency_and_escalation(spark: SparkSession, sf: str) -> DataFrame:
    """From the labelled priority, the impact found and whether a VIP wrote."""
    df = scoring.user_impact(_tickets(spark, sf)).withColumn("vip", F.col("submitted_by").rlike(policy.SENDER_PATTERN))
    return scoring.urgency_and_escalation(df, "expected_priority", "user_impact", "vip").select(
        "ticket_id", "urgency_level", "requires_escalation"
    )


@query
def extract_metadata(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("metadata")
    return scoring.extract_metadata(_tickets(spark, sf), sender="submitted_by").select(
        "ticket_id", m["priority_score"].alias("priority_score"), m["urgency_level"].alias("urgency_level"),
        piped(m["affected_systems"]).alias("affected_systems"),
        piped(m["technical_keywords"]).alias("technical_keywords"),
        m["user_impact"].alias("user_impact"), m["requires_escalation"].alias("requires_escalation"),
    )


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    """Model-like answers made from event rows: whole, partial, mistyped and broken."""
    e = fx.table(spark, sf, "events")
    whole = F.format_string('{"category": "%s", "priority": "P2", "confidence": %s}', F.col("event_type"), F.col("value").cast("string"))
    partial = F.format_string('{"category": "%s"}', F.col("event_type"))
    mistyped = F.format_string('{"category": "%s", "priority": "P1", "confidence": "high"}', F.col("event_type"))
    answer = (
        F.when(F.col("event_type") == "click", whole).when(F.col("event_type") == "view", partial)
        .when(F.col("event_type") == "error", mistyped).when(F.col("event_type") == "signup", F.concat(F.lit("Sorry, no. "), "props"))
    )
    return e.select("event_id", answer.alias("response"))


@query
def parse_model_response(spark: SparkSession, sf: str) -> DataFrame:
    defaults = {"category": "Software", "priority": "P3", "confidence": 0.5}
    parsed = scoring.parse_model_response(
        _responses(spark, sf), "response",
        {"category": "string", "priority": "string", "confidence": "double"},
        defaults, {**defaults, "confidence": 0.0},
    )
    return parsed.select("event_id", "parsed.category", "parsed.priority", "parsed.confidence", "raw_response")


def _length_model():
    """A stand-in for a user's model: deterministic, fails on texts about a virus."""
    def run(rows):
        if rows["ticket_text"].str.contains("virus").any():
            raise RuntimeError("refused")
        return [{"label": "long" if len(t) > 150 else "short", "n": len(t)} for t in rows["ticket_text"]]

    return run


@query
def apply_model(spark: SparkSession, sf: str) -> DataFrame:
    df = _tickets(spark, sf).select("ticket_id", "ticket_text")
    return scoring.apply_model(df, _length_model, "label STRING, n BIGINT", {"label": "failed", "n": 0}).drop("ticket_text")


@query
def build_prompt(spark: SparkSession, sf: str) -> DataFrame:
    context = retrieval.build_context(_with_entry_hits(spark, sf, _tickets(spark, sf), 1))
    return scoring.build_prompt(
        context, scoring.PROMPT_TEMPLATE, ticket="ticket_text", context="context"
    ).select("ticket_id", "prompt")


@query
def generate_summary(spark: SparkSession, sf: str) -> DataFrame:
    hit = _with_entry_hits(spark, sf, _scored_once(spark, sf, S.GENERATE_FIELDS), 1, "words").withColumn(
        "context", F.get("hits", F.lit(0))["content"]
    )
    g = F.col("generated")
    return scoring.generate_summary(hit, scored="scored").select(
        "ticket_id", g["summary"].alias("summary"), piped(g["recommendations"]).alias("recommendations"),
        piped(g["resolution_steps"]).alias("resolution_steps"),
        g["estimated_resolution_time"].alias("estimated_resolution_time"),
    )


def _quick_columns(df: DataFrame) -> DataFrame:
    q = F.col("quick")
    return df.select(
        "ticket_id", q["category"].alias("category"), q["priority"].alias("priority"),
        q["assigned_team"].alias("assigned_team"), q["urgency_level"].alias("urgency_level"),
        q["priority_score"].alias("priority_score"), piped(q["affected_systems"]).alias("affected_systems"),
        q["summary"].alias("summary"), piped(q["recommendations"]).alias("recommendations"),
    )


@query
def quick_classify(spark: SparkSession, sf: str) -> DataFrame:
    return _quick_columns(scoring.quick_classify(_tickets(spark, sf), sender="submitted_by"))


@query
def batch_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Batch results of every ticket and every user line of the conversations."""
    lines = tickets.read_ticket_lines(fx.v_lines(spark, sf), "text").select("ticket_text", F.lit(None).cast("string").alias("submitted_by"))
    both = _tickets(spark, sf).select("ticket_text", "submitted_by").unionByName(lines)
    return scoring.batch_classify(both, sender="submitted_by")


@query
def recommend_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Articles found is the priority's number, history exists for owned teams."""
    articles = F.substring("priority", 2, 1).cast("int") - 1
    actions = routing.recommend_actions(
        F.col("priority"), F.col("assigned_team"), articles, F.col("confidence") > 0.5
    )
    return _classified(spark, sf).select("ticket_id", piped(actions).alias("recommendations"))


@query
def route_tools(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select(
        "ticket_id",
        piped(routing.route_tools(F.col("priority"))).alias("prompt_tools"),
        piped(routing.route_tools(F.col("priority"), "observed")).alias("observed_tools"),
    )


@query
def estimate_cost(spark: SparkSession, sf: str) -> DataFrame:
    stages = F.when(F.col("priority") == "P4", X.string_array(("classify", "extract"))).otherwise(
        X.string_array(("classify", "extract", "search", "generate"))
    )
    return _classified(spark, sf).select(
        "ticket_id",
        routing.estimate_cost(stages).cast("double").alias("stage_cost"),
        routing.tool_cost(routing.route_tools(F.col("priority"))).cast("double").alias("tool_cost"),
    )


def _analysis(spark: SparkSession, sf: str) -> DataFrame:
    lookup = sinks.stage(retrieval.history_lookup(fx.v_history(spark, sf)), "lookup")
    scored = _scored_once(spark, sf, [*routing.CLASSIFICATION, *routing.METADATA])
    found = _with_entry_hits(spark, sf, scored, 3, "words").withColumn("assigned_team", F.col("scored.assigned_team"))
    staged = retrieval.recent_history(found, lookup)
    return routing.analyze_tickets(staged, "hits", "history")


@query
def analyze_tickets(spark: SparkSession, sf: str) -> DataFrame:
    return _analysis(spark, sf).select(
        "ticket_id", "ticket", F.col("classification.category").alias("category"),
        F.col("classification.priority").alias("priority"),
        F.col("classification.assigned_team").alias("assigned_team"),
        F.col("metadata.urgency_level").alias("urgency_level"),
        F.col("metadata.requires_escalation").alias("requires_escalation"),
        "knowledge_articles",
        piped(F.transform("articles", lambda a: a["corpus_id"])).alias("articles"),
        piped(F.transform("history", lambda h: h["ticket_id"])).alias("history"),
        piped("recommendations").alias("recommendations"),
    )


@query
def compare_approaches(spark: SparkSession, sf: str) -> DataFrame:
    return routing.compare_approaches(_classified(spark, sf)).withColumn("total_cost", F.col("total_cost").cast("double"))


# --- retrieval -------------------------------------------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "embeddings").select("vec_id", "embedding")


@query
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector's three nearest among all the others."""
    v = _vectors(spark, sf)
    return retrieval.vector_topk(v, v, 3, "vec_id", "vec_id", exclude_same_id=True)


@query
def vector_topk_approx(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return retrieval.vector_topk_approx(v, v, 3, "vec_id", "vec_id", exclude_same_id=True)


@query
def vector_recall(spark: SparkSession, sf: str) -> DataFrame:
    """The approximate search held against the exact one: pairs, wrong scores, and whether nine tenths are found."""
    v = _vectors(spark, sf)
    near = retrieval.vector_topk_approx(v, v, 3, "vec_id", "vec_id", exclude_same_id=True).select(
        "query_id", "corpus_id", F.col("score").alias("near_score"))
    true = retrieval.vector_topk(v, v, 3, "vec_id", "vec_id", exclude_same_id=True)
    both = true.join(near, ["query_id", "corpus_id"], "left")
    return both.agg(
        F.count("*").alias("pairs"), F.count_if(F.col("score") != F.col("near_score")).alias("wrong_scores"),
        (F.count("near_score") >= 0.9 * F.count("*")).alias("found"),
    )


@query
def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    chunks = sinks.stage(_chunks(spark, sf).select("doc_id", "content"), "chunks")
    model = retrieval.fit_embedder(chunks)
    embedded = retrieval.embed_text(chunks, model)
    return embedded.select(
        "doc_id", F.size("embedding").alias("dims"),
        F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x), 4).alias("squared_norm"),
    )


@query
def text_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Three best chunks for every user line of the conversations."""
    index = sinks.stage(retrieval.index_terms(_chunks(spark, sf)), "index")
    return retrieval.text_topk(_lines(spark, sf), index)


@query
def build_context(spark: SparkSession, sf: str) -> DataFrame:
    chunks = sinks.stage(_chunks(spark, sf).select("doc_id", "title", "content"), "chunks")
    lines = _lines(spark, sf)
    index = sinks.stage(retrieval.index_terms(chunks), "index")
    return retrieval.build_context(retrieval.with_top_text(lines, index, 3, details=chunks)).select("query_id", "context")


@query
def recent_history(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets routed by their label, except that one team is unknown to history."""
    t = _tickets(spark, sf).select(
        "ticket_id",
        F.when(F.col("expected_team") == "Cloud", "Platform").otherwise(F.col("expected_team")).alias("assigned_team"),
    )
    lookup = sinks.stage(retrieval.history_lookup(fx.v_history(spark, sf)), "lookup")
    found = retrieval.recent_history(t, lookup).select("ticket_id", "assigned_team", F.explode("history").alias("h"))
    return found.select(
        "ticket_id", "assigned_team", F.col("h.rank").alias("rank"), F.col("h.ticket_id").alias("history_ticket_id"),
        F.col("h.resolution").alias("resolution"), F.col("h.resolved_at").alias("resolved_at"),
    )


@query
def similar_history(spark: SparkSession, sf: str) -> DataFrame:
    history = fx.v_history(spark, sf)
    index = sinks.stage(retrieval.index_history(history), "index")
    found = retrieval.similar_history(_tickets(spark, sf), history, index=index)
    return found.select("ticket_id", "similar_ticket_id", "score", "rank", "resolution")


@query
def assign_sla(spark: SparkSession, sf: str) -> DataFrame:
    due = sla.assign_sla(_classified(spark, sf), sla.sla_table(spark))
    return due.select(
        "ticket_id", "priority", "urgency_level", "response_due", "resolution_due", "after_hours",
        "escalate_at", "tier2_until", "tier3_until", "management_at",
    )


@query
def assign_sla_business(spark: SparkSession, sf: str) -> DataFrame:
    """Due times in business days where a ticket waits for the next one, and the working minutes until then."""
    due = sla.assign_sla(_classified(spark, sf), sla.sla_table(spark), calendar=CALENDAR)
    return due.select(
        "ticket_id", "priority", "urgency_level", "response_due", "resolution_due", "escalate_at", "management_at",
        CALENDAR.elapsed(F.col("submitted_date"), F.col("resolution_due")).alias("working_minutes"),
    )


@query
def index_gap(spark: SparkSession, sf: str) -> DataFrame:
    """Chunked documents against an index of the labelled and the benchmark items."""
    source = fx.table(spark, sf, "documents").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_id"))
    index = (
        fx.table(spark, sf, "labels").select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_id"))
        .unionByName(fx.table(spark, sf, "benchmark").select(F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("doc_id")))
    )
    return retrieval.index_gap(source, index)


@query
def index_gap_counts(spark: SparkSession, sf: str) -> DataFrame:
    source = fx.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"))
    index = fx.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("doc_id"))
    return retrieval.index_gap_counts(source, index)


# --- reports and checks -----------------------------------------------------------------------


@query
def tickets_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    return stats.tickets_by_priority(_tickets(spark, sf)).withColumn("ticket_ids", piped("ticket_ids"))


@query
def tickets_by_team(spark: SparkSession, sf: str) -> DataFrame:
    return stats.tickets_by_team(_tickets(spark, sf))


@query
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.chunk_stats(_chunks(spark, sf))


@query
def kb_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return stats.kb_inventory(_chunks(spark, sf))


FIELDS = {
    "category": ("expected_category", "category"),
    "priority": ("expected_priority", "priority"),
    "team": ("expected_team", "assigned_team"),
}


@query
def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """Measured accuracy of the literal rule table on the labelled tickets."""
    return stats.evaluate(_classified(spark, sf), FIELDS)


@query
def evaluate_extended(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the wider rule phrases."""
    judged = scoring.classify_tickets(_tickets(spark, sf), sender="submitted_by", rules=policy.EXTENDED_RULES)
    return stats.evaluate(judged.select("expected_category", "expected_priority", "expected_team", "classification.*"), FIELDS)


@query
def class_scores(spark: SparkSession, sf: str) -> DataFrame:
    return stats.class_scores(_classified(spark, sf), FIELDS)


@query
def evaluate_quality(spark: SparkSession, sf: str) -> DataFrame:
    """A length rule for document quality, judged against its labels."""
    docs = fx.table(spark, sf, "documents").select("doc_id", (F.col("n_chars") >= 1000).cast("int").alias("guess"))
    labels = fx.table(spark, sf, "labels").select("doc_id", "quality")
    return stats.class_scores(docs.join(labels, "doc_id"), {"quality": ("quality", "guess")})


@query
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return stats.confusion_matrix(_classified(spark, sf), "expected_priority", "priority", policy.PRIORITIES)


@query
def audit_sample(spark: SparkSession, sf: str) -> DataFrame:
    return stats.audit_sample(_tickets(spark, sf), 20, "audit-1").select("week", "draw_no", "ticket_id")


@query
def resolution_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return stats.resolution_metrics(fx.v_history(spark, sf))


@query
def sla_compliance(spark: SparkSession, sf: str) -> DataFrame:
    return sla.sla_compliance(fx.v_history(spark, sf), sla.sla_table(spark))


@query
def sla_compliance_business(spark: SparkSession, sf: str) -> DataFrame:
    return sla.sla_compliance(fx.v_history(spark, sf), sla.sla_table(spark), calendar=CALENDAR)


@query
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    results = _classified(spark, sf).withColumn("tools", routing.route_tools(F.col("priority")))
    results = results.withColumn("cost", routing.tool_cost(F.col("tools")))
    return stats.run_summary(results).withColumn("total_cost", F.col("total_cost").cast("double"))


@query
def check_ticket_table(spark: SparkSession, sf: str) -> DataFrame:
    """Checks over the tickets, with categories limited to three to show violations."""
    domains = {
        "expected_category": ("Hardware", "Software", "Security"),
        "expected_priority": policy.PRIORITIES,
        "expected_team": policy.TEAMS,
    }
    return stats.check_ticket_table(_tickets(spark, sf), domains=domains)


@query
def backlog_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """Classified tickets per priority with their earliest and latest due times."""
    open_tickets = tickets.drop_blank_tickets(_tickets(spark, sf))
    scored = scoring.score_tickets(open_tickets, sender="submitted_by", extract=False).select(
        "ticket_id", "submitted_date", "scored.priority", "scored.urgency_level"
    )
    due = sla.assign_sla(scored, sla.sla_table(spark))
    return due.groupBy("priority").agg(
        F.count("*").alias("tickets"),
        F.min("response_due").alias("first_response_due"),
        F.max("resolution_due").alias("last_resolution_due"),
    )


# --- streaming and SQL functions ---------------------------------------------------------------


@query
def sync_index(spark: SparkSession, sf: str) -> DataFrame:
    """Five syncs of a chunk table: a first load, one with nothing new, the removal of all policies' chunks, newer versions
    of equal content and repeated removals, and late rows that are older than these."""
    source, index, mark = (sinks.scratch_dir(spark, n) for n in ("chunks", "index", "mark"))
    columns = ["doc_id", "content", "created_at", F.lit(False).alias("removed")]
    _chunks(spark, sf).select(*columns).write.mode("append").option("compression", "zstd").parquet(source)
    written = spark.read.parquet(source)
    model = retrieval.fit_embedder(written)
    policies = F.col("doc_id").startswith("Policy")

    def dated(df: DataFrame, days: int) -> DataFrame:
        return df.withColumn("created_at", F.col("created_at") + F.make_dt_interval(F.lit(days)))

    gone = written.filter(policies).select("doc_id", F.lit(None).cast("string").alias("content"), "created_at", F.lit(True).alias("removed"))
    removal = dated(gone, 1)
    again = dated(written.filter(~policies), 4).unionByName(dated(gone, 3))
    other = written.withColumn("content", F.concat("content", F.lit(" (other)")))
    late = dated(other, -1).unionByName(dated(other, 2))
    for more in (None, written, removal, again, late):
        if more is not None:
            more.write.mode("append").option("compression", "zstd").parquet(source)
        streams.sync_index(
            spark, source, index, mark, lambda df: retrieval.embed_text(df, model),
            "doc_id STRING, content STRING, created_at TIMESTAMP, removed BOOLEAN", buckets=8, removed="removed",
        ).awaitTermination()
    return streams.read_index(spark, index, "removed").select("doc_id", "content_hash", F.size("embedding").alias("dims"))


@query
def classify_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events classified as a stream of arriving tickets."""
    out, mark = (sinks.scratch_dir(spark, n) for n in ("stream", "mark"))
    arriving = spark.readStream.schema(fx.table(spark, sf, "events").schema).option(
        "pathGlobFilter", "events.parquet"
    ).parquet(sf)
    arriving = readers.spread_small(arriving, fx.table(spark, sf, "events"))
    built = tickets.build_tickets(spark.sql(fx.for_spark(fx.V_TICKETS), events=arriving))
    scored = streams.classify_stream(built, sender="submitted_by").select(
        "ticket_id", "classification.category", "classification.priority", "classification.assigned_team",
        "metadata.urgency_level", "metadata.user_impact",
    )
    streams.start_append(scored, out, mark).awaitTermination()
    return spark.read.parquet(out)


@query
def classify_stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """The same stream with every event delivered twice: each ticket is classified and written once."""
    out, mark = (sinks.scratch_dir(spark, n) for n in ("once", "mark"))
    schema = fx.table(spark, sf, "events").schema
    one, two = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf) for _ in range(2))
    built = tickets.build_tickets(spark.sql(fx.for_spark(fx.V_TICKETS), events=one.unionByName(two)))
    scored = streams.classify_stream(streams.once_each(built, delay="60 days"), sender="submitted_by").select(
        "ticket_id", "classification.category", "classification.priority", "classification.assigned_team",
        "metadata.urgency_level", "metadata.user_impact",
    )
    streams.start_append(scored, out, mark).awaitTermination()
    return spark.read.parquet(out)


@query
def register_functions(spark: SparkSession, sf: str) -> DataFrame:
    """The SQL functions over a table."""
    sqlfuncs.register_functions(spark)
    return spark.sql(
        "SELECT ticket_id, c.category AS category, c.priority AS priority, c.assigned_team AS assigned_team, "
        "e.urgency_level AS urgency_level, array_join(e.technical_keywords, '|') AS technical_keywords, "
        "get_json_object(g, '$.estimated_resolution_time') AS estimate, q.summary AS summary "
        "FROM (SELECT ticket_id, ai_classify(ticket_text) AS c, ai_extract(ticket_text) AS e, "
        "ai_gen(ticket_text, ticket_text) AS g, quick_classify_ticket(ticket_text) AS q FROM {t})",
        t=_tickets(spark, sf),
    )
