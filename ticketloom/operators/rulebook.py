"""Rules and team keywords as tables of any length.

A rule table has the columns of ``RULES``; ``rule_table`` writes the policy's own rules as one. Phrases
go into a trie of words that is walked once over a ticket, so a ticket costs its words and its hits, however many
rules there are. The trie is sent to the tasks where the tables have at most ``MOST_SENT`` phrases; larger tables are
joined with the ticket's word runs instead. Both ways give the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import policy
from ticketloom.functions import text as X
from ticketloom.sources import sinks

MOST_SENT = 200_000
MOST_PATTERNS = 1000

RULES = (
    "rule_id int, phrases array<string>, unless array<string>, sender_pattern string, category string, team string, set_priority string, "
    "min_priority string, soon_phrases array<string>, soon_priority string, urgency string, raise_urgency boolean, notify string, action string"
)
EFFECTS = (
    "fired_rules array<int>, set_priority string, min_priority string, rule_urgency string, rule_category string, rule_team string, "
    "notify array<string>, actions array<string>"
)
PHRASE, UNLESS, SOON = range(3)
ROLES = {"phrases": PHRASE, "unless": UNLESS, "soon_phrases": SOON}
ALONE = ("set_priority", "min_priority", "urgency", "category", "team", "notify", "action", "soon_priority")


def rule_table(spark: SparkSession, rules: Sequence[policy.Rule] = policy.RULES) -> DataFrame:
    names = [f.split()[0] for f in RULES.split(", ")]
    lists = set(ROLES)
    return spark.createDataFrame([tuple(list(getattr(r, n)) if n in lists else getattr(r, n) for n in names) for r in rules], RULES)


def keyword_table(spark: SparkSession, keywords: Mapping[str, Sequence[str]] = policy.TEAM_KEYWORDS) -> DataFrame:
    """(team_no, team, phrase), the teams in their order."""
    rows = [(k, team, phrase) for k, (team, phrases) in enumerate(keywords.items()) for phrase in phrases]
    return spark.createDataFrame(rows, "team_no int, team string, phrase string")


class Trie:
    """Phrases as paths of words; what a phrase stands for lies at its end."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, words: list[str], value: tuple) -> None:
        node = self.root
        for w in words:
            node = node.setdefault(w, {})
        node.setdefault(None, []).append(value)

    def hits(self, words: list[str]) -> set[tuple]:
        """Values of all phrases that occur as whole words."""
        out: set[tuple] = set()
        for k, word in enumerate(words):
            node = self.root.get(word)
            while node is not None:
                if None in node:
                    out.update(node[None])
                k += 1
                node = node.get(words[k]) if k < len(words) else None
        return out


def combined(fired: list[dict], soon: set[int]) -> tuple:
    """The effects of fired rules, given in order of their ids: least priorities, the highest urgency, the first category and team, all notices and actions."""
    first = lambda name: next((r[name] for r in fired if r[name]), None)
    least = lambda values: min((v for v in values if v), default=None)
    urgent = {r["urgency"] for r in fired}
    return (
        [r["rule_id"] for r in fired],
        least((r["soon_priority"] if r["rule_id"] in soon else r["set_priority"]) if r["set_priority"] else None for r in fired),
        least(r["min_priority"] for r in fired), next((u for u in policy.URGENCIES if u in urgent), None), first("category"), first("team"),
        [r["notify"] for r in fired if r["notify"]], [r["action"] for r in fired if r["action"]],
    )


def phrase_rows(rules: DataFrame) -> DataFrame:
    """(rule_id, role, phrase) with phrases as words joined by one blank."""
    def of(column: str, role: int) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda p: F.struct(F.lit(role).alias("role"), F.trim(X.normalise(p)).alias("phrase")))

    each = [of(c, role) for c, role in ROLES.items()]
    return rules.select("rule_id", F.inline(F.concat(*each))).where("phrase <> ''").distinct()


def senders(rules: DataFrame) -> list[tuple[int, str]]:
    """Rules that look at the sender; a pattern has no index, so they are tried one by one and must be few."""
    found = [(r["rule_id"], r["sender_pattern"]) for r in rules.where("sender_pattern IS NOT NULL").select("rule_id", "sender_pattern").limit(MOST_PATTERNS + 1).collect()]
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} rules with a sender pattern")
    return found


def match_rule_table(df: DataFrame, rules: DataFrame, text: str = "ticket_text", sender: str | None = None, most_sent: int = MOST_SENT) -> DataFrame:
    """Fired rules of a table and their combined effects, as ``scoring.match_rules`` gives them for the policy's own.

    A rule fires if one of its phrases occurs as whole words or its pattern fits the sender, and none of its ``unless`` phrases
    occurs. Where a soon phrase occurs, the soon priority stands for the set one. Rules count in the order of their ids,
    which must differ.
    """
    phrases = sinks.stage(phrase_rows(rules), "phrases")
    patterns = senders(rules)
    who = F.lit(None).cast("string") if sender is None else F.lower(F.col(sender))
    if phrases.count() <= most_sent:
        return _by_trie(df, rules, phrases, patterns, text, who)
    return _by_join(df, rules, phrases, patterns, text, who)


def _by_trie(df: DataFrame, rules: DataFrame, phrases: DataFrame, patterns: list[tuple[int, str]], text: str, who: Column) -> DataFrame:
    trie = Trie()
    for r in phrases.collect():
        trie.add(r["phrase"].split(" "), (r["rule_id"], r["role"]))
    book = {r["rule_id"]: r.asDict() for r in rules.select("rule_id", *ALONE).collect()}
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((trie, book, patterns))
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(EFFECTS).fields])
    arrow = pa.schema([("fired_rules", pa.list_(pa.int32())), *[(n, pa.string()) for n in ("set_priority", "min_priority", "rule_urgency", "rule_category", "rule_team")],
                       ("notify", pa.list_(pa.string())), ("actions", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, book, patterns = sent.value
        tried = [(rule, re.compile(p)) for rule, p in patterns]
        memo: dict[str | None, list[int]] = {}
        for batch in batches:
            out = []
            for words, name in zip(batch.column("rule_words").to_pylist(), batch.column("rule_sender").to_pylist(), strict=True):
                hits = trie.hits(words)
                if name not in memo:
                    memo[name] = [rule for rule, p in tried if name is not None and p.search(name)]
                fired = {rule for rule, role in hits if role == PHRASE} | set(memo[name])
                fired -= {rule for rule, role in hits if role == UNLESS}
                out.append(combined([book[r] for r in sorted(fired)], {rule for rule, role in hits if role == SOON}))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(arrow), arrow.types, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], names=[*batch.schema.names[:-2], *arrow.names])

    worded = df.withColumns({"rule_words": X.search_words(F.coalesce(F.col(text), F.lit(""))), "rule_sender": who})
    return worded.mapInArrow(run, schema)


def word_runs(words: Column, longest: int) -> Column:
    """All runs of up to so many words, as text."""
    def of(n: int) -> Column:
        return F.transform(words, lambda w, i: F.when(i + n <= F.size(words), F.array_join(F.slice(words, i + 1, n), " ")))

    runs = [of(n) for n in range(1, longest + 1)]
    return F.array_distinct(F.array_compact(F.concat(*runs)))


def _by_join(df: DataFrame, rules: DataFrame, phrases: DataFrame, patterns: list[tuple[int, str]], text: str, who: Column) -> DataFrame:
    rows = sinks.stage(df.withColumn("rule_row", F.monotonically_increasing_id()), "tickets")
    longest = phrases.agg(F.max(F.size(F.split("phrase", " ")))).collect()[0][0] or 1
    words = X.search_words(F.coalesce(F.col(text), F.lit("")))
    runs = rows.select("rule_row", words.alias("w")).select("rule_row", F.explode(word_runs(F.col("w"), longest)).alias("phrase"))
    hits = runs.join(phrases, "phrase").groupBy("rule_row", "rule_id").agg(*(F.max((F.col("role") == r).cast("int")).alias(n) for n, r in (("p", PHRASE), ("u", UNLESS), ("s", SOON))))
    tried = [F.when(F.coalesce(who.rlike(p), F.lit(False)), F.lit(rule)) for rule, p in patterns]
    from_sender = rows.select("rule_row", F.explode(F.array_compact(F.array(*tried)) if tried else F.array().cast("array<int>")).alias("rule_id")).select(
        "rule_row", "rule_id", *(F.lit(v).alias(n) for n, v in (("p", 1), ("u", 0), ("s", 0))))
    fired = hits.unionByName(from_sender).groupBy("rule_row", "rule_id").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.max("s").alias("s")).where("p = 1 AND u = 0")
    met = fired.join(rules.select("rule_id", *ALONE), "rule_id")
    own = F.when(F.col("set_priority").isNotNull(), F.when(F.col("s") == 1, F.col("soon_priority")).otherwise(F.col("set_priority")))
    level = F.array_position(X.string_array(policy.URGENCIES), F.coalesce("urgency", F.lit("")))
    listed = lambda c: F.transform(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("rule_id", F.col(c).alias("v"))))), lambda x: x["v"])
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("rule_id")))
    effects = met.groupBy("rule_row").agg(
        F.sort_array(F.collect_list("rule_id")).alias("fired_rules"), F.min(own).alias("set_priority"), F.min("min_priority").alias("min_priority"),
        F.min_by("urgency", F.when(level > 0, level)).alias("rule_urgency"), first("category").alias("rule_category"), first("team").alias("rule_team"),
        listed("notify").alias("notify"), listed("action").alias("actions"))
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    return rows.join(effects, "rule_row", "left").select(
        *df.columns, none("fired_rules", "array<int>"), "set_priority", "min_priority", "rule_urgency", "rule_category", "rule_team",
        none("notify", "array<string>"), none("actions", "array<string>"))


def score_team_table(df: DataFrame, keywords: DataFrame, key: str = "ticket_id", text: str = "ticket_text", most_sent: int = MOST_SENT) -> DataFrame:
    """(key, team, score, best) for each team a ticket has keywords of: distinct keywords found, and the team with most, the first of equal ones.

    Rows of one key count as one ticket. Keywords are looked up inside each row, or joined with its word runs where there are more
    than ``most_sent``; only those found are shuffled.
    """
    phrases = sinks.stage(keywords.select("team_no", "team", F.trim(X.normalise(F.col("phrase"))).alias("phrase")).where("phrase <> ''").distinct(), "keywords")
    if phrases.count() <= most_sent:
        found = _keywords_by_trie(df.select(key, X.normalise(F.coalesce(F.col(text), F.lit(""))).alias("words")), phrases)
    else:
        longest = phrases.agg(F.max(F.size(F.split("phrase", " ")))).collect()[0][0] or 1
        words = X.search_words(F.coalesce(F.col(text), F.lit("")))
        runs = df.select(key, F.explode(X.let(words, lambda w: word_runs(w, longest))).alias("phrase"))
        found = runs.join(phrases, "phrase").select(key, "team_no", "team", "phrase")
    scores = found.distinct().groupBy(key, "team_no", "team").agg(F.count("*").alias("score"))
    best = F.row_number().over(Window.partitionBy(key).orderBy(F.col("score").desc(), "team_no")) == 1
    return scores.withColumn("best", best).drop("team_no")


def _keywords_by_trie(worded: DataFrame, phrases: DataFrame) -> DataFrame:
    """(key, team_no, team, phrase) of the phrases found in the words of each row."""
    trie = Trie()
    for r in phrases.collect():
        trie.add(r["phrase"].split(" "), (r["team_no"], r["team"], r["phrase"]))
    sent = worded.sparkSession.sparkContext.broadcast(trie)
    key, found = worded.schema.fields[0], [phrases.schema[n] for n in ("team_no", "team", "phrase")]
    arrow = [pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = sent.value
        for batch in batches:
            hits = [trie.hits(words.split()) for words in batch.column("words").to_pylist()]
            rows = pa.array([k for k, own in enumerate(hits) for _ in own], pa.int64())
            columns = [pa.array([hit[n] for own in hits for hit in own], t) for n, t in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *columns], names=[key.name, *(f.name for f in found)])

    return worded.mapInArrow(run, T.StructType([key, *found]))
