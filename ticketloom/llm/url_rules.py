"""URL filters: pattern rules indexed by their rarest literal token.

Rules are rows of a table: a host and a path prefix, or words that must stand in a host in their order. Each
becomes a regular expression over host and path with the literal tokens any match must hold, and is filed under
the one of them that is rarest in the table's URLs. A URL's own tokens are joined with this index, and only
the rules they fetch run. The index is broadcast where it has at most `MOST_SENT` rules and joined by a shuffle where it
has more; the work for a URL is its tokens and its candidates, however many rules there are. DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom.llm.frames import staged

#: Rules that are sent to every executor, at most.
MOST_SENT = 100_000

#: (host, path prefix) and verdict.
PREFIX_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)

#: Words that mark a host label as unwanted, for URLs that no prefix rule fits; every word must appear, in this order.
PATTERN_RULES = (
    ("casino",), ("cheap", "pills"), ("free", "bets"), ("adult",), ("ads", "track"), ("spam", "farm"),
)


RULES = "host string, path string, words array<string>, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, prefixes=PREFIX_RULES, patterns=PATTERN_RULES) -> DataFrame:
    """Rules as a table: (host, path, null, verdict) for prefixes, (null, null, words, block) for patterns."""
    return spark.createDataFrame([(h, p, None, v) for h, p, v in prefixes] + [(None, None, list(w), "block") for w in patterns], RULES)


def tokens_of(text: Column) -> Column:
    """Distinct runs of a-z and 0-9, A-Z lower-cased."""
    return F.array_remove(F.array_distinct(F.split(F.translate(text, UPPER, LOWER), "[^a-z0-9]+")), "")


def quoted(text: Column) -> Column:
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def compiled(rules: DataFrame) -> DataFrame:
    """(name, pattern, tokens, verdict, rank) of a table of rules; rank is 0 for patterns, else the rule's length.

    A rule without a literal token fails the job. Equal rules count once.
    """
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    # a path prefix may end inside a token, so only tokens that something follows are literal
    whole = tokens_of(F.concat(host, F.lit("/"), F.regexp_replace(path, "[^/]*$", "")))
    prefix = F.concat(F.lit("\\A(?:[^/]*\\.)?"), quoted(F.concat(host, path)))
    worded = F.concat(F.lit("\\A[^/]*(?<![a-z0-9])"), F.array_join(F.transform("words", quoted), "[^a-z0-9/]"), F.lit("(?![a-z0-9])"))
    is_words = F.col("words").isNotNull()
    rows = rules.distinct().select(
        F.when(is_words, "").otherwise(F.concat(host, path)).alias("name"), F.when(is_words, worded).otherwise(prefix).alias("pattern"),
        F.when(is_words, F.array_distinct("words")).otherwise(whole).alias("tokens"), "verdict", F.when(is_words, 0).otherwise(F.length(F.concat(host, path))).alias("rank"))
    bare = F.raise_error(F.concat(F.lit("every rule needs a literal token: "), F.col("pattern"))).cast("array<string>")
    return rows.withColumn("tokens", F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(bare))


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, n_candidates) for every row.

    The longest prefix rule that fits decides; else a pattern that fits blocks; else allow. `rules` is a table like
    `rule_table`; no rules allow everything. Null URLs and those without :// have an empty host and path and are allowed. Equal
    rows give equal results; an empty table gives none; other columns are not read. Two rules of one length: block wins, then
    the smaller name. A URL of any length is one row's text.
    """
    spark = pages.sparkSession
    rules = staged(compiled(rule_table(spark) if rules is None else rules), "rules")
    few = rules.count() <= MOST_SENT
    sent = F.broadcast if few else (lambda df: df)
    host, path = host_and_path(F.col("url"))
    sites = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url")).select("id", host.alias("host"), path.alias("path"))
    sites = staged(sites.withColumn("row", F.monotonically_increasing_id()), "sites")
    asked = sites.select("row", F.concat("host", "path").alias("site")).withColumn("token", F.explode(tokens_of(F.col("site"))))
    # in how many URLs each token of a rule appears
    filed = rules.select("*", F.explode("tokens").alias("token")).drop("tokens")
    counts = asked.join(sent(filed.select("token").distinct()), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")
    index = staged(filed.join(counts, "token", "left").groupBy("name", "pattern", "verdict", "rank").agg(rarest), "index")
    met = asked.join(sent(index), "token").withColumn("fits", F.regexp_like("site", F.col("pattern")))
    # longest first, then block, then the smaller name
    order = F.struct((-F.col("rank")).alias("r"), (F.col("verdict") != "block").alias("v"), F.col("name").alias("n"))
    best = F.min_by(F.struct("rank", "verdict", "name"), F.when(F.col("fits"), order)).alias("best")
    judged = met.groupBy("row").agg(best, F.count("*").alias("n_candidates"))
    return sites.join(judged, "row", "left").select(
        F.col("id").alias(id_col), "host", "path", F.when(F.col("best.rank") > 0, F.col("best.name")).alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.coalesce("n_candidates", F.lit(0)).cast("long").alias("n_candidates"))
