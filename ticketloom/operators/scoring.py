"""Ticket scoring operators: thin DataFrame forms of the policy expression."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom import policy
from ticketloom.functions import scoring as S
from ticketloom.functions import text as X


def _name(col: str | None) -> str:
    return S.NO_SENDER if col is None else f"`{col}`"


def score_tickets(
    df: DataFrame, text: str = "ticket_text", sender: str | None = None,
    rules: Sequence[policy.Rule] = policy.RULES,
    team_keywords: Mapping[str, Sequence[str]] = policy.TEAM_KEYWORDS,
    extract: bool = True, out: str = "scored", fields: Sequence[str] | None = None, words: str | None = None,
) -> DataFrame:
    """Add one struct column with all policy results, or with some fields of them.

    ``words`` names one more column, for the search words of the text, which scoring has to find in any case.
    """
    if words is None:
        return df.withColumn(out, F.expr(S.score_sql(_name(text), _name(sender), rules, team_keywords, extract, fields)))
    if fields is None:
        raise ValueError("words are given with chosen fields only")
    scored = df.withColumn(out, F.expr(S.score_sql(_name(text), _name(sender), rules, team_keywords, extract, [*fields, "words"])))
    return scored.withColumns({words: F.col(out)["words"], out: F.struct(*[F.col(out)[f].alias(f) for f in fields])})


def match_rules(
    df: DataFrame, text: str = "ticket_text", sender: str | None = None,
    rules: Sequence[policy.Rule] = policy.RULES,
) -> DataFrame:
    """Fired rules and their combined effects."""
    scored = score_tickets(df, text, sender, rules, extract=False)
    return scored.withColumns({
        "fired_rules": F.col("scored.fired"),
        "set_priority": F.col("scored.set_priority"),
        "min_priority": F.col("scored.min_priority"),
        "rule_urgency": F.col("scored.rule_urgency"),
        "rule_category": F.col("scored.rule_category"),
        "rule_team": F.col("scored.rule_team"),
        "notify": F.col("scored.notify"),
        "actions": F.col("scored.action"),
    }).drop("scored")


def score_teams(
    df: DataFrame, text: str = "ticket_text",
    team_keywords: Mapping[str, Sequence[str]] = policy.TEAM_KEYWORDS,
) -> DataFrame:
    """Keyword hits per team and the best team (null if nothing matched)."""
    scored = score_tickets(df, text, None, policy.RULES, team_keywords, extract=False)
    return scored.withColumns({
        "team_scores": F.col("scored.scores"),
        "best_team": F.col("scored.best_team"),
    }).drop("scored")


def classify_tickets(
    df: DataFrame, text: str = "ticket_text", sender: str | None = None,
    rules: Sequence[policy.Rule] = policy.RULES, out: str = "classification",
) -> DataFrame:
    return df.withColumn(out, F.expr(S.classification_sql(_name(text), _name(sender), rules)))


def priority_from_score(score: Column) -> Column:
    out = None
    for priority, floor in policy.SCORE_BANDS:
        hit = score >= floor
        out = F.when(hit, priority) if out is None else out.when(hit, priority)
    return F.when(score.isNotNull(), out.otherwise("P4"))


def score_from_priority(priority: Column) -> Column:
    out = None
    for name, score in policy.PRIORITY_SCORE.items():
        hit = priority == name
        out = F.when(hit, score) if out is None else out.when(hit, score)
    return out


def extract_entities(df: DataFrame, text: str = "ticket_text") -> DataFrame:
    found = df.withColumn("entities", F.expr(S.entities_sql(_name(text))))
    return found.withColumns({
        "affected_systems": F.col("entities.affected_systems"),
        "technical_keywords": F.col("entities.technical_keywords"),
    }).drop("entities")


def user_impact(df: DataFrame, text: str = "ticket_text") -> DataFrame:
    return df.withColumn("user_impact", F.expr(S.user_impact_sql(_name(text))))


def urgency_and_escalation(
    df: DataFrame, priority: str = "priority", impact: str = "user_impact", vip: str | None = None,
) -> DataFrame:
    """Urgency from priority, one level up for VIP senders; and the escalation flag."""
    by_priority = " ".join(f"WHEN '{p}' THEN '{u}'" for p, u in policy.URGENCY_BY_PRIORITY.items())
    base = f"CASE `{priority}` {by_priority} END"
    raised = "false" if vip is None else f"coalesce(`{vip}`, false)"
    return df.withColumns({
        "urgency_level": F.expr(S.urgency_sql(base, raised)),
        "requires_escalation": F.col(priority).isin("P1", "P2")
        | (F.coalesce(F.col(impact), F.lit("Single User")) != "Single User"),
    })


def extract_metadata(
    df: DataFrame, text: str = "ticket_text", sender: str | None = None, out: str = "metadata",
) -> DataFrame:
    return df.withColumn(out, F.expr(S.metadata_sql(_name(text), _name(sender))))


def quick_classify(
    df: DataFrame, text: str = "ticket_text", sender: str | None = None, out: str = "quick",
) -> DataFrame:
    return df.withColumn(out, F.expr(S.quick_sql(_name(text), _name(sender))))


def generate_summary(
    df: DataFrame, text: str = "ticket_text", context: str = "context",
    scored: str | None = None, sender: str | None = None, out: str = "generated",
) -> DataFrame:
    """Extractive summary, steps and time from the ticket and a context column.

    ``scored`` names a column of ``score_tickets`` made before the context was joined.
    """
    policy_of = S.score_sql(_name(text), _name(sender), fields=S.GENERATE_FIELDS) if scored is None else f"`{scored}`"
    return df.withColumn(out, F.expr(S.generate_sql(_name(text), f"coalesce(`{context}`, '')", policy_of)))


def batch_classify(df: DataFrame, text: str = "ticket_text", sender: str | None = None) -> DataFrame:
    """Quick classification of every non-blank ticket as the five result columns."""
    scored = df.filter(~X.is_blank(F.col(text)))
    scored = score_tickets(scored, text, sender, extract=False)
    return scored.select(
        X.preview(F.col(text), 100, "always").alias("ticket_text"),
        F.col("scored.category").alias("category"),
        F.col("scored.priority").alias("priority"),
        F.col("scored.assigned_team").alias("team"),
        F.col("scored.urgency_level").alias("urgency"),
    )


def build_prompt(
    df: DataFrame, template: str, out: str = "prompt", **columns: str
) -> DataFrame:
    """Fill ``{name}`` slots of a template with columns, e.g. ``ticket="ticket_text"``."""
    parts: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{%s}" % n), n) for n in columns if "{%s}" % n in rest]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(F.coalesce(F.col(columns[name]).cast("string"), F.lit("")))
        rest = rest[at + len(name) + 2:]
    return df.withColumn(out, F.concat(*parts) if parts else F.lit(""))


PROMPT_TEMPLATE = (
    "Summarise this support ticket and advise on it.\n\n"
    "TICKET:\n{ticket}\n\n"
    "KNOWLEDGE BASE CONTEXT:\n{context}\n\n"
    "Answer in JSON with summary, recommendations, resolution_steps and "
    "estimated_resolution_time."
)


# --- user models -------------------------------------------------------------------


def parse_model_response(
    df: DataFrame, col: str, fields: Mapping[str, str], defaults: Mapping[str, object],
    failure: Mapping[str, object] | None = None, out: str = "parsed",
) -> DataFrame:
    """JSON text to typed fields.

    A missing or unreadable field takes its default; text that is not a JSON object
    takes the whole ``failure`` record and is kept in ``raw_response``. Scalars are
    read as strings first, so one wrongly typed field does not void the others.
    """
    failure = dict(defaults) if failure is None else dict(failure)
    read = ", ".join(
        f"`{n}` {t if t.upper().startswith('ARRAY') else 'STRING'}" for n, t in fields.items()
    )
    text = X.strip(F.col(col))
    is_object = F.coalesce(text.startswith("{") & F.get_json_object(text, "$").isNotNull(), F.lit(False))
    parsed = F.from_json(text, read)

    def typed(record: Mapping[str, object], name: str, kind: str) -> Column:
        value = record.get(name)
        if isinstance(value, (list, tuple)):
            return X.string_array(list(value)).cast(kind)
        return F.lit(value).cast(kind)

    def field(r: Column, name: str, kind: str) -> Column:
        got = r[name] if kind.upper().startswith("ARRAY") else r[name].try_cast(kind)
        good = F.coalesce(got, typed(defaults, name, kind))
        return F.when(is_object, good).otherwise(typed(failure, name, kind)).alias(name)

    record = X.let(parsed, lambda r: F.struct(*[field(r, n, k) for n, k in fields.items()]))
    return df.withColumns({
        out: record,
        "raw_response": F.when(~is_object, F.col(col)),
    })


def apply_model(
    df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], list[dict]]], schema: str,
    defaults: Mapping[str, object], batch_size: int = 64, partitions: int | None = None,
) -> DataFrame:
    """Run a user's own model over all rows as one distributed job.

    ``load`` builds the model once per task and returns a function from a batch to a
    list of dicts. A batch that fails is cut in four until the rows that fail stand alone,
    so that the others are still run together; a row that fails gets the defaults and its
    message in ``error``.
    """
    result = T.StructType(list(T._parse_datatype_string(schema)))
    names = result.fieldNames()
    source = df if partitions is None else df.repartition(partitions)
    full = T.StructType([*source.schema.fields, *result.fields, T.StructField("error", T.StringType())])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()

        def attempt(rows: pd.DataFrame) -> list[dict]:
            try:
                answers = list(model(rows))
                if len(answers) != len(rows):
                    raise ValueError(f"model gave {len(answers)} results for {len(rows)} rows")
                return [{**defaults, **a, "error": None} for a in answers]
            except Exception as failure:
                if len(rows) == 1:
                    return [{**defaults, "error": f"{type(failure).__name__}: {failure}"}]
                step = -(-len(rows) // 4)
                return [a for i in range(0, len(rows), step) for a in attempt(rows.iloc[i:i + step])]

        for pdf in batches:
            answers = [a for at in range(0, len(pdf), batch_size) for a in attempt(pdf.iloc[at:at + batch_size])]
            extra = {n: pd.Series([a.get(n) for a in answers], index=pdf.index, dtype=object) for n in [*names, "error"]}
            yield pdf.assign(**extra)

    return source.mapInPandas(score, full)
