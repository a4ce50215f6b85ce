"""Tool routing, costs, recommendations and the nested analysis record."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.functions import text as X

# The action texts shown for each priority.
P1_ACTIONS = ("Escalate immediately to on-call team", "Initiate incident response protocol")
P2_ACTIONS = ("Assign to next available team member", "Monitor for similar issues")
OTHER_ACTIONS = ("Add to team queue", "Schedule within SLA timeframe")
HISTORY_ACTION = "Check historical resolution patterns"

# Stages or tools every approach uses; the adaptive one takes its own list.
FIXED_APPROACHES = {
    "Quick Classify": ("classify_ticket",),
    "Six-Phase": policy.TOOLS,
    "Sequential Agents": policy.TOOLS,
}
ADAPTIVE = "Adaptive Agent"
MONEY = "decimal(18,4)"


def recommend_actions(priority: Column, team: Column, articles: Column, has_history: Column) -> Column:
    by_priority = (
        F.when(priority == "P1", X.string_array(P1_ACTIONS))
        .when(priority == "P2", X.string_array(P2_ACTIONS))
        .otherwise(X.string_array(OTHER_ACTIONS))
    )
    extra = F.array(
        F.when(articles > 0, F.format_string("Review %d relevant documentation articles", articles)),
        F.when(has_history, F.lit(HISTORY_ACTION)),
        F.concat(F.lit("Route to "), F.coalesce(team, F.lit("")), F.lit(" team")),
    )
    return F.concat(by_priority, F.array_compact(extra))


def route_tools(priority: Column, strategy: str = "prompt") -> Column:
    """Tools of the adaptive strategy.

    ``prompt``: three tools always, history for P1 and P2. ``observed``: simple
    tickets (P3, P4) use the first two only.
    """
    complex_ticket = F.coalesce(priority.isin("P1", "P2"), F.lit(False))
    if strategy == "prompt":
        short = policy.TOOLS[:3]
    elif strategy == "observed":
        short = policy.TOOLS[:2]
    else:
        raise ValueError(f"strategy must be prompt or observed, not {strategy!r}")
    return F.when(complex_ticket, X.string_array(policy.TOOLS)).otherwise(X.string_array(short))


def money(value: Decimal) -> Column:
    return F.lit(str(value)).cast(MONEY)


def estimate_cost(
    stages: Column, prices: Mapping[str, Decimal] = policy.STAGE_PRICES, unlisted: Decimal = Decimal(0)
) -> Column:
    """Decimal sum of stage prices of an array column, within the row."""
    total = money(Decimal(0))
    for stage, price in prices.items():
        used = F.size(stages) - F.size(F.array_remove(stages, stage))
        total = total + used.cast("decimal(9,0)") * money(price)
    if unlisted:
        other = F.size(F.filter(stages, lambda s: ~s.isin(list(prices))))
        total = total + other.cast("decimal(9,0)") * money(unlisted)
    return total.cast(MONEY)


def tool_cost(tools: Column, price: Decimal = policy.TOOL_PRICE) -> Column:
    return (F.size(tools).cast("decimal(9,0)") * money(price)).cast(MONEY)


def compare_approaches(classified: DataFrame, price: Decimal = policy.TOOL_PRICE) -> DataFrame:
    """Tickets, tools used and cost of each approach over all tickets, in one pass."""
    options = [
        F.struct(F.lit(name).alias("approach"), F.lit(len(tools)).alias("tools"))
        for name, tools in FIXED_APPROACHES.items()
    ]
    options.append(F.struct(F.lit(ADAPTIVE).alias("approach"), F.size(route_tools(F.col("priority"))).alias("tools")))
    return (
        classified.select(F.explode(F.array(*options)).alias("a"))
        .groupBy(F.col("a.approach").alias("approach"))
        .agg(
            F.count("*").alias("tickets"),
            F.sum("a.tools").alias("tools_used"),
            F.round(F.avg("a.tools"), 4).alias("avg_tools"),
            (F.sum("a.tools").cast("decimal(18,0)") * money(price)).cast("decimal(28,4)").alias("total_cost"),
        )
    )


CLASSIFICATION = ("category", "priority", "assigned_team", "confidence")
METADATA = ("priority_score", "urgency_level", "affected_systems", "technical_keywords", "user_impact", "requires_escalation")


def analyze_tickets(
    scored: DataFrame, articles: str | None = None, history: str | None = None,
    key: str = "ticket_id", text: str = "ticket_text",
) -> DataFrame:
    """Nested analysis record per ticket.

    ``scored`` has key, text, the ``scored`` struct with these fields and, where those stages ran, a
    column of ranked articles and one of recent history. No join happens here.
    """
    no_articles = F.lit(None).cast("array<struct<doc_id:string,title:string>>")
    no_history = F.lit(None).cast("array<struct<ticket_id:string,resolution:string>>")
    found_articles = no_articles if articles is None else F.col(articles)
    found_history = no_history if history is None else F.col(history)
    found = F.coalesce(F.size(found_articles), F.lit(0))
    has_history = F.coalesce(F.size(found_history) > 0, F.lit(False))
    s = F.col("scored")
    return scored.select(
        key,
        F.substring(text, 1, 200).alias("ticket"),
        F.struct(*[s[c].alias(c) for c in CLASSIFICATION]).alias("classification"),
        F.struct(*[s[c].alias(c) for c in METADATA]).alias("metadata"),
        found.alias("knowledge_articles"),
        found_articles.alias("articles"),
        found_history.alias("history"),
        recommend_actions(s["priority"], s["assigned_team"], found, has_history).alias("recommendations"),
    )
