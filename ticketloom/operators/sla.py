"""Service levels: due times, escalations, compliance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.operators.worktime import WorkCalendar


def sla_rows(matrix: Sequence[tuple] = policy.SLA_MATRIX) -> list[tuple]:
    """The matrix with its wildcard and nearest rows written out for every pair."""
    rows = []
    for priority, urgency, response, resolution, after in matrix:
        near = [u for (p, u), use in policy.SLA_NEAREST.items() if p == priority and use == urgency]
        for name in policy.URGENCIES if urgency is None else [urgency, *near]:
            tiers = policy.TIER_ESCALATION.get(priority, (None, None, None))
            rows.append((priority, name, response, resolution, after, *tiers,
                         policy.MANAGEMENT_ESCALATION.get(priority)))
    return rows


def sla_table(spark: SparkSession, matrix: Sequence[tuple] = policy.SLA_MATRIX) -> DataFrame:
    """The written-out matrix as an inline table: its size is known, so joins broadcast it."""
    def literal(v: object) -> str:
        if v is None:
            return "CAST(NULL AS INT)"
        return f"'{v}'" if isinstance(v, str) else str(v)

    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in sla_rows(matrix))
    return spark.sql(
        f"SELECT * FROM VALUES {values} AS sla(priority, urgency, response_minutes, "
        "resolution_minutes, after_hours, tier1_minutes, tier2_minutes, tier3_minutes, management_minutes)"
    )


#: Tickets that wait for the next business day have their times in business days and hours, where there is a calendar.
IN_BUSINESS_TIME = "Next day"


def _plus(start: Column, minutes: Column) -> Column:
    return start + F.make_dt_interval(mins=minutes)


def _due(start: Column, minutes: Column, calendar: WorkCalendar | None) -> Column:
    """Minutes after start; whole days of a business time are business days."""
    if calendar is None:
        return _plus(start, minutes)
    working = F.when(minutes >= 1440, F.floor(minutes / 1440) * calendar.day_minutes + minutes % 1440).otherwise(minutes)
    business = calendar.add(start, working)
    return F.when(F.col("after_hours") == IN_BUSINESS_TIME, business).otherwise(_plus(start, minutes).cast("timestamp_ntz"))


def assign_sla(
    classified: DataFrame, sla: DataFrame, start: str = "submitted_date",
    priority: str = "priority", urgency: str = "urgency_level", calendar: WorkCalendar | None = None,
) -> DataFrame:
    """Add response_due, resolution_due, after_hours, the hand-over times of the three tiers and management's.

    Days have 24 hours; with a calendar, tickets that wait for the next business day are due in business time.
    """
    keyed = sla.withColumnsRenamed({"priority": "sla_priority", "urgency": "sla_urgency"})
    joined = classified.join(
        keyed,
        (F.col(priority) == F.col("sla_priority")) & (F.col(urgency) == F.col("sla_urgency")),
        "left",
    )
    begin = F.col(start)
    return joined.withColumns({
        "response_due": _due(begin, F.col("response_minutes"), calendar),
        "resolution_due": _due(begin, F.col("resolution_minutes"), calendar),
        "escalate_at": _due(begin, F.col("tier1_minutes"), calendar),
        "tier2_until": _due(begin, F.col("tier2_minutes"), calendar),
        "tier3_until": _due(begin, F.col("tier3_minutes"), calendar),
        "management_at": _due(begin, F.col("management_minutes"), calendar),
    }).drop("sla_priority", "sla_urgency")


def sla_compliance(history: DataFrame, sla: DataFrame, by: str = "priority", calendar: WorkCalendar | None = None) -> DataFrame:
    """Share resolved on target, against the level-one goal, and management escalations.

    ``history`` has priority, urgency, submitted_at and resolved_at; open tickets (no resolved_at) do not count.
    """
    due = assign_sla(history.filter(F.col("resolved_at").isNotNull()), sla, "submitted_at", "priority", "urgency", calendar)
    on_time = F.col("resolved_at") <= F.col("resolution_due")
    share = F.avg(on_time.cast("int"))
    return due.groupBy(by).agg(
        F.count("*").alias("tickets"),
        F.count_if(on_time).alias("on_time"),
        F.round(share, 4).alias("compliance"),
        (share >= policy.LEVEL1_TARGET).alias("meets_target"),
        F.count_if(F.col("resolved_at") > F.col("management_at")).alias("management_escalations"),
    )
