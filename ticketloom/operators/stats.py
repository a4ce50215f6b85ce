"""Reports, evaluation and table checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.operators.ranks import paged

PAGE_ROWS = 1000


def tickets_by_priority(
    df: DataFrame, priority: str = "expected_priority", key: str = "ticket_id", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Count and ordered ids per priority.

    A priority may hold any share of the tickets, so its ids come in pages of ``page_rows``
    in order; every id is listed once and no list grows with the table.
    """
    slim = df.select(F.col(priority).alias("priority"), F.col(key).alias("id"))
    pages = (
        paged(slim, ["priority"], [F.col("id")], page_rows)
        .groupBy("priority", "page")
        .agg(F.count("*").alias("page_tickets"), F.sort_array(F.collect_list("id")).alias("ticket_ids"))
    )
    whole = Window.partitionBy("priority")
    return pages.withColumn("tickets", F.sum("page_tickets").over(whole)).select("priority", "tickets", "page", "page_tickets", "ticket_ids")


def tickets_by_team(df: DataFrame, team: str = "expected_team") -> DataFrame:
    return (
        df.groupBy(F.col(team).alias("team")).agg(F.count("*").alias("tickets"))
        .orderBy(F.col("tickets").desc(), "team")
    )


def chunk_stats(kb: DataFrame) -> DataFrame:
    return (
        kb.groupBy("doc_type")
        .agg(
            F.count("*").alias("chunks"),
            F.floor(F.avg(F.length("content"))).cast("int").alias("avg_length"),
            F.min(F.length("content")).alias("min_length"),
            F.max(F.length("content")).alias("max_length"),
        )
        .orderBy("doc_type")
    )


def kb_inventory(kb: DataFrame) -> DataFrame:
    """Ordered distinct document types with their row counts and the total."""
    per_type = kb.groupBy("doc_type").agg(F.count("*").alias("chunks"))
    everything = Window.partitionBy()
    return per_type.withColumn("total_chunks", F.sum("chunks").over(everything)).orderBy("doc_type")


# --- evaluation -----------------------------------------------------------------------


def _outcomes(
    df: DataFrame, fields: Mapping[str, tuple[str, str]], alias: Mapping[str, str] | None = None
) -> DataFrame:
    """(field, expected, predicted, n): small, whatever the number of tickets."""
    def named(col: str) -> Column:
        if not alias:
            return F.col(col)
        out = None
        for old, new in alias.items():
            out = F.when(F.col(col) == old, new) if out is None else out.when(F.col(col) == old, new)
        return out.otherwise(F.col(col))

    triples = [
        F.struct(F.lit(f).alias("field"), named(exp).alias("expected"), named(got).alias("predicted"))
        for f, (exp, got) in fields.items()
    ]
    return (
        df.select(F.explode(F.array(*triples)).alias("t"))
        .groupBy("t.field", "t.expected", "t.predicted")
        .agg(F.count("*").alias("n"))
    )


def evaluate(
    df: DataFrame, fields: Mapping[str, tuple[str, str]], alias: Mapping[str, str] | None = None
) -> DataFrame:
    """Accuracy per field, and ``all`` for rows right in every field.

    ``fields`` maps a name to its (expected, predicted) columns; ``alias`` renames
    label values before they are compared.
    """
    def same(exp: str, got: str) -> Column:
        a, b = F.col(exp), F.col(got)
        for old, new in (alias or {}).items():
            a = F.when(a == old, new).otherwise(a)
            b = F.when(b == old, new).otherwise(b)
        return a.eqNullSafe(b)

    checks = {f: same(*cols) for f, cols in fields.items()}
    everything = F.lit(True)
    for check in checks.values():
        everything = everything & check
    checks["all"] = everything
    flags = [F.struct(F.lit(f).alias("field"), c.alias("ok")) for f, c in checks.items()]
    return (
        df.select(F.explode(F.array(*flags)).alias("c"))
        .groupBy(F.col("c.field").alias("field"))
        .agg(
            F.count("*").alias("tickets"),
            F.count_if(F.col("c.ok")).alias("correct"),
            F.round(F.avg(F.col("c.ok").cast("int")), 5).alias("accuracy"),
        )
    )


def class_scores(
    df: DataFrame, fields: Mapping[str, tuple[str, str]], alias: Mapping[str, str] | None = None
) -> DataFrame:
    """Precision, recall and F1 per class, from the pre-aggregated outcome counts."""
    sides = F.array(
        F.struct(F.col("expected").alias("label"), F.col("n").alias("expected"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("expected") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("expected"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("hit")),
    )
    sums = (
        _outcomes(df, fields, alias)
        .select("field", F.explode(sides).alias("s"))
        .filter(F.col("s.label").isNotNull())
        .groupBy("field", F.col("s.label").alias("label"))
        .agg(F.sum("s.expected").alias("expected"), F.sum("s.predicted").alias("predicted"),
             F.sum("s.hit").alias("correct"))
    )
    ratio = lambda top, bottom: F.round(F.when(bottom > 0, top / bottom).otherwise(0.0), 5)
    return sums.select(
        "field", "label", "expected", "predicted", "correct",
        ratio(F.col("correct"), F.col("predicted")).alias("precision"),
        ratio(F.col("correct"), F.col("expected")).alias("recall"),
        ratio(2 * F.col("correct"), F.col("expected") + F.col("predicted")).alias("f1"),
    )


def confusion_matrix(df: DataFrame, expected: str, predicted: str, values: Sequence[object]) -> DataFrame:
    """Counts by expected value, one column per predicted value of a fixed list."""
    counts = {
        f"pred_{v}".replace(" ", "_").replace("&", "and"): F.count_if(F.col(predicted) == v) for v in values
    }
    return df.groupBy(F.col(expected).alias("expected")).agg(
        F.count("*").alias("total"), *[c.alias(name) for name, c in counts.items()]
    )


def audit_sample(
    df: DataFrame, n: int, seed: str, at: str = "submitted_date", key: str = "ticket_id"
) -> DataFrame:
    """A repeatable random sample of n tickets per week.

    Ordering by a seeded md5 makes the sample independent of partitioning; the rank
    limit is applied inside partitions before the shuffle.
    """
    drawn = F.md5(F.concat(F.lit(seed), F.col(key)).cast("binary"))
    weekly = df.withColumn("week", F.to_date(F.date_trunc("week", at))).withColumn("draw", drawn)
    order = Window.partitionBy("week").orderBy("draw", key)
    return weekly.withColumn("draw_no", F.row_number().over(order)).filter(F.col("draw_no") <= n).drop("draw")


# --- resolution and runs -----------------------------------------------------------------


def exact_quantiles(
    counts: DataFrame, by: Sequence[str], value: str, n: str, quantiles: Mapping[str, float], width: float = 1.0
) -> DataFrame:
    """Exact interpolated quantiles per group of (group, value, count) rows.

    A group's values are ranked slice by slice of ``width``: slice totals give the ranks
    before each slice, so a hot group is ordered by many tasks, each in a sort that can
    spill, and no task holds a group.
    """
    sliced = counts.filter(F.col(value).isNotNull()).withColumn("slice", F.floor(F.col(value) / width))
    group = Window.partitionBy(*by)
    slices = (
        sliced.groupBy(*by, "slice").agg(F.sum(n).alias("slice_n"))
        .withColumn("group_n", F.sum("slice_n").over(group))
        .withColumn("before", F.sum("slice_n").over(group.orderBy("slice")) - F.col("slice_n"))
        .drop("slice_n")
    )
    inside = Window.partitionBy(*by, "slice").orderBy(value)
    # The end of a value's ranks; they are counted from zero.
    ranked = sliced.join(slices, [*by, "slice"]).withColumn("end", F.col("before") + F.sum(n).over(inside))
    holds = lambda rank: (F.col("end") - F.col(n) <= rank) & (rank < F.col("end"))
    ends = []
    for name, q in quantiles.items():
        at = F.lit(q) * (F.col("group_n") - 1)
        ends += [
            F.max(F.when(holds(F.floor(at)), F.col(value))).alias(f"{name}_low"),
            F.max(F.when(holds(F.ceil(at)), F.col(value))).alias(f"{name}_high"),
            F.max(at - F.floor(at)).alias(f"{name}_part"),
        ]
    found = ranked.groupBy(*by).agg(*ends)
    return found.select(*by, *[
        (F.col(f"{q}_low") + (F.col(f"{q}_high") - F.col(f"{q}_low")) * F.col(f"{q}_part")).alias(q) for q in quantiles
    ])


def resolution_metrics(
    history: DataFrame, at: str = "resolved_at", by: str = "team", hours: str = "resolution_time_hours"
) -> DataFrame:
    """Monthly count, mean, exact median and p90 of hours of resolved tickets, and change on the month before.

    The change is null where the team resolved nothing in the month before. Equal hours are counted first, so a busy (month, team) shuffles one row per
    distinct value and task.
    """
    counts = (
        history.filter(F.col(at).isNotNull()).select(
            F.to_date(F.date_trunc("month", at)).alias("month"), F.col(by).alias("team"), F.col(hours).alias("hours")
        )
        .groupBy("month", "team", "hours")
        .agg(F.count("*").alias("n"))
    )
    known = F.when(F.col("hours").isNotNull(), F.col("n"))
    means = counts.groupBy("month", "team").agg(
        F.sum("n").alias("resolved"), (F.sum(F.col("hours") * F.col("n")) / F.sum(known)).alias("mean_hours")
    )
    middles = exact_quantiles(counts, ["month", "team"], "hours", "n", {"median_hours": 0.5, "p90_hours": 0.9})
    monthly = means.join(middles, ["month", "team"], "left")
    months = Window.partitionBy("team").orderBy("month")
    adjacent = F.lag("month").over(months) == F.add_months("month", -1)
    before = F.when(adjacent, F.lag("mean_hours").over(months))
    return monthly.select(
        "month", "team", "resolved",
        F.round("mean_hours", 4).alias("mean_hours"),
        F.round("median_hours", 4).alias("median_hours"),
        F.round("p90_hours", 4).alias("p90_hours"),
        F.round(F.col("mean_hours") - before, 4).alias("change_hours"),
    )


def run_summary(results: DataFrame, tools: str = "tools", cost: str = "cost", ok: str = "category") -> DataFrame:
    """Tickets processed and failed, tools used of those available, total and mean cost."""
    return results.agg(
        F.count("*").alias("tickets"),
        F.count(ok).alias("processed"),
        F.count_if(F.col(ok).isNull()).alias("failed"),
        F.sum(F.size(tools)).alias("tools_used"),
        (F.count("*") * len(policy.TOOLS)).alias("tools_available"),
        F.sum(cost).alias("total_cost"),
        F.round(F.avg(F.col(cost).cast("double")), 6).alias("avg_cost"),
    )


def check_ticket_table(
    df: DataFrame, key: str = "ticket_id",
    required: Sequence[str] = ("ticket_id", "subject", "description", "ticket_text"),
    domains: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per check with its number of violations; zero everywhere is a sound table.

    Nulls and domains take one pass; key uniqueness groups by key with partial counts.
    """
    if domains is None:
        domains = {
            "expected_category": policy.CATEGORIES,
            "expected_priority": policy.PRIORITIES,
            "expected_team": policy.TEAMS,
        }
    flags = {f"not_null:{c}": F.col(c).isNull() for c in required}
    flags |= {f"domain:{c}": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in domains.items()}
    one_row = df.agg(*[F.count_if(cond).alias(name) for name, cond in flags.items()])
    checks = one_row.select(
        F.explode(F.array(*[
            F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in flags
        ])).alias("c")
    ).select("c.check", "c.violations")
    duplicates = (
        df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
        .agg(F.count("*").alias("violations"))
        .select(F.lit(f"unique:{key}").alias("check"), "violations")
    )
    return checks.unionByName(duplicates)
