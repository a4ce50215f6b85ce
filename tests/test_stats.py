"""Reports, evaluation and checks."""

import random

import numpy as np
from pyspark.sql import functions as F

from ticketloom.operators import stats


def judged(spark):
    rows = [("Security", "Security", "P1", "P1"), ("Applications", "Software", "P2", "P3"), ("Software", "Security", "P3", "P3")]
    return spark.createDataFrame(rows, "ec string, c string, ep string, p string")


FIELDS = {"category": ("ec", "c"), "priority": ("ep", "p")}


def test_accuracy_raw_and_aliased(spark):
    raw = {r["field"]: r["correct"] for r in stats.evaluate(judged(spark), FIELDS).collect()}
    named = {r["field"]: r["correct"] for r in stats.evaluate(judged(spark), FIELDS, {"Applications": "Software"}).collect()}
    assert raw == {"category": 1, "priority": 2, "all": 1} and named == {"category": 2, "priority": 2, "all": 1}


def test_class_scores(spark):
    got = {(r["field"], r["label"]): (r["precision"], r["recall"], r["f1"]) for r in stats.class_scores(judged(spark), FIELDS).collect()}
    assert got["category", "Security"] == (0.5, 1.0, 0.66667) and got["category", "Applications"] == (0.0, 0.0, 0.0)


def test_confusion_columns(spark):
    rows = stats.confusion_matrix(judged(spark), "ep", "p", ["P1", "P3"]).orderBy("expected").collect()
    assert [tuple(r) for r in rows] == [("P1", 1, 1, 0), ("P2", 1, 0, 1), ("P3", 1, 0, 1)]


def test_priority_pages_hold_every_id_once(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        F.when(F.col("id") < 4900, "P3").otherwise("P1").alias("expected_priority"))
    rows = stats.tickets_by_priority(df, page_rows=100).collect()
    ids = [i for r in rows for i in r["ticket_ids"]]
    assert sorted(ids) == sorted(f"T{i}" for i in range(5000))
    assert {(r["priority"], r["tickets"]) for r in rows} == {("P3", 4900), ("P1", 100)}
    assert max(len(r["ticket_ids"]) for r in rows) < 300


def test_audit_sample_ignores_partitioning(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("ticket_id"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id)").alias("submitted_date"))
    one = sorted(map(tuple, stats.audit_sample(df.repartition(3), 5, "s").collect()))
    two = sorted(map(tuple, stats.audit_sample(df.repartition(7), 5, "s").collect()))
    other = sorted(map(tuple, stats.audit_sample(df, 5, "t").collect()))
    assert one == two != other and len(one) == 5 * len({r[2] for r in one})


def test_resolution_percentiles_are_exact(spark):
    rows = [("2024-01-05", "A", float(h)) for h in (1, 2, 3, 10)] + [("2024-02-05", "A", 6.0)]
    df = spark.createDataFrame(rows, "d string, team string, resolution_time_hours double").withColumn("resolved_at", F.to_timestamp("d"))
    out = stats.resolution_metrics(df).orderBy("month").collect()
    assert (out[0]["mean_hours"], out[0]["median_hours"], out[0]["change_hours"]) == (4.0, 2.5, None)
    assert out[1]["change_hours"] == 2.0


def test_quantiles_match_a_sort(spark):
    rng = random.Random(4)
    rows = [(g, round(rng.expovariate(0.1), rng.choice([0, 1, 5]))) for g in ("a", "b", "c") for _ in range(rng.randint(1, 400))]
    rows += [("hot", 3.25)] * 500 + [("one", 7.0), ("none", None)]
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    wanted = {"q10": 0.1, "q50": 0.5, "q99": 0.99}
    got = {r["g"]: [r[q] for q in wanted] for r in stats.exact_quantiles(counts, ["g"], "v", "n", wanted).collect()}
    values = {}
    for g, v in rows:
        if v is not None:
            values.setdefault(g, []).append(v)
    assert set(got) == set(values)
    for g, vs in values.items():
        np.testing.assert_allclose(got[g], np.quantile(vs, list(wanted.values())), rtol=1e-12)


def test_table_checks_find_violations(spark):
    rows = [("T1", "s", "d", "x", "Software", "P1", "Cloud"), ("T1", None, "d", "x", "Apps", "P9", None)]
    df = spark.createDataFrame(rows, "ticket_id string, subject string, description string, ticket_text string, "
                               "expected_category string, expected_priority string, expected_team string")
    found = {r["check"]: r["violations"] for r in stats.check_ticket_table(df).collect()}
    assert found == {"not_null:ticket_id": 0, "not_null:subject": 1, "not_null:description": 0, "not_null:ticket_text": 0,
                     "domain:expected_category": 1, "domain:expected_priority": 1, "domain:expected_team": 0, "unique:ticket_id": 1}


def test_counts(spark):
    kb = spark.createDataFrame([("Guide", "abc"), ("Guide", "abcd"), ("Policy", "a")], "doc_type string, content string")
    assert [tuple(r) for r in stats.chunk_stats(kb).collect()] == [("Guide", 2, 3, 3, 4), ("Policy", 1, 1, 1, 1)]
    assert [tuple(r) for r in stats.kb_inventory(kb).collect()] == [("Guide", 2, 3), ("Policy", 1, 3)]


def test_pages_do_not_depend_on_partitions(spark):
    rng = random.Random(8)
    rows = [(f"T{rng.randint(0, 10**6):07d}-{k}", rng.choice(["P1", "P3", "P3", "P3", None])) for k in range(1500)]
    df = spark.createDataFrame(rows, "ticket_id string, expected_priority string")
    want = {}
    for p in {p for _, p in rows}:
        ids = sorted(i for i, q in rows if q == p)
        want |= {(p, k // 70): (len(ids), ids[k : k + 70]) for k in range(0, len(ids), 70)}
    for parts in (1, 7):
        got = {(r["priority"], r["page"]): (r["tickets"], r["ticket_ids"]) for r in stats.tickets_by_priority(df.repartition(parts), page_rows=70).collect()}
        assert got == want


def test_change_is_on_the_adjacent_month_only(spark):
    rows = [("2024-01-05 00:00:00", "A", 10.0), ("2024-02-05 00:00:00", "A", 14.0), ("2024-04-05 00:00:00", "A", 20.0), ("2024-05-31 00:00:00", "A", 21.0), ("2023-12-05 00:00:00", "B", 1.0),
            ("2024-01-05 00:00:00", "B", 3.0)]
    df = spark.createDataFrame(rows, "at string, team string, resolution_time_hours double").withColumn("resolved_at", F.to_timestamp("at"))
    got = {(str(r["month"]), r["team"]): r["change_hours"] for r in stats.resolution_metrics(df).collect()}
    assert got == {("2024-01-01", "A"): None, ("2024-02-01", "A"): 4.0, ("2024-04-01", "A"): None, ("2024-05-01", "A"): 1.0, ("2023-12-01", "B"): None, ("2024-01-01", "B"): 2.0}
