"""Policy goldens, model plumbing, routing and service levels."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.functions import sqlfuncs
from ticketloom.functions import text as X
from ticketloom.operators import routing, scoring, sla, tickets

# text, sender, fired rules, category, priority, team, urgency
RULE_CASES = [
    ("There was a breach", None, [1], "Security", "P2", "Security", "High"),
    ("production down since noon on the server", None, [2], "Infrastructure", "P1", "Infrastructure", "Critical"),
    ("Nobody can print", None, [3], "Software", "P2", "Applications", "High"),
    ("Please look at the CRM", "ceo@example.com", [4], "Software", "P3", "Applications", "High"),
    ("urgent question", None, [5], "Software", "P4", "Applications", "Low"),
    ("I am locked out", None, [6], "Service Request", "P3", "End User Support", "Medium"),
    ("multiple users are locked out", None, [], "Software", "P3", "Applications", "Medium"),
    ("A new hire needs access", None, [7], "Service Request", "P3", "Identity & Access Management", "Medium"),
    ("termination next week", None, [8], "Service Request", "P2", "Identity & Access Management", "High"),
    ("termination today", None, [8], "Service Request", "P1", "Identity & Access Management", "Critical"),
    ("my keyboard and mouse broke", None, [], "Hardware", "P3", "End User Support", "Medium"),
    ("query timeout and a deadlock", None, [], "Infrastructure", "P3", "Database", "Medium"),
    ("Kubernetes in AWS", None, [], "Infrastructure", "P3", "Cloud", "Medium"),
    ("hello", None, [], "Software", "P3", "Applications", "Medium"),
]


def test_rule_goldens(spark):
    rows = [(i, c[0], c[1]) for i, c in enumerate(RULE_CASES)]
    df = spark.createDataFrame(rows, "i int, ticket_text string, sender string")
    got = scoring.score_tickets(df, sender="sender").select("i", "scored.*").collect()
    for r in got:
        _, _, fired, category, priority, team, urgency = RULE_CASES[r["i"]]
        assert (list(r["fired"]), r["category"], r["priority"], r["assigned_team"], r["urgency_level"]) == (
            fired, category, priority, team, urgency), RULE_CASES[r["i"]]


def test_extended_rules_reach_more(spark):
    df = spark.createDataFrame([("The shop is completely down",)], "ticket_text string")
    literal = scoring.classify_tickets(df).first()["classification"]["priority"]
    extended = scoring.classify_tickets(df, rules=policy.EXTENDED_RULES).first()["classification"]["priority"]
    assert (literal, extended) == ("P3", "P1")


def test_null_ticket_takes_the_defaults(spark):
    df = spark.createDataFrame([(None,)], "ticket_text string")
    c = scoring.classify_tickets(df).first()["classification"]
    assert tuple(c) == ("Software", "P3", "Applications", 0.0)
    m = scoring.extract_metadata(df).first()["metadata"]
    assert m["affected_systems"] == [] and m["user_impact"] == "Single User" and m["requires_escalation"] is False


def test_entities_and_impact(spark):
    text = "PROD-DB-01 and VPN show ERR_TIMEOUT_7 and HTTP 503, 30 people wait. PROD-DB-01 again."
    df = spark.createDataFrame([(text,)], "ticket_text string")
    r = scoring.user_impact(scoring.extract_entities(df)).first()
    assert r["affected_systems"] == ["PROD-DB-01", "vpn"]
    assert r["technical_keywords"] == ["ERR_TIMEOUT_7", "HTTP 503", "PROD-DB-01", "vpn"]
    assert r["user_impact"] == "Multiple Users"


def test_every_head_count_matters(spark):
    cases = {"1 users called, 40 people affected": "Multiple Users", "1 users 007 people wait": "Multiple Users", "01 people": "Single User",
             "0 users and 1 people": "Single User", "12 apples": "Single User", "123456789012345678901 users": "Multiple Users"}
    df = spark.createDataFrame([(t,) for t in cases], "ticket_text string")
    assert {r["ticket_text"]: r["user_impact"] for r in scoring.user_impact(df).collect()} == cases


def test_score_bands(spark):
    df = spark.createDataFrame([(0.9,), (0.89,), (0.7,), (0.4,), (0.39,), (None,)], "s double")
    assert [r[0] for r in df.select(scoring.priority_from_score(F.col("s"))).collect()] == ["P1", "P2", "P2", "P3", "P4", None]


def test_generation_is_grounded_in_the_context(spark):
    context = "Busy server\n- Look at top\n- Stop the job\n- Average resolution time: 45 minutes"
    df = spark.createDataFrame(
        [("Subject: CPU\n\nDescription: The server is slow. It began today.", context), ("CPU high", None)],
        "ticket_text string, context string")
    full, bare = [r["generated"] for r in scoring.generate_summary(df).collect()]
    assert full["summary"] == "The server is slow."
    assert full["resolution_steps"] == ["Look at top", "Stop the job"]
    assert full["recommendations"][:2] == ["Look at top", "Stop the job"] and len(full["recommendations"]) == 3
    assert full["estimated_resolution_time"] == "1 hour"
    assert bare["summary"] == "CPU high" and bare["resolution_steps"] == [] and len(bare["recommendations"]) == 3


JSON_CASES = [
    ('{"category": "Security", "priority": "P1", "confidence": 0.9}', ("Security", "P1", 0.9), None),
    ('{"category": "Security"}', ("Security", "P3", 0.5), None),
    ('{"category": "Security", "priority": "P1", "confidence": "0.7"}', ("Security", "P1", 0.7), None),
    ('{"category": "Security", "confidence": "high"}', ("Security", "P3", 0.5), None),
    ("I cannot say", ("Software", "P3", 0.0), "I cannot say"),
    ("", ("Software", "P3", 0.0), ""),
    (None, ("Software", "P3", 0.0), None),
]


def test_model_responses(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(JSON_CASES)], "i int, response string")
    defaults = {"category": "Software", "priority": "P3", "confidence": 0.5}
    out = scoring.parse_model_response(
        df, "response", {"category": "string", "priority": "string", "confidence": "double"},
        defaults, {**defaults, "confidence": 0.0})
    for r in out.collect():
        assert (tuple(r["parsed"]), r["raw_response"]) == JSON_CASES[r["i"]][1:]


def test_model_failures_stay_in_their_rows(spark):
    def load():
        def run(rows):
            if (rows["ticket_text"] == "bad").any():
                raise ValueError("no")
            return [{"label": t.upper()} for t in rows["ticket_text"]]
        return run

    df = spark.createDataFrame([("a",), ("bad",), ("b",)], "ticket_text string").coalesce(1)
    out = scoring.apply_model(df, load, "label STRING", {"label": "none"}, batch_size=2).collect()
    assert [(r["ticket_text"], r["label"], r["error"]) for r in out] == [
        ("a", "A", None), ("bad", "none", "ValueError: no"), ("b", "B", None)]


def test_rows_beside_a_failing_one_are_run_together(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def load():
        def run(rows):
            with open(calls, "a") as f:
                f.write(f"{len(rows)}\n")
            if (rows["k"] % 40 == 39).any():
                raise ValueError("no")
            return [{"label": f"L{k}"} for k in rows["k"]]
        return run

    df = spark.range(70).select(F.col("id").alias("k")).coalesce(1)
    out = scoring.apply_model(df, load, "label STRING", {"label": "none"}).collect()
    assert [(r["k"], r["label"], r["error"]) for r in out] == [
        (k, "none", "ValueError: no") if k == 39 else (k, f"L{k}", None) for k in range(70)]
    with open(calls) as f:
        assert [int(n) for n in f] == [64, 16, 16, 16, 4, 4, 1, 1, 1, 1, 4, 4, 16, 6]


def test_prompt_slots(spark):
    df = spark.createDataFrame([("T", None)], "t string, c string")
    assert scoring.build_prompt(df, "x {a} y {b} {a}", a="t", b="c").first()["prompt"] == "x T y  T"


def test_batch_drops_blank_tickets(spark):
    df = spark.createDataFrame([("  ",), (None,), ("locked out",)], "ticket_text string")
    rows = scoring.batch_classify(df).collect()
    assert [tuple(r) for r in rows] == [("locked out...", "Service Request", "P3", "End User Support", "Medium")]


def test_sql_functions_over_a_table(spark):
    assert sqlfuncs.register_functions(spark) == ["ai_classify", "ai_extract", "ai_gen", "quick_classify_ticket"]
    spark.createDataFrame([("termination today",), ("hello",)], "ticket_text string").createOrReplaceTempView("sql_tickets")
    rows = spark.sql("SELECT quick_classify_ticket(ticket_text).priority AS p, ai_classify(ticket_text) AS c FROM sql_tickets").collect()
    assert [r["p"] for r in rows] == ["P1", "P3"] and rows[1]["c"]["confidence"] == 0.0


def test_scoring_needs_no_shuffle_or_python(spark):
    df = spark.createDataFrame([("x",)], "ticket_text string")
    plan = scoring.quick_classify(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_routing_costs_and_actions(spark):
    df = spark.createDataFrame([("P1",), ("P2",), ("P3",), (None,)], "priority string")
    tools = [r[0] for r in df.select(F.size(routing.route_tools(F.col("priority")))).collect()]
    few = [r[0] for r in df.select(F.size(routing.route_tools(F.col("priority"), "observed"))).collect()]
    assert (tools, few) == ([4, 4, 3, 3], [4, 4, 2, 2])
    with pytest.raises(ValueError):
        routing.route_tools(F.col("priority"), "other")
    stages = X.string_array(tuple(policy.STAGE_PRICES))
    assert df.select(routing.estimate_cost(stages)).first()[0] == Decimal("0.0013")
    acts = df.select(routing.recommend_actions(F.col("priority"), F.lit("Cloud"), F.lit(2), F.lit(True)).alias("a")).collect()
    assert acts[0]["a"] == [*routing.P1_ACTIONS, "Review 2 relevant documentation articles", routing.HISTORY_ACTION, "Route to Cloud team"]
    assert acts[2]["a"][:2] == list(routing.OTHER_ACTIONS)


def test_sla_matrix(spark):
    table = {(r["priority"], r["urgency"]): r for r in sla.sla_table(spark).collect()}
    assert len(table) == len(policy.PRIORITIES) * len(policy.URGENCIES)
    assert table["P1", "Low"]["resolution_minutes"] == table["P1", "High"]["resolution_minutes"] == 360
    assert table["P4", "Critical"]["response_minutes"] == 1440
    df = spark.createDataFrame([("P2", "Medium", dt.datetime(2024, 1, 1, 9))], "priority string, urgency_level string, submitted_date timestamp_ntz")
    r = sla.assign_sla(df, sla.sla_table(spark)).first()
    assert r["response_due"] == dt.datetime(2024, 1, 1, 10) and r["resolution_due"] == dt.datetime(2024, 1, 1, 21)
    assert r["escalate_at"] == dt.datetime(2024, 1, 1, 11) and r["management_at"] == dt.datetime(2024, 1, 1, 21)


def test_display_values(spark):
    df = spark.createDataFrame([("1.5", None), ("", "x"), ("abc", "y"), (None, "z")], "n string, t string")
    out = tickets.display_values(df, {"t": "Unknown"}, ["n"]).collect()
    assert [tuple(r) for r in out] == [("1.50", "Unknown"), ("0.00", "x"), ("abc", "y"), ("0.00", "z")]


def test_chosen_fields_and_words_are_those_of_the_whole_score(spark):
    texts = [
        None, "", " \n", "!!!", "Das Büro: Ärger mit VPN", "nice to", "It would be NICE, to have", "report not loading", "the report not",
        "cannot login cannot login; load balancer load", "database server database", "new new hire", "12 people cannot print",
        "HTTP 503 0xFF ERR_A1 HTTP 5 EHTTP 404 on NODE-A-7", "Teams not working, multiple users: forgot password",
    ]
    df = spark.createDataFrame([(i, t, "ceo@example.com" if i % 2 else None) for i, t in enumerate(texts)], "n INT, ticket_text STRING, who STRING")
    fields = ["confidence", "affected_systems", "technical_keywords", "user_impact", "priority"]
    some = scoring.score_tickets(df, sender="who", fields=fields, words="found")
    assert str(some._jdf.queryExecution().optimizedPlan()).count("regexp_replace") == 1
    whole = scoring.score_tickets(df, sender="who").withColumn("found", X.search_words(F.coalesce("ticket_text", F.lit(""))))
    want = whole.select("n", "found", *[f"scored.{f}" for f in fields]).orderBy("n").collect()
    assert some.select("n", "found", "scored.*").orderBy("n").collect() == want
    got = {r["n"]: r for r in want}
    assert got[8]["confidence"] == 0 and got[7]["confidence"] == 1 and got[6]["priority"] == "P4" and got[5]["priority"] == "P3"
    assert got[13]["technical_keywords"] == ["HTTP 503", "0xFF", "ERR_A1", "HTTP 404", "NODE-A-7"]
    assert got[9]["affected_systems"] == ["load balancer"] and got[12]["user_impact"] == "Multiple Users"
