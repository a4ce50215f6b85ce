"""Rule tables against the policy expression and against plain loops."""

import random
import re

from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.operators import rulebook, scoring

COLUMNS = ("fired_rules", "set_priority", "min_priority", "rule_urgency", "rule_category", "rule_team", "notify", "actions")


def tickets(spark, n=300, seed=3):
    rng = random.Random(seed)
    phrases = [p for r in policy.RULES for p in (*r.phrases, *r.unless, *r.soon_phrases)] + ["nothing", "application x", "Password-Reset!", "reset password", "über"]
    rows = [(k, " ".join(rng.choices(phrases, k=rng.randint(0, 5))), rng.choice(["ceo@example.com", "user@example.com", "Chief Officer", None])) for k in range(n)]
    return spark.createDataFrame([*rows, (n, None, None), (n + 1, "", "vip")], "ticket_id int, ticket_text string, who string")


def found(df):
    return {r["ticket_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_both_ways_give_the_policy_results(spark):
    t = tickets(spark)
    want = found(scoring.match_rules(t, sender="who"))
    rules = rulebook.rule_table(spark)
    assert found(rulebook.match_rule_table(t, rules, sender="who")) == want
    assert found(rulebook.match_rule_table(t, rules, sender="who", most_sent=0)) == want


def test_thousands_of_rules(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    phrase = lambda: " ".join(rng.choices(words, k=rng.choice([1, 2, 2, 3, 6])))
    rules = [policy.Rule(k, phrases=tuple(phrase() for _ in range(3)), unless=(phrase(),) if k % 3 == 0 else (), soon_phrases=(phrase(),) if k % 5 == 0 else (),
                         soon_priority="P1", set_priority=rng.choice(["P2", "P3", None]), min_priority=rng.choice(["P2", "P4", None]), category=rng.choice(["A", "B", None]),
                         team=rng.choice(["T", None]), urgency=rng.choice(["Low", "High", None]), notify=rng.choice(["n", None]), action=f"a{k}",
                         sender_pattern="boss" if k == 7 else None) for k in range(3000)]
    texts = [(k, " ".join(rng.choices(words, k=rng.randint(0, 30))), rng.choice(["boss", "x"])) for k in range(200)]
    frame, table = spark.createDataFrame(texts, "ticket_id int, ticket_text string, who string"), rulebook.rule_table(spark, rules)
    got = found(rulebook.match_rule_table(frame, table, sender="who"))
    assert got == found(rulebook.match_rule_table(frame, table, sender="who", most_sent=10))
    for k, text, who in texts:
        padded = f" {text} "
        has = lambda ps: any(f" {p} " in padded for p in ps)
        fired = [r for r in rules if (has(r.phrases) or (r.sender_pattern and re.search(r.sender_pattern, who))) and not has(r.unless)]
        own = [(r.soon_priority if has(r.soon_phrases) else r.set_priority) for r in fired if r.set_priority]
        first = lambda n: next((getattr(r, n) for r in fired if getattr(r, n)), None)
        assert got[k] == ([r.rule_id for r in fired], min(own, default=None), min((r.min_priority for r in fired if r.min_priority), default=None),
                          next((u for u in policy.URGENCIES if any(r.urgency == u for r in fired)), None), first("category"), first("team"),
                          [r.notify for r in fired if r.notify], [r.action for r in fired])


def test_team_keywords_as_a_table(spark):
    t = tickets(spark).withColumn("ticket_text", F.concat_ws(" ", "ticket_text", F.lit("VPN server")))
    want = {r["ticket_id"]: (r["best_team"], {s["team"]: s["score"] for s in r["team_scores"] if s["score"]}) for r in scoring.score_teams(t).collect()}
    got: dict = {}
    for r in rulebook.score_team_table(t, rulebook.keyword_table(spark)).collect():
        best, scores = got.get(r["ticket_id"], (None, {}))
        got[r["ticket_id"]] = (r["team"] if r["best"] else best, scores | {r["team"]: r["score"]})
    assert got == {k: v for k, v in want.items() if v[0]}


def test_team_keywords_are_looked_up_before_anything_is_shuffled(spark):
    t = tickets(spark).withColumn("ticket_id", F.col("ticket_id") % 100)
    keywords = rulebook.keyword_table(spark)
    sent, joined = (rulebook.score_team_table(t, keywords, most_sent=n) for n in (rulebook.MOST_SENT, 0))
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, joined.collect()))
    assert sent.count() > 50
    for df in (sent, joined):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # runs of words that are no keywords are not made distinct
        deepest = plan[plan.rindex("Aggregate"):]
        assert "MapInArrow" in deepest or "Join" in deepest
