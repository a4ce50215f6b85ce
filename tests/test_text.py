"""Text expressions against plain Python on many generated texts at once."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from ticketloom import policy
from ticketloom.functions import text as X

ALPHABET = ["alpha", "beta", "with", "gamma", "node_x", "théâtre", "abc", "delta9", "Alpha", "these", "zeta", "eta,zeta"]


def some_texts(n=300, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def plain_words(text):
    found = re.findall(r"[^\W]+", text.lower())
    return [w for w in found if re.fullmatch(r"[a-z]{4,}", w) and w not in policy.STOP_WORDS]


def test_whitespace_is_all_of_unicode():
    assert set(X.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_blank(spark):
    rows = [("  a b \n",), ("\t\r\n",), (None,), ("",)]
    out = spark.createDataFrame(rows, "t string").select(X.strip(F.col("t")), X.is_blank(F.col("t"))).collect()
    assert [tuple(r) for r in out] == [("a b", False), ("", True), (None, True), ("", True)]


def test_words_keywords_and_counts(spark):
    texts = some_texts()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", X.words(F.col("t")).alias("w"), X.word_counts(X.words(F.col("t"))).alias("c"),
                     X.keywords(F.col("t"), 3).alias("k")).collect()
    for r in rows:
        expected = plain_words(r["t"])
        assert r["w"] == expected
        assert {c["word"]: c["n"] for c in r["c"]} == Counter(expected)
        assert [c["word"] for c in r["c"]] == sorted(set(expected))
        first = {w: expected.index(w) for w in set(expected)}
        counts = Counter(expected)
        assert r["k"] == sorted(counts, key=lambda w: (-counts[w], first[w]))[:3]


def test_keyword_goldens(spark):
    cases = [
        ("disk disk full full again", ["disk", "full", "again"]),
        ("these were with from", []),
        ("one two vpn", []),
        ("cafés under_score abc1 word", ["word"]),
    ]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    assert [r[0] for r in df.select(X.keywords(F.col("t"))).collect()] == [k for _, k in cases]


def test_phrases_match_whole_words(spark):
    cases = [
        ("associated costs", "SSO", False), ("the enterprise", "ERP", False), ("SSO fails", "SSO", True),
        ("customer facing site", "customer-facing", True), ("Customer-Facing!", "customer-facing", True),
    ]
    for text, phrase, expected in cases:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(F.contains(X.normalise(F.col("t")), F.lit(X.padded(phrase)))).first()[0] is expected


def test_previews(spark):
    df = spark.createDataFrame([("x" * 81,), ("short",)], "t string")
    c = F.col("t")
    rows = df.select(X.preview(c, 80), X.preview(c, 100, "always"), X.preview(c, 5, "never")).collect()
    assert [tuple(r) for r in rows] == [
        ("x" * 80 + "...", "x" * 81 + "...", "xxxxx"), ("short", "short...", "short")]
