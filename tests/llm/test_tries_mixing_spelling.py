"""The conversation trie, the mix and the spelling variants against brute force, and very long texts for every operator."""

from __future__ import annotations

import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from ticketloom.llm import backoff, bpe, language, mixing, neardup, packing, piecewise, quality, secret_scan, spelling, substrings, tries, url_rules
from ticketloom.llm.queries import QUERIES, tokenizer_path

DATA = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(df):
    return sorted(tuple(r[c] for c in NODE) for r in df.collect())


# --- trie -------------------------------------------------------------------------------------------


def test_trie_of_the_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, DATA)
    assert sorted(got.columns) == sorted(NODE)
    assert nodes(got) == sorted(brute.trie(rows).values())


@pytest.mark.parametrize("segment,turns", [(256, 1 << 18), (2, 7), (3, 1)])
def test_trie_with_shared_beginnings(spark, monkeypatch, segment, turns):
    """Few texts, so that beginnings, whole conversations and ends are shared; small segments and slices cut them anywhere."""
    monkeypatch.setattr(tries, "SEGMENT", segment)
    monkeypatch.setattr(tries, "SLICE_TURNS", turns)
    rng = random.Random(segment)
    rows = []
    for c in range(120):
        for t in range(rng.choice([0, 1, 2, 5, 9, 14])):
            rows.append((c, rng.choice([t, t, t, 0, None]), rng.choice(["user", "user", None, "assistant"]), rng.choice(["a", "a", "a", "bb", "é", "", None])))
    rows += [(7, 50 + k, "user", "long") for k in range(40)] + [(c, t, "user", f"same {t}") for c in range(200, 260) for t in range(4)]
    rng.shuffle(rows)
    got = tries.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(5))
    assert nodes(got) == sorted(brute.trie(rows).values())


def test_trie_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (1, None, None, None), (1, None, None, None), (-3, 2, "a", "b"), (-3, 1, "", ""), (5, 0, "u", "x" * 100_000), (10**12, 7, "u", "日本")]
    frame = spark.createDataFrame([(*r, "z", "y", "w") for r in rows], TURNS + ", key string, pos string, start string")
    assert nodes(tries.conversation_trie(frame)) == sorted(brute.trie(rows).values())
    assert tries.conversation_trie(frame.where("false")).count() == 0
    only = spark.createDataFrame([(10, 0, "u", "x"), (15, 0, "u", "x")], TURNS)
    assert nodes(tries.conversation_trie(only)) == sorted(brute.trie([tuple(r) for r in only.collect()]).values())


def test_double_array_holds_its_sequences_only():
    rng = random.Random(3)
    for _ in range(60):
        k = rng.choice([1, 2, 5, 300])
        seqs = [[rng.randint(1, k) for _ in range(rng.randint(0, 6))] for _ in range(rng.randint(1, 80))]
        trie = tries.DoubleArray(np.array([c for s in seqs for c in s], np.int64), np.array([len(s) for s in seqs]))
        known = {tuple(s[:d]) for s in seqs for d in range(len(s) + 1)}
        used = np.flatnonzero(trie.check >= 0)
        assert len(used) == len(known) - 1 and np.array_equal(trie.base[trie.check[used]] + trie.code[used], used)

        def cell(s):
            at = 0
            for c in s:
                at = trie.child(at, c)
                if at < 0:
                    return -1
            return at

        assert len({cell(s) for s in known}) == len(known)
        for _ in range(100):
            s = tuple(rng.randint(1, k + 1) for _ in range(rng.randint(1, 6)))
            assert (cell(s) >= 0) == (s in known)


def test_trie_of_one_conversation_with_most_turns(spark):
    rows = [(1, t, "user", f"t{t % 7}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(2, 40) for t in range(3)]
    got = tries.conversation_trie(spark.createDataFrame(rows, TURNS).repartition(6))
    assert nodes(got) == sorted(brute.trie(rows).values())


# --- mix --------------------------------------------------------------------------------------------


def check_mix(rows, got, tight=True):
    """rows: (id, text, source); got: collected mix."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    want = brute.mix_targets(sizes)
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((i, len(brute.words(t)), s) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) <= max(2.0, 0.005 * want[s]), (s, taken[s], want[s])


def test_mix_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = QUERIES["op12_mix"](spark, DATA).collect()
    check_mix([(r.doc_id, r.text, r.source) for r in docs.collect()], got)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_with_a_hot_source_and_small_ones(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["hot"] * 6 + ["b", "c", None, "ä", "Z"])) for k in range(900)]
    rows += [(901, "one", "tiny"), (902, None, "empty"), (903, "", "empty"), (None, "x y z", None), (904, "q " * 9000, "b"), (5, "dup dup", "b"), (5, "dup dup", "b"), (5, "other", "b")]
    frame = spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, number long, size long").repartition(4)
    check_mix(rows, mixing.mix(frame).collect())
    assert mixing.mix(frame.where("false")).count() == 0
    assert {r.taken for r in mixing.mix(frame.where("source = 'empty'")).collect()} == {0}


def test_schedule_holds_proportions_in_every_stretch(spark):
    docs = spark.createDataFrame([(k, " ".join([f"w{k}"] * 50), "abcd"[k % 4] if k % 7 else "e") for k in range(400)], "doc_id long, text string, source string")
    got = mixing.schedule(docs, block=20, least_slots=64).orderBy("slot", "place").collect()
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += 50
    want = brute.mix_targets(sizes)
    slots = sorted({(r.slot, r.source) for r in got})
    total = len(slots)
    share = Counter(s for _, s in slots)
    for n in (100, total // 3, total // 2):
        head = Counter(s for _, s in slots[:n])
        assert all(abs(head[s] - n * share[s] / total) < 6 for s in share)
    taken = Counter()
    for r in got:
        taken[r.source] += r.n_words
    assert all(abs(taken[s] - want[s]) <= 20 for s in sizes)
    texts = mixing.mixed_texts(docs, mixing.schedule(docs, block=20, least_slots=64)).collect()
    assert len(texts) == len(got) and all(set(r.text.split()) == {f"w{r.doc_id}"} for r in texts)
    assert sum(len(r.text.split()) for r in texts) == sum(r.n_words for r in got)


def test_mix_of_very_many_sources(spark):
    rows = [(k, "w " * (1 + k % 13), f"s{k % 700:04d}") for k in range(2100)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    check_mix(rows, got)


# --- spelling ---------------------------------------------------------------------------------------


def by_word(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_of_the_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    counts = brute.vocabulary(rows)
    assert len(counts) > 100 and by_word(QUERIES["op13_spelling"](spark, DATA)) == brute.variants(counts)


@pytest.mark.parametrize("group,bucket", [(16_384, 32_768), (20, 50)])
def test_variants_of_crowded_words(spark, group, bucket, monkeypatch):
    """A small alphabet, so that most words are near each other; small groups are composed in blocks."""
    rng = random.Random(group)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(700)}
    counts = {w: rng.choice([1, 5, 7, 30, 200, 2000]) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    plain = spelling.near_words
    monkeypatch.setattr(spelling, "near_words", lambda w: plain(w, group, bucket))
    assert by_word(spelling.variants(frame)) == brute.variants(counts)


def test_long_chains_of_forms(spark):
    counts = {"a" * (6 + k) : 5 ** (k + 1) for k in range(14)}
    got = by_word(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute.variants(counts) and got["aaaaaa"][1] == "a" * 19


def test_spelling_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "Zebras zebras zebra5zebras " * 4), (3, "ÀÉÎÕÜß ÀÉÎÕÜß àéîõüß"), (3, "ÀÉÎÕÜß ÀÉÎÕÜß ÀÉÎÕÜß日本"), (4, "x" * 200_000), (5, "ab" * 100_000 + " short")]
    rows += [(k, "x" * 200_000) for k in range(10, 15)]
    frame = spark.createDataFrame([(i, t, "q", 1) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    counts = brute.vocabulary(rows)
    got = spelling.vocabulary(frame)
    assert {r.word: r.n for r in got.collect()} == counts and any(len(w) > 100_000 for w in counts)
    assert spelling.spelling_variants(frame.where("false")).count() == 0
    assert set(by_word(spelling.spelling_variants(frame))) == set(counts)


# --- very long texts --------------------------------------------------------------------------------


def long_text(n_bytes: int) -> str:
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    out, size = [], 0
    while size < n_bytes:
        out.append(rng.choice(vocabulary))
        size += len(out[-1]) + 1
    return " ".join(out)


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op12", "op13"])
def test_texts_of_megabytes(spark, name):
    """A text of five megabytes, one of a single run of letters and one of blanks, beside short ones."""
    text = long_text(5_000_000)
    rows = [(1, text, "en", "a"), (2, text, "en", "a"), (3, "x" * 1_000_000, "en", "a"), (4, " " * 1_000_000, "en", "a"), (5, "a few words", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(2)
    n = len(brute.words(text))
    begin = time.perf_counter()
    run = {
        "op1": lambda: quality.judge(docs), "op2": lambda: language.identify(docs, docs), "op3": lambda: neardup.near_duplicates(docs),
        "op4": lambda: piecewise.compare_with_next(docs), "op5": lambda: substrings.repeat_digests(docs), "op6": lambda: secret_scan.secret_digests(docs),
        "op7": lambda: backoff.score_documents(docs, F.lit(True)), "op8": lambda: packing.pack(docs, with_text=True), "op9": lambda: url_rules.filter_urls(docs, "doc_id", "text"),
        "op10": lambda: bpe.encode_digests(docs, tokenizer_path()), "op12": lambda: mixing.mix(docs), "op13": lambda: spelling.spelling_variants(docs),
    }[name]()
    got = run.collect()
    assert time.perf_counter() - begin < 120
    if name == "op8":
        parts = sorted((r for r in got if r.doc_id == 1), key=lambda r: r.piece)
        assert "".join(r.text for r in parts) == text and sum(r.n_tokens for r in parts) == n
    elif name == "op13":
        assert sum(r.n for r in got) > 100_000
    else:
        assert sorted(r.doc_id for r in got) == [1, 2, 3, 4, 5]
    if name == "op3":
        assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}
    if name == "op5":
        assert {r.doc_id: r.n_removed for r in got} == {1: 0, 2: n, 3: 0, 4: 0, 5: 0}
    if name == "op7":
        assert all(math.isfinite(r.score) for r in got)
