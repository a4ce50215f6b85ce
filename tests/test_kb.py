"""Knowledge-base building: goldens, and generated documents against a plain restatement."""

import random

import pytest
from pyspark.sql import functions as F

from ticketloom.operators import kb

LINES = ["", "   ", "plain text line", "ALL CAPS HEAD", "Mixed title", "-----", "=====", "P1 - FIRST", "P3 - THIRD", "SHORT", "SIXCAP"]


def plain_sections(content):
    """Sections by walking the lines: the rule in words, one line at a time."""
    lines = content.split("\n")
    title, body, out, opens = None, [], [], []

    def flush(last):
        text = "\n".join(body).strip()
        if text:
            out.append((title or ("Content" if last else "Introduction"), text))

    for i, line in enumerate(lines):
        s = line.strip()
        under = lines[i + 1].strip() if i + 1 < len(lines) else ""
        caps = any(c.isupper() for c in s) and s == s.upper() and len(s) > 5 and s[:2] not in ("P1", "P2")
        candidate = bool(s) and (caps or under[:3] in ("---", "==="))
        opened = candidate and any(b.strip() for b in body)
        opens.append((candidate, opened))
        if opened:
            flush(False)
            title, body = s, []
        else:
            body.append(line)
    flush(True)
    return out, opens


@pytest.fixture(scope="module")
def generated(spark):
    rng = random.Random(7)
    docs = [(f"d{i}", "\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 25)))) for i in range(2000)]
    return docs, spark.createDataFrame(docs, "filename string, content string").repartition(4).cache()


def test_sections_match_line_by_line_reading(generated):
    docs, df = generated
    got = {}
    for r in kb.split_sections(df).orderBy("filename", "section_no").collect():
        got.setdefault(r["filename"], []).append((r["section_title"], r["section"]))
    for name, content in docs:
        assert got.get(name, []) == plain_sections(content)[0], content


def test_headers_match_line_by_line_reading(generated):
    docs, df = generated
    got = {}
    for r in kb.detect_headers(df).orderBy("filename", "line_no").collect():
        got.setdefault(r["filename"], []).append((r["is_header"], r["opens_section"]))
    for name, content in docs:
        assert got[name] == plain_sections(content)[1], content


# lengths, first paragraph of each chunk, chunk sizes
PACKS = [
    ([900, 700, 300, 1400], [0, 1, 3], [900, 1002, 1400]),
    ([500, 1200], [0], [1702]),
    ([1000, 600], [0], [1602]),
    ([900, 700, 100], [0, 1], [900, 802]),
    ([902, 598], [0], [1502]),
    ([3000], [0], [3000]),
]


def test_packing_goldens(spark):
    rows = [("f", i, "\n\n".join("x" * n for n in lengths)) for i, (lengths, _, _) in enumerate(PACKS)]
    df = spark.createDataFrame(rows, "filename string, section_no int, section string")
    starts = df.select(
        "section_no", kb.chunk_starts(F.transform(kb.paragraphs_of(F.col("section")), F.length)).alias("s")
    ).collect()
    chunks = kb.pack_chunks(df).orderBy("section_no", "chunk_no").collect()
    for r in starts:
        assert r["s"] == PACKS[r["section_no"]][1]
    for i, (_, _, sizes) in enumerate(PACKS):
        assert [c["char_count"] for c in chunks if c["section_no"] == i] == sizes


def test_packing_keeps_every_paragraph(spark):
    rng = random.Random(3)
    rows = [("f", i, "\n\n".join("y" * rng.randint(1, 1700) for _ in range(rng.randint(1, 40)))) for i in range(200)]
    df = spark.createDataFrame(rows, "filename string, section_no int, section string").filter("length(section) >= 100")
    chunks = {}
    for r in kb.pack_chunks(df).orderBy("section_no", "chunk_no").collect():
        chunks.setdefault(r["section_no"], []).append((r["chunk_no"], r["chunk"]))
    for r in df.collect():
        parts = chunks[r["section_no"]]
        assert [n for n, _ in parts] == list(range(len(parts)))
        assert "\n\n".join(c for _, c in parts) == r["section"]
        assert all(len(c) + 2 >= 800 for _, c in parts[:-1])


def test_hard_max_splits_small_buffers(spark):
    df = spark.createDataFrame([("f", 0, "x" * 500 + "\n\n" + "x" * 1200)], "filename string, section_no int, section string")
    assert kb.pack_chunks(df, hard_max=1500).count() == 2


# Expected type and category by file name.
FILES = [
    ("IT_infrastructure_runbook", "Runbook", "Infrastructure"),
    ("application_support_guide", "Guide", "Applications"),
    ("cloud_resources_guide", "Guide", "Cloud_Resources"),
    ("database_admin_guide", "Guide", "Database_Administration"),
    ("email_system_troubleshooting", "Guide", "Email_Systems"),
    ("monitoring_and_alerting_guide", "Guide", "General"),
    ("network_troubleshooting_guide", "Guide", "Network_Troubleshooting"),
    ("security_incident_playbook", "Playbook", "Security"),
    ("slack_collaboration_guide", "Guide", "General"),
    ("storage_backup_guide", "Guide", "General"),
    ("ticket_classification_rules", "Rules", "Classification"),
    ("user_access_policies", "Policy", "Access_Management"),
    ("desk_support", "Support_Guide", "General"),
]


def test_file_metadata(spark):
    df = spark.createDataFrame([(f + ".txt",) for f, _, _ in FILES], "filename string")
    rows = df.select("filename", kb.infer_doc_type(F.col("filename")), kb.infer_kb_category(F.col("filename"))).collect()
    assert {tuple(r) for r in rows} == {(f + ".txt", t, c) for f, t, c in FILES}


def test_chunk_documents_rows(spark):
    body = "\n\n".join("Words about disk space. " * 30 for _ in range(4))
    content = f"====\nMY TITLE HERE\n====\n{body}\n\nSECOND PART\n----\n{'More disk words. ' * 20}"
    df = spark.createDataFrame([("my runbook.txt", content)], "filename string, content string")
    rows = kb.chunk_documents(df, F.lit("2024-05-01 10:00:00")).orderBy("chunk_index").collect()
    assert [r["doc_id"] for r in rows] == [f"Runbook_MY_RUNBOOK_{i:03d}" for i in range(1, len(rows) + 1)]
    assert all(r["title"].startswith("MY TITLE HERE - ") for r in rows)
    last = rows[-1]
    assert last["total_chunks"] == 1 and "(Part" not in last["title"]
    assert rows[0]["total_chunks"] == len(rows) - 1 and rows[0]["title"].endswith("(Part 1)")
    assert all(r["char_count"] == len(r["content"]) for r in rows)
    assert rows[0]["keywords"][0] in ("words", "disk", "space", "about")


def test_entries_of_both_styles(spark):
    text = (
        "SECTION 1: SERVERS\n-------\n\n1.1 Busy Processor\nPriority: P1 (Critical if production)\n"
        "Affected Systems: App servers, databases\nResolution Steps:\n- Look at top\n- Restart it\n"
        "- Average resolution time: 30 minutes\nEscalation: Infra team\n\n"
        "Metrics Missing (Priority P2):\n- Check the agent\n- Average resolution time: 1 hour\n\nNo Priority here, just words."
    )
    df = spark.createDataFrame([("a.txt", text)], "filename string, content string")
    one, two = kb.extract_kb_entries(df).orderBy("block_no").drop("entry_text").collect()
    assert one["entry_title"] == "1.1 Busy Processor" and one["priority"] == "P1"
    assert one["affected_systems"] == ["App servers", "databases"] and one["steps"] == ["Look at top", "Restart it"]
    assert one["avg_resolution_minutes"] == 30 and one["escalation"] == "Infra team"
    assert two["entry_title"] == "Metrics Missing" and two["priority"] == "P2" and two["affected_systems"] == []
    assert two["avg_resolution_minutes"] == 60 and two["escalation"] is None


def test_new_and_changed_documents(spark):
    docs = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "filename string, content string")
    seen = docs.filter("filename <> 'c'").select(
        "filename", F.when(F.col("filename") == "b", "old").otherwise(kb.content_hash(F.col("content"))).alias("content_hash"))
    assert {r["filename"] for r in kb.select_new_docs(docs, seen).collect()} == {"b", "c"}
    keys = kb.new_doc_keys(docs, seen)
    assert sorted(map(tuple, kb.select_new_docs(docs, seen, keys).collect())) == sorted(
        map(tuple, kb.select_new_docs(docs, seen).collect()))


def test_document_id_formats(spark):
    ids = spark.createDataFrame([("Guide_AXB_001",), ("Guide_A_B_001",), ("Guide_001",), ("Guide_0012",)], "doc_id string")
    row = kb.match_doc_ids(ids, F.lit("Guide"), F.lit("A_B")).first()
    assert (row["new_format"], row["old_format"]) == (1, 1)


def test_chunking_is_map_only(spark):
    df = spark.createDataFrame([("a.txt", "x")], "filename string, content string")
    plan = kb.chunk_documents(df, F.lit("2024-01-01"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_title_and_hash_are_worked_out_once_a_document(spark):
    df = spark.createDataFrame([("a.txt", "x")], "filename string, content string")
    plan = kb.chunk_documents(df, F.lit("2024-01-01"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and "md5(" in plan[plan.index("Generate explode"):]


def test_packing_a_section_of_many_paragraphs(spark):
    """A hundred thousand paragraphs in one section, against the plain rule, in linear time."""
    import random
    import time

    rng = random.Random(4)

    def plain(lengths):
        starts, size = [0], 0
        for k, p in enumerate(lengths):
            if size > 0 and size + p > 1500 and size >= 800:
                starts.append(k)
                size = p + 2
            else:
                size += p + 2
        return starts[:-1] if len(starts) > 1 and size < 800 else starts

    seconds = {}
    for n in (1, 255, 256, 257, 513, 25_000, 100_000):
        lengths = [rng.choice([10, 120, 400, 900, 1600]) for _ in range(n)]
        df = spark.createDataFrame([(lengths,)], "l array<int>").select(kb.chunk_starts(F.col("l")).alias("s"))
        begin = time.perf_counter()
        assert df.first()["s"] == plain(lengths)
        seconds[n] = time.perf_counter() - begin
    assert seconds[100_000] < 60
