"""Sources, sinks and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from ticketloom.operators import reload, tickets
from ticketloom.sources import readers, sinks
from ticketloom.streaming import streams


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_text_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo é")
    (tmp_path / "b.md").write_text("no")
    out = readers.read_text_docs(spark, str(tmp_path)).collect()
    assert [(r["filename"], r["content"]) for r in out] == [("a.txt", "one\ntwo é")]
    assert readers.read_text_docs(spark, str(tmp_path), 3).first()["content"] == "one"


def test_ticket_csv(spark, tmp_path):
    good, bad = tmp_path / "g.csv", tmp_path / "b.csv"
    good.write_text('ticket_text,who\n"line one\nsays ""hi"", ok",me\n')
    bad.write_text("text\nx\n")
    assert rows(readers.read_tickets_csv(spark, str(good))) == [('line one\nsays "hi", ok', "me")]
    with pytest.raises(ValueError, match="ticket_text"):
        readers.read_tickets_csv(spark, str(bad))


def test_ticket_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("  first \n\n\t\nsecond\n")
    out = readers.read_ticket_file(spark, str(tmp_path / "t.txt"))
    assert sorted(r["ticket_text"] for r in out.collect()) == ["first", "second"]


def test_build_tickets_schema(spark):
    df = spark.createDataFrame([("T1", "s", "d")], "ticket_id string, subject string, description string")
    out = tickets.build_tickets(df)
    assert len(out.columns) == 9 and out.first()["ticket_text"] == "Subject: s\n\nDescription: d"


def test_table_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1,)], "k int")
    two = spark.createDataFrame([(2,)], "k int")
    with pytest.raises(ValueError):
        sinks.write_table(one, path, "other")
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    sinks.write_table(one, path, "incremental")
    sinks.write_table(two, path, "incremental")
    assert rows(sinks.read_table(spark, path)) == [(1,), (2,)]
    sinks.write_table(two, path, "full")
    assert rows(sinks.read_table(spark, path)) == [(2,)]


def test_a_load_run_again_does_not_double_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    for _ in range(3):
        sinks.write_table(rows_of(1, 2, 3), path, "incremental")
        sinks.write_table(rows_of(3, 2, 1).repartition(3), path, "incremental")
    assert rows(sinks.read_table(spark, path)) == [(1,), (2,), (3,)]
    for _ in range(2):
        sinks.write_table(rows_of(1, 2, 3), path, "incremental", load="second")
        sinks.write_table(rows_of(4), path, "incremental", load="third")
    assert rows(sinks.read_table(spark, path)) == [(1,), (1,), (2,), (2,), (3,), (3,), (4,)]
    os.remove(f"{path}/v1-third/_SUCCESS")  # a load that was lost half way
    assert (4,) not in rows(sinks.read_table(spark, path))
    sinks.write_table(rows_of(4), path, "incremental", load="third")
    assert (4,) in rows(sinks.read_table(spark, path))
    with pytest.raises(ValueError, match="name"):
        sinks.write_table(rows_of(4), path, "incremental", load="a/b")
    sinks.write_table(rows_of(9), path, "full")
    assert rows(sinks.read_table(spark, path)) == [(9,)]
    assert sorted(sinks.drop_old_versions(spark, path))[0] == "v1" and os.listdir(path) == ["v2"] and rows(sinks.read_table(spark, path)) == [(9,)]


def test_old_buckets_are_dropped(spark, tmp_path):
    path = str(tmp_path / "k")
    for n in range(4):
        sinks.upsert_table(spark.createDataFrame([(f"k{i}", n) for i in range(0, 40, n + 1)], "key string, v int"), path, "key", buckets=4)
    before = rows(sinks.read_keyed(spark, path))
    assert sinks.drop_old_versions(spark, path) and rows(sinks.read_keyed(spark, path)) == before
    assert not sinks.drop_old_versions(spark, path)
    sinks.upsert_table(spark.createDataFrame([("k1", 99)], "key string, v int"), path, "key", buckets=4)
    assert dict(rows(sinks.read_keyed(spark, path)))["k1"] == 99


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1,)], "k int"), path, "full")
    spark.createDataFrame([(9,)], "k int").write.parquet(f"{path}/v2")
    os.remove(f"{path}/v2/_SUCCESS")
    assert rows(sinks.read_table(spark, path)) == [(1,)]


def test_keyed_upsert(spark, tmp_path):
    path = str(tmp_path / "k")
    start = spark.createDataFrame([(f"k{i}", i) for i in range(50)], "key string, v int")
    sinks.upsert_table(start, path, "key", buckets=16)
    change = spark.createDataFrame([("k1", 100), ("new", 7)], "key string, v int")
    for _ in range(2):  # applying the same change again changes nothing
        sinks.upsert_table(change, path, "key", buckets=16)
        got = dict(rows(sinks.read_keyed(spark, path)))
        assert got == {f"k{i}": i for i in range(50)} | {"k1": 100, "new": 7}
    touched = [d for d in os.listdir(f"{path}/k2-16") if d.startswith("bucket=")]
    assert len(touched) <= 2
    with pytest.raises(ValueError, match="buckets"):
        sinks.upsert_table(change, path, "key", buckets=8)


def test_repeated_source_keys(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, "t"), ("b", 1, "t")], "key string, v int, s string")
    twice = spark.createDataFrame([("a", 2, "x"), ("a", 3, "y"), ("c", 5, None)], target.schema)
    assert sorted(rows(sinks.upsert(target, twice, "key", "v"))) == [("a", 3, "y"), ("b", 1, "t"), ("c", 5, None)]
    with pytest.raises(Exception, match="more than one source row"):
        sinks.upsert(target, twice, "key").collect()
    with pytest.raises(Exception, match="more than one source row"):
        sinks.upsert_table(twice, str(tmp_path / "k"), "key", buckets=4)
    sinks.upsert_table(twice, str(tmp_path / "n"), "key", buckets=4, version="v")
    assert sorted(rows(sinks.read_keyed(spark, str(tmp_path / "n")))) == [("a", 3, "y"), ("c", 5, None)]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], 'q"u')], "id string, tags array<string>, t string")
    sinks.export_results_csv(df, str(tmp_path / "c"))
    back = spark.read.csv(str(tmp_path / "c"), header=True, escape='"')
    assert rows(back) == [("a", "x, y", 'q"u')]
    sinks.export_analysis_json(df.select("id", F.struct("tags").alias("s")), str(tmp_path / "j"))
    written = "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    assert json.loads(written) == {"id": "a", "s": {"tags": ["x", "y"]}}


def test_index_sync_is_incremental(spark, tmp_path):
    source, index, mark = (str(tmp_path / n) for n in ("s", "i", "m"))
    schema = "doc_id STRING, content STRING, created_at TIMESTAMP"

    def add(*items):
        spark.createDataFrame(items, "doc_id string, content string, at string").select(
            "doc_id", "content", F.to_timestamp("at").alias("created_at")
        ).coalesce(1).write.mode("append").parquet(source)

    def sync():
        streams.sync_index(spark, source, index, mark,
                           lambda df: df.withColumn("n", F.length("content")), schema).awaitTermination()
        return {r["doc_id"]: (r["content"], r["n"]) for r in sinks.read_keyed(spark, index).collect()}

    add(("a", "one", "2024-01-01 00:00:00"), ("b", "two", "2024-01-01 00:00:00"), ("a", "newer", "2024-01-02 00:00:00"))
    assert sync() == {"a": ("newer", 5), "b": ("two", 3)}
    versions = sorted(os.listdir(index))
    assert sync() == {"a": ("newer", 5), "b": ("two", 3)} and sorted(os.listdir(index)) == versions
    add(("b", "two", "2024-01-03 00:00:00"))  # unchanged content
    assert sync()["b"] == ("two", 3) and sorted(os.listdir(index)) == versions
    add(("b", "changed", "2024-01-04 00:00:00"), ("c", "x", "2024-01-04 00:00:00"))
    assert sync() == {"a": ("newer", 5), "b": ("changed", 7), "c": ("x", 1)}
    versions = sorted(os.listdir(index))
    add(("a", "late and old", "2024-01-01 12:00:00"), ("b", "two", "2024-01-02 00:00:00"))
    assert sync() == {"a": ("newer", 5), "b": ("changed", 7), "c": ("x", 1)} and sorted(os.listdir(index)) == versions


def test_rows_older_than_an_equal_newer_one_stay_away(spark, tmp_path):
    """A at one time, A again later, then a late B from between; and removals that come twice."""
    source, index, mark = (str(tmp_path / n) for n in ("s", "i", "m"))
    schema = "doc_id STRING, content STRING, created_at TIMESTAMP, gone BOOLEAN"
    embedded = []

    def embed(df):
        embedded.append(df.count())
        return df.withColumn("n", F.length("content"))

    def sync(*items):
        spark.createDataFrame(items, "doc_id string, content string, at string, gone boolean").select(
            "doc_id", "content", F.to_timestamp("at").alias("created_at"), "gone").coalesce(1).write.mode("append").parquet(source)
        streams.sync_index(spark, source, index, mark, embed, schema, removed="gone", buckets=4).awaitTermination()
        return {r["doc_id"]: r["content"] for r in streams.read_index(spark, index, "gone").collect()}

    assert sync(("a", "A", "2024-02-01 00:00:00", False), ("r", "R", "2024-01-01 00:00:00", False)) == {"a": "A", "r": "R"}
    assert sync(("a", "A", "2024-04-01 00:00:00", False), ("r", None, "2024-02-01 00:00:00", True)) == {"a": "A"}
    assert sum(embedded) == 2  # equal content is not embedded again
    assert sync(("r", None, "2024-05-01 00:00:00", True)) == {"a": "A"}
    assert sync(("a", "B", "2024-03-01 00:00:00", False), ("r", "back", "2024-04-01 00:00:00", False)) == {"a": "A"}
    assert sync(("a", "B", "2024-04-02 00:00:00", False), ("r", "back", "2024-06-01 00:00:00", False)) == {"a": "B", "r": "back"}


def test_a_ticket_delivered_again_is_written_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("s", "o", "m"))
    schema = "ticket_id string, ticket_text string, submitted_date timestamp"

    def arrive(*items):
        spark.createDataFrame(items, "ticket_id string, ticket_text string, at string").select(
            "ticket_id", "ticket_text", F.to_timestamp("at").alias("submitted_date")).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(schema).parquet(source)
        query = streams.start_append(streams.classify_stream(streams.once_each(arriving, delay="2 days")), out, mark)
        query.awaitTermination()
        state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return sorted(r["ticket_id"] for r in spark.read.parquet(out).collect()), state[-1]

    assert arrive(("a", "locked out", "2024-01-01 00:00:00"), ("a", "locked out", "2024-01-01 00:00:00"), ("b", "breach", "2024-01-01 01:00:00"))[0] == ["a", "b"]
    assert arrive(("a", "locked out", "2024-01-01 00:00:00"), ("c", "x", "2024-01-02 00:00:00"))[0] == ["a", "b", "c"]
    ids, state = arrive(*((f"n{k}", "x", f"2024-02-{1 + k % 28:02d} 00:00:00") for k in range(50)))
    assert len(ids) == 53
    ids, state = arrive(("last", "x", "2024-03-20 00:00:00"))
    assert len(ids) == 54 and state <= 2  # keys behind the watermark are gone


def test_classified_stream_appends_once(spark, tmp_path):
    source, out, mark = (str(tmp_path / n) for n in ("s", "o", "m"))
    df = spark.createDataFrame([("t1", "locked out"), ("t2", "breach")], "ticket_id string, ticket_text string")
    df.write.parquet(source)

    def run():
        arriving = spark.readStream.schema(df.schema).parquet(source)
        streams.start_append(streams.classify_stream(arriving), out, mark).awaitTermination()
        return sorted((r["ticket_id"], r["classification"]["priority"]) for r in spark.read.parquet(out).collect())

    assert run() == run() == [("t1", "P3"), ("t2", "P2")]
    spark.createDataFrame([("t3", "hello")], df.schema).write.mode("append").parquet(source)
    assert len(run()) == 3


def test_removed_rows_leave_the_index(spark, tmp_path):
    source, index, mark = (str(tmp_path / n) for n in ("s", "i", "m"))
    schema = "doc_id STRING, content STRING, created_at TIMESTAMP, gone BOOLEAN"

    def sync(*items):
        spark.createDataFrame(items, "doc_id string, content string, at string, gone boolean").select(
            "doc_id", "content", F.to_timestamp("at").alias("created_at"), "gone"
        ).coalesce(1).write.mode("append").parquet(source)
        streams.sync_index(spark, source, index, mark, lambda df: df.withColumn("n", F.length("content")), schema,
                           removed="gone", buckets=4).awaitTermination()
        return {r["doc_id"]: (r["content"], r["n"]) for r in streams.read_index(spark, index, "gone").collect()}

    assert sync(("a", "one", "2024-01-01 00:00:00", False), ("b", "two", "2024-01-01 00:00:00", None)) == {"a": ("one", 3), "b": ("two", 3)}
    assert sync(("a", None, "2024-01-03 00:00:00", True)) == {"b": ("two", 3)}
    assert sync(("a", "late", "2024-01-02 00:00:00", False), ("z", None, "2024-01-02 00:00:00", True)) == {"b": ("two", 3)}
    assert sync(("a", "again", "2024-01-04 00:00:00", False)) == {"a": ("again", 5), "b": ("two", 3)}


def test_reload_replaces_whole_files(spark, tmp_path):
    path = str(tmp_path / "kb")
    para = "word " * 260
    three, two = "\n\n".join([para] * 3), "\n\n".join([para + "x"] * 2)

    def load(files, **options):
        docs = spark.createDataFrame(files, "filename string, content string")
        reload.reload_kb(docs, path, F.lit("2024-01-01 00:00:00"), buckets=4, **options)
        kept = reload.read_kb(spark, path).groupBy("filename").count()
        return {r["filename"]: r["count"] for r in kept.collect()}, {r["filename"] for r in reload.read_loads(spark, path).collect()}

    first, files = load([("a.txt", three), ("b.txt", two), ("empty.txt", None), (None, "lost")])
    assert first["a.txt"] > first["b.txt"] and files == {"a.txt", "b.txt", "empty.txt"} and "empty.txt" not in first
    before = sorted(os.listdir(f"{path}/chunks"))
    assert load([("a.txt", three), ("b.txt", two), ("empty.txt", "")]) == (first, files)
    assert sorted(os.listdir(f"{path}/chunks")) == before  # nothing new, not even the file without chunks
    shrunk, _ = load([("a.txt", two), ("b.txt", two), ("empty.txt", "")])
    assert shrunk["a.txt"] == first["b.txt"]
    assert load([("a.txt", three), ("b.txt", two), ("empty.txt", "")])[0] == first
    assert load([("b.txt", two)], remove_missing=False)[0] == first
    assert load([("b.txt", two)]) == ({"b.txt": first["b.txt"]}, {"b.txt"})
    assert load([("b.txt", three)], mode="full")[0] == {"b.txt": first["a.txt"]}
    with pytest.raises(Exception, match="more than one source row"):
        load([("b.txt", two), ("b.txt", three)])
    assert load([("b.txt", three)])[0] == {"b.txt": first["a.txt"]}


def test_narrow_rows_are_spread_by_their_number(spark, tmp_path):
    from ticketloom.sources import readers

    spark.range(0, 420_000, 1, 1).write.parquet(str(tmp_path / "narrow"))
    source = spark.read.parquet(str(tmp_path / "narrow"))
    spread = readers.spread_small(source, source)
    assert spread.rdd.getNumPartitions() == 9 and spread.count() == 420_000


def test_analysis_export_may_be_compressed(spark, tmp_path):
    history = [{"rank": k, "resolution": f"Fixed by the team {k}. " * 20} for k in range(3)]
    df = spark.createDataFrame([(f"t{i}", history) for i in range(500)], "ticket_id string, history array<struct<rank: int, resolution: string>>")
    for name, compression in (("plain", "none"), ("small", "gzip")):
        sinks.export_analysis_json(df, str(tmp_path / name), compression)
    plain, small = (sum(f.stat().st_size for f in (tmp_path / n).glob("part-*")) for n in ("plain", "small"))
    assert 10 * small < plain
    assert sorted(spark.read.schema(df.schema).json(str(tmp_path / "small")).collect()) == sorted(df.collect())


def test_texts_go_to_folders_of_one_task_each(spark, tmp_path):
    rows = [(i, f"text {i % 7}\nend") for i in range(300)]
    path = str(tmp_path / "texts")
    sinks.export_texts(spark.createDataFrame(rows, "id int, t string").repartition(3), path, "t", "id", 300)
    folders = {f: list(f.glob("*.txt")) for f in (tmp_path / "texts").glob("folder=*")}
    assert len(folders) == 4 and sum(len(files) for files in folders.values()) == 300
    for files in folders.values():
        assert len({f.name.split("-")[1] for f in files}) == 1
    back = readers.read_text_docs(spark, path).collect()
    assert sorted(r["content"].rstrip("\n") for r in back) == sorted(t for _, t in rows)
    assert all(r["path"].endswith("/" + r["filename"]) for r in back)


def test_texts_are_written_without_files_beside_them(spark, tmp_path):
    """Odd texts and keys come back as Spark's own writer leaves them; nothing but the texts is made for a row."""
    rows = [(1, "plain"), (1, "same key"), (None, ""), (4, None), (5, "two\nlines\n"), (None, "é \U0001f600 \x00"), (7, "x" * 100_000)]
    df = spark.createDataFrame(rows, "id int, t string").unionByName(spark.sql("SELECT 8 AS id, CAST(X'61FF62' AS STRING) AS t"))
    path, plain = tmp_path / "texts", str(tmp_path / "plain")
    sinks.export_texts(df, str(path), "t", "id", 8)
    df.select("t").repartition(3).write.option("maxRecordsPerFile", 1).text(plain)
    assert len([f for f in path.rglob("*") if f.is_file()]) == 8 + len([f for f in path.rglob("*_SUCCESS*") if f.is_file()])
    raw = lambda at: sorted(f.read_bytes() for f in at.rglob("*.txt"))
    assert raw(path) == raw(tmp_path / "plain") and b"a\xffb\n" in raw(path)
    back = [sorted(r["content"] for r in readers.read_text_docs(spark, at).collect()) for at in (str(path), plain)]
    assert back[0] == back[1] and len(back[0]) == 8
    with pytest.raises(Exception, match="exists"):
        sinks.export_texts(df, str(path), "t", "id", 8)
    sinks.export_texts(df.limit(0), str(tmp_path / "none"), "t", "id", 0)
    assert not list((tmp_path / "none").rglob("*.txt")) and (tmp_path / "none" / "_SUCCESS").exists()


def test_index_sync_reads_contents_of_changed_rows_only(spark, tmp_path):
    source, index, mark = (str(tmp_path / n) for n in ("s", "i", "m"))
    embedded = spark.sparkContext.accumulator(0)

    def embed(df):
        def run(batches):
            for batch in batches:
                embedded.add(len(batch))
                yield batch
        return df.mapInPandas(run, df.schema)

    def sync(*items):
        rows = spark.createDataFrame(items, "doc_id string, content string, at string")
        rows.select("doc_id", "content", F.to_timestamp("at").alias("created_at")).write.mode("append").parquet(source)
        streams.sync_index(spark, source, index, mark, embed, "doc_id STRING, content STRING, created_at TIMESTAMP", buckets=2).awaitTermination()
        return sorted((r["doc_id"], r["content"], r["created_at"].day) for r in streams.read_index(spark, index).collect())

    # of rows with one key and version the greatest content counts; a row without a key is left out
    assert sync(("a", "x", "2024-01-01"), ("a", "y", "2024-01-01"), ("b", "z", "2024-01-01"), (None, "n", "2024-01-01")) == [("a", "y", 1), ("b", "z", 1)]
    first = embedded.value
    # newer rows of equal content, also where a smaller content has the same version, are only seen
    assert sync(("b", "z", "2024-01-03"), ("a", "x", "2024-01-02"), ("a", "y", "2024-01-02")) == [("a", "y", 1), ("b", "z", 1)]
    assert sync(("b", "late", "2024-01-02"), ("a", "late", "2024-01-01")) == [("a", "y", 1), ("b", "z", 1)]
    assert embedded.value == first
    assert sync(("b", "new", "2024-01-04")) == [("a", "y", 1), ("b", "new", 4)]
