"""Writers. A table is a folder of numbered versions; readers take the newest whole one.

A version counts only once Spark has written its ``_SUCCESS`` file, so a lost job
leaves the former version in force, and nothing being read is ever overwritten. Rows
added to a version lie beside it in one folder for each load, under the load's name.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODES = ("full", "incremental")
LIVE = "is_live"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, in local mode only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/ticketloom/{name}-{os.urandom(8).hex()}"
    if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"ticketloom-{name}-")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back: computed once, and safe to lose executors after."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _children(spark: SparkSession, path: str, success: bool = True) -> list[str]:
    """Names of the folders in a folder, of the complete ones where ``success`` is asked for."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return []
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    return sorted(n for n in names if not success or fs.exists(new_path(f"{path}/{n}/_SUCCESS")))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, oldest first."""
    return sorted(int(n[1:]) for n in _children(spark, path) if n.startswith("v") and n[1:].isdigit())


def loads(spark: SparkSession, path: str, version: int) -> list[str]:
    """Names of the complete loads added to a version."""
    head = f"v{version}-"
    return [n.removeprefix(head) for n in _children(spark, path) if n.startswith(head)]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version and the loads added to it."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version under {path}")
    whole = f"{path}/v{found[-1]}"
    return spark.read.parquet(whole, *(f"{whole}-{load}" for load in loads(spark, path, found[-1])))


def rows_digest(df: DataFrame) -> str:
    """A name for the rows of a table, whatever their order: their number and the sum of their hashes."""
    r = df.select(F.xxhash64(*df.columns).cast("decimal(38,0)").alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("s")).collect()[0]
    return f"{r['n']}-{int(r['s'] or 0) % 2**64:016x}"


def write_table(df: DataFrame, path: str, mode: str, load: str | None = None) -> None:
    """``full`` replaces the contents; ``incremental`` creates the table if absent and adds to its rows.

    An incremental load that is already there under its name changes nothing, so a job run again does not double rows.
    Without a name the load is known by its rows: loads that hold the very same rows and are meant to count twice need names.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if load is not None and not re.fullmatch(r"[A-Za-z0-9_.-]+", load):
        raise ValueError(f"a load's name has letters, digits, '_', '.' and '-' only, not {load!r}")
    spark = df.sparkSession
    found = versions(spark, path)
    if mode == "full":
        df.write.mode("overwrite").parquet(f"{path}/v{found[-1] + 1 if found else 1}")
        return
    version = found[-1] if found else 1
    if not found:
        df.limit(0).write.mode("overwrite").parquet(f"{path}/v1")
    load = load or rows_digest(df)
    if load not in loads(spark, path, version):
        df.write.mode("overwrite").parquet(f"{path}/v{version}-{load}")


def drop_old_versions(spark: SparkSession, path: str) -> list[str]:
    """Delete what no reader of a table or keyed table will open any more, and return the folders' names.

    For a quiet time: a reader that began before may still hold the old files.
    """
    fs, _ = _file_system(spark, path)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    found = versions(spark, path)
    old = [n for n in _children(spark, path) if found and n.startswith("v") and n[1:].partition("-")[0].isdigit() and int(n[1:].partition("-")[0]) < found[-1]]
    newest, _ = _bucket_dirs(spark, path)
    used = {folder.split("/")[-2] for folder in newest.values()}
    for name in _children(spark, path):
        if newest and name.startswith("k") and name[1:].partition("-")[0].isdigit():
            if name not in used:
                old.append(name)
            else:
                for bucket in _children(spark, f"{path}/{name}", success=False):
                    if bucket.startswith("bucket=") and newest.get(int(bucket[7:])) != f"{path}/{name}/{bucket}":
                        old.append(f"{name}/{bucket}")
    for name in old:
        fs.delete(new_path(f"{path}/{name}"), True)
    return old


def one_per_key(source: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """One row per key: the newest by ``version``; without it a repeated key fails the job, as in MERGE."""
    rest = F.struct(*[c for c in source.columns if c != key])
    if version is not None:
        picked = source.groupBy(key).agg(F.max_by(rest, F.col(version)).alias("row"))
    else:
        repeated = F.raise_error(F.concat(F.lit("more than one source row for key "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        counted = source.groupBy(key).agg(F.any_value(rest).alias("row"), F.count("*").alias("n"))
        picked = counted.select(key, F.when(F.col("n") > 1, repeated.cast(source.select(rest.alias("r")).schema["r"].dataType))
                                .otherwise(F.col("row")).alias("row"))
    return picked.select(*[F.col(key) if c == key else F.col("row")[c].alias(c) for c in source.columns])


def upsert(target: DataFrame, source: DataFrame, key: str, version: str | None = None) -> DataFrame:
    """Target rows without a source key, plus the source's row of each key."""
    return target.join(source.select(key), key, "left_anti").unionByName(one_per_key(source, key, version))


# A keyed table is cut into hash buckets of its key. A change writes a new version of
# the buckets it touches only; readers take the newest complete version of each bucket.


def _bucket_dirs(spark: SparkSession, path: str, buckets: int | None = None) -> tuple[dict[int, str], int]:
    """Newest folder per bucket, and the number of the last version."""
    complete = []
    for name in _children(spark, path):
        number, _, cut = name.removeprefix("k").partition("-")
        if name.startswith("k") and number.isdigit():
            if buckets is not None and int(cut) != buckets:
                raise ValueError(f"{path} has {cut} buckets, not {buckets}")
            complete.append((int(number), name))
    newest = {}
    for _, name in sorted(complete):
        for folder in _children(spark, f"{path}/{name}", success=False):
            if folder.startswith("bucket="):
                newest[int(folder.split("=")[1])] = f"{path}/{name}/{folder}"
    return newest, max((n for n, _ in complete), default=0)


def has_rows(spark: SparkSession, path: str) -> bool:
    return bool(_bucket_dirs(spark, path)[0])


def _bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _touched(keys: DataFrame, key: str, buckets: int) -> set[int]:
    """Bucket numbers of some keys: as many as there are buckets at most."""
    return {r["bucket"] for r in keys.select(_bucket_of(key, buckets).alias("bucket")).distinct().collect()}


def read_keyed(
    spark: SparkSession, path: str, keys: DataFrame | None = None, key: str | None = None, buckets: int = 64,
) -> DataFrame:
    """The table; with ``keys`` only the buckets that can hold them (all of one bucket, if none does)."""
    found, _ = _bucket_dirs(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version under {path}")
    chosen = sorted(found)
    if keys is not None:
        touched = _touched(keys, key, buckets)
        chosen = [b for b in chosen if b in touched] or chosen[:1]
    return spark.read.parquet(*[found[b] for b in chosen]).filter(LIVE).drop(LIVE)


def replace_rows(rows: DataFrame, keys: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Give each of ``keys`` the rows that ``rows`` holds for it in a keyed table; keys without any lose theirs.

    ``rows``, a written table, may hold several rows for a key, but no other keys. Choose ``buckets`` once, for the table's final
    size (thousands for many terabytes). A key that loses its rows leaves one mark, so that its bucket is not empty.
    """
    spark = rows.sparkSession
    found, last = _bucket_dirs(spark, path, buckets)
    keys = stage(keys.select(key).distinct(), "keys")
    gone = keys.join(rows.select(key).distinct(), key, "left_anti").withColumn(LIVE, F.lit(False))
    out = rows.withColumn(LIVE, F.lit(True)).unionByName(gone, allowMissingColumns=True)
    touched = _touched(keys, key, buckets)
    old = [found[b] for b in sorted(touched) if b in found]
    if old:
        kept = spark.read.parquet(*old).filter(LIVE).join(keys, key, "left_anti")
        out = kept.unionByName(out)
    (
        out.withColumn("bucket", _bucket_of(key, buckets)).hint("rebalance", "bucket")
        .write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/k{last + 1}-{buckets}")
    )


def upsert_table(source: DataFrame, path: str, key: str, buckets: int = 64, version: str | None = None) -> None:
    """Upsert into a keyed table.

    Of source rows with one key the newest by ``version`` counts; without it a repeated key fails.
    """
    rows = stage(one_per_key(source, key, version), "upsert")
    replace_rows(rows, rows, path, key, buckets)


def export_results_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays become comma-separated text."""
    flat = [
        F.array_join(F.col(f"`{f.name}`").cast("array<string>"), ", ").alias(f.name)
        if f.dataType.typeName() == "array" else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    df.select(flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


FOLDER_FILES = 1000


def export_texts(df: DataFrame, path: str, text: str, key: str, rows: int) -> None:
    """One text file for each row, in folders of about ``FOLDER_FILES`` files; ``rows`` is how many there are.

    All files of a folder come from one task, so that the end of the job moves folders into place and not one file after
    another, and readers list the folders side by side. In a mounted folder tasks write the files themselves: there Hadoop starts
    processes for the permissions of each file, and of the checksum file beside it, which takes many times as long as writing it.
    """
    spark = df.sparkSession
    folders = max(spark.sparkContext.defaultParallelism, -(-rows // FOLDER_FILES))
    fs, root = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        if fs.exists(root):
            raise FileExistsError(f"{path} exists")
        _write_texts(df.select(F.col(text).cast("binary").alias("text"), F.col(key).alias("key")).repartition(folders, "key").select("text"), path)
        return
    dealt = df.select(text, F.pmod(F.xxhash64(key), F.lit(folders)).alias("folder")).repartition(folders, "folder")
    dealt.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)


def _write_texts(texts: DataFrame, path: str) -> None:
    """Write each value and a newline to a file of a folder that all executors and the driver have mounted.

    Every attempt of a task has a folder of its own; those of the attempts that ended are moved into place at the end.
    """
    spark = texts.sparkSession
    fs, root = _file_system(spark, path)
    fs.mkdirs(root)
    new_path, local = spark._jvm.org.apache.hadoop.fs.Path, root.toUri().getPath()

    def write(batches):
        task, n = TaskContext.get().partitionId(), 0
        attempt = f"folder={task}-{uuid.uuid4().hex}"
        for batch in batches:
            for value in batch.column(0):
                if not n:
                    os.makedirs(f"{local}/_temporary/{attempt}")
                with open(f"{local}/_temporary/{attempt}/part-{task:05d}-{n:06d}.txt", "wb") as file:
                    file.write((value.as_py() or b"") + b"\n")
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    for row in texts.mapInArrow(write, "attempt string").collect():
        if not fs.rename(new_path(f"{path}/_temporary/{row['attempt']}"), new_path(f"{path}/{row['attempt'].partition('-')[0]}")):
            raise OSError(f"the driver cannot move {path}/_temporary/{row['attempt']}: do all executors share this folder?")
    fs.delete(new_path(f"{path}/_temporary"), True)
    fs.create(new_path(f"{path}/_SUCCESS")).close()


def export_analysis_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """One nested analysis object per ticket.

    Tickets share articles and history and every one repeats them whole, so ``gzip`` takes the files to a small part.
    """
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", compression).json(path)
