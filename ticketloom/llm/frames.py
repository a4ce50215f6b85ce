"""Staged tables and connected components for the operators of this package."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="modules-"), "ticketloom.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where it is unset, a local run gets one of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends, lost executors only repeat reads."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Alternates two steps until nothing changes: each node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. The number of edges never grows, rounds are about the
    logarithm of the longest path. Each round is staged. Hubs meet partial aggregates and joins whose
    skew Spark splits. Loops, repeats and nulls are ignored; no edges give an empty table.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = staged(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(max_rounds):
        # large: larger neighbours of a node move to its smallest neighbour or itself
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = staged(large, "edges")
        # small: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = staged(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        rest = small.join(small.select(F.col("u").alias("w")).distinct(), F.col("v") == F.col("w"), "left_semi")
        e = small
        if rest.isEmpty() and small.groupBy("u").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
