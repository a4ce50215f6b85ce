"""Ranks and pages over orders of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketloom.sources import sinks


def ranked(df: DataFrame, by: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """Add each row's rank, from 0, in its group.

    Rows are range partitioned by group and order; a row's rank is its place in its own range and the
    number of the group's rows in the ranges before. A group of any size is spread over ranges, and
    which ranges there are does not show in the result where the order has no ties.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in by]
    ranges = sinks.stage(df.repartitionByRange(parts, *keys, *order).withColumn("rank_part", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy("rank_part", *by).agg(F.count("*").alias("rank_n"))
    before = counts.withColumn("rank_before", F.sum("rank_n").over(Window.partitionBy(*by).orderBy("rank_part")) - F.col("rank_n"))
    slim = before.select(F.col("rank_part").alias("at"), *[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], "rank_before")
    same = F.col("rank_part") == F.col("at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"by_{i}"))
    own = F.row_number().over(Window.partitionBy("rank_part", *by).orderBy(*order)) - 1
    return ranges.withColumn("rank_own", own).join(slim, same).withColumn(out, F.col("rank_own") + F.col("rank_before")).select(*df.columns, out)


def paged(df: DataFrame, by: list[str], order: list[Column], page_rows: int, out: str = "page") -> DataFrame:
    """Add the page of each row, from 0: pages of a group hold ``page_rows`` rows each, in order, the last one the rest."""
    return ranked(df, by, order, "rank_all").withColumn(out, F.floor(F.col("rank_all") / page_rows)).drop("rank_all")
