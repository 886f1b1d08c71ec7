"""Ranks over whole tables without a single task: a distributed sort, and the rows of earlier partitions added up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.operators.reasoning import cut


def ranked(df: DataFrame, *order, name: str = "rank") -> DataFrame:
    """``df`` with the rows' places from 1 in ``order`` (which should leave no ties). What is added up is a row per partition."""
    rows = cut(df.orderBy(*order).withColumn("_pid", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    part = rows.groupBy("_pid").agg(F.min("_row").alias("_lo"), F.count("*").alias("_n"))
    before = part.select(F.col("_pid").alias("_p"), F.col("_n").alias("_m"))
    part = part.join(before, F.col("_p") < F.col("_pid"), "left").groupBy("_pid", "_lo").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(part), "_pid").withColumn(name, F.col("_row") - F.col("_lo") + F.col("_before") + 1).drop("_pid", "_row", "_lo", "_before")


def top(df: DataFrame, n: int, *order, name: str = "rank") -> DataFrame:
    """The first ``n`` rows in ``order`` with their places: a report's list, so ``n`` is small."""
    return ranked(df.orderBy(*order).limit(n), *order, name=name)
