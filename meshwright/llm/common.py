"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; set here only where it is unset and all run on one machine (tests)."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        known = tempfile.mkdtemp(prefix="meshwright-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(known)
    return known


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: pruned columns, no recomputation after a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out_fold(doc_id, modulus: int):
    """crc32 of the id's decimal text, modulo ``modulus`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus))


def let(value, body):
    """``body`` of the value, which is computed once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of the graph ``edges(u, v)``; component is the smallest node reachable.

    Alternating large-star and small-star steps: the minimum of each neighbourhood is a grouped
    aggregate (combined before the shuffle), joined back to the edges, so a hub's edges are never
    gathered in one row. The minima are checkpointed, so that both sides of a join are plain shuffles:
    only then can adaptive execution split a hub's partition. Each round ends with a checkpoint.
    """
    both = lambda e: e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    nodes = cut(both(e).select(F.col("u").alias("node")).distinct())
    state = None
    for _ in range(max_rounds):
        around = both(e)
        least = cut(around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = cut(around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # every edge now points to a smaller node
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not converge")
    return nodes.join(e.withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
