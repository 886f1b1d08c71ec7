"""Conflicts: subjects with more than one distinct object, and their resolution in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.functions.terms import predicate_rank

STRATEGIES = ("confidence", "support", "specificity", "keep_all")


@dataclass(frozen=True)
class ConflictReport:
    conflicts: DataFrame
    resolved: DataFrame
    strategy: str


def conflicting_subjects(fused: DataFrame) -> DataFrame:
    """subject_id, n_objects of subjects with several objects; smallest and largest differ, so no set is gathered to find them."""
    return fused.groupBy("subject_id").agg(F.countDistinct("object_id").alias("n_objects")).where("n_objects > 1")


def order(strategy: str) -> list[Column]:
    """Sort values of a mapping, the best one smallest; ties go to the first in input order. Unknown strategies count as ``confidence``."""
    confidence = (-F.col("consensus_confidence")).alias("c")
    first = {"support": [(-F.col("support_count")).alias("f")], "specificity": [(-predicate_rank(F.col("predicate_id"))).alias("f")]}.get(strategy, [])
    return [*first, confidence, F.col("ord"), F.col("object_id"), F.col("predicate_id")]


def resolve(fused: DataFrame, strategy: str = "confidence") -> DataFrame:
    """Mappings without conflict, and the winner of each conflicting subject (all of them for ``keep_all``), with a column ``conflict``.

    Flag and winner of a subject are one aggregate that combines before its shuffle, joined back: a subject with very many
    mappings is neither sorted nor gathered in one task, and its part of the join can be split.
    """
    best = F.min(F.struct(*order(strategy)))
    subjects = fused.groupBy("subject_id").agg(F.coalesce(F.min("object_id") != F.max("object_id"), F.lit(False)).alias("conflict"), best.alias("best"))
    # a null subject groups with itself
    rows = fused.alias("f").join(subjects.alias("s"), F.col("f.subject_id").eqNullSafe(F.col("s.subject_id"))).select("f.*", "conflict", "best")
    if strategy == "keep_all":
        return rows.drop("best")
    won = F.col("ord").eqNullSafe(F.col("best.ord")) & F.col("object_id").eqNullSafe(F.col("best.object_id")) & F.col("predicate_id").eqNullSafe(F.col("best.predicate_id"))
    return rows.where(~F.col("conflict") | won).drop("best")


def report(fused: DataFrame, strategy: str = "confidence") -> ConflictReport:
    return ConflictReport(conflicting_subjects(fused).orderBy("subject_id"), resolve(fused, strategy).orderBy("conflict", "ord").drop("conflict"), strategy)
