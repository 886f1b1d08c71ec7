"""Fusion of mapping tables: one row per (subject, object, predicate) with the view of every matcher."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meshwright.vocab import KEY

#: Summation follows the matchers' first appearance, so a mean doesn't depend on the order of a shuffle.
_SUM = lambda xs: F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["c"])


def concat(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def partial(mappings: DataFrame, min_confidence: float = 0.0) -> DataFrame:
    """One row per key and matcher: c (its largest confidence, at least 0), o (its first row), js (its distinct justifications with their rows).

    A matcher states a key a few times, so the list is short; it is combined before the shuffle.
    """
    note = F.col("mapping_justification") if "mapping_justification" in mappings.columns else F.lit(None).cast("string")
    said = F.when(note.isNotNull() & (note != ""), F.struct(F.col("ord").alias("o"), note.alias("j")))
    return mappings.where(F.col("confidence") >= min_confidence).groupBy(*KEY, "matcher_name").agg(F.greatest(F.lit(0.0), F.max("confidence")).alias("c"), F.min("ord").alias("o"), F.collect_list(said).alias("js"))


def merge(partials: DataFrame) -> DataFrame:
    """Partial rows of several batches as those of all; the same batch merged twice changes nothing."""
    return partials.groupBy(*KEY, "matcher_name").agg(F.max("c").alias("c"), F.min("o").alias("o"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("js")))).alias("js"))


def finish(partials: DataFrame) -> DataFrame:
    """Fused rows of partial ones: at most one per matcher meets in a key."""
    grouped = partials.groupBy(*KEY).agg(F.array_sort(F.collect_list(F.struct("o", F.col("matcher_name").alias("m"), "c"))).alias("xs"), F.array_sort(F.flatten(F.collect_list("js"))).alias("js"), F.min("o").alias("ord"))
    return grouped.select(
        *KEY,
        F.map_from_entries(F.transform("xs", lambda x: F.struct(x["m"], x["c"]))).alias("confidences"),
        F.transform("xs", lambda x: x["m"]).alias("supporting_matchers"),
        F.size("xs").alias("support_count"),
        (_SUM(F.col("xs")) / F.size("xs")).alias("consensus_confidence"),
        F.when(F.size("js") > 0, F.array_join(F.transform("js", lambda x: x["j"]), "; ")).alias("mapping_justification"),
        "ord",
    )


def fuse(mappings: DataFrame, min_confidence: float = 0.0, min_support: int = 1) -> DataFrame:
    """Fuse rows of several matchers.

    A matcher's confidence in a key is the largest of its rows (at least 0); the consensus is the mean over matchers. Matchers
    are listed by first appearance (``ord``); justifications of all rows are joined in that order, null if there is none.
    """
    fused = finish(partial(mappings, min_confidence))
    return filter_by_support(fused, min_support) if min_support > 1 else fused


def filter_by_support(fused: DataFrame, min_support: int = 2) -> DataFrame:
    return fused.where(F.col("support_count") >= min_support)


def filter_by_consensus(fused: DataFrame, min_confidence: float = 0.5) -> DataFrame:
    return fused.where(F.col("consensus_confidence") >= min_confidence)


def combine(mappings: DataFrame, how: str = "union", matchers: int | None = None, weights: dict[str, float] | None = None) -> DataFrame:
    """Simple combinations on (subject, object): ``union`` keeps the best row (of equal ones the first), ``intersection`` those that all matchers share, ``weighted`` the weighted mean."""
    g = mappings.groupBy("subject_id", "object_id")
    if how == "union":
        return g.agg(F.min(F.struct((-F.col("confidence")).alias("c"), "ord", "predicate_id")).alias("x")).select("subject_id", "object_id", F.col("x.predicate_id").alias("predicate_id"), (-F.col("x.c")).alias("confidence"))
    if how == "intersection":
        if matchers is None:
            raise ValueError("intersection needs the number of matchers")
        return g.agg(F.countDistinct("matcher_name").alias("n"), F.avg("confidence").alias("confidence")).where(F.col("n") >= matchers).drop("n")
    if how == "weighted":
        w = weight_of(F.col("matcher_name"), weights or {})
        return g.agg(F.try_divide(F.sum(F.col("confidence") * w), F.sum(w)).alias("confidence"))
    raise ValueError(f"unknown combination: {how}")


def weight_of(matcher: Column, weights: dict[str, float]) -> Column:
    """A matcher's weight, 0 if it has none."""
    if not weights:
        return F.lit(0.0)
    table = F.create_map(*[x for k, v in sorted(weights.items()) for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(table[matcher], F.lit(0.0))
