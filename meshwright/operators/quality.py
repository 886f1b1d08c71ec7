"""Quality of mapping sets: statistics, histograms, agreement with a gold standard, agreement between matchers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.vocab import KEY

#: Confidence bins, the last one closed.
BINS = ((0.0, 0.2, "0.0-0.2"), (0.2, 0.4, "0.2-0.4"), (0.4, 0.6, "0.4-0.6"), (0.6, 0.8, "0.6-0.8"), (0.8, 1.0, "0.8-1.0"))


def _in_bin(c, low: float, high: float):
    return (c >= low) & ((c <= high) if high == 1.0 else (c < high))


def metrics(fused: DataFrame) -> DataFrame:
    """One row of counts, means and ranges; zeros for an empty set."""
    zero = lambda c, name: F.coalesce(c, F.lit(0.0)).alias(name)
    return fused.agg(
        F.count("*").alias("total_mappings"), F.countDistinct("subject_id").alias("unique_subjects"), F.countDistinct("object_id").alias("unique_objects"),
        zero(F.avg("consensus_confidence"), "avg_confidence"), zero(F.min("consensus_confidence"), "min_confidence"), zero(F.max("consensus_confidence"), "max_confidence"),
        zero(F.avg("support_count"), "avg_support"), F.coalesce(F.min("support_count"), F.lit(0)).alias("min_support"), F.coalesce(F.max("support_count"), F.lit(0)).alias("max_support"),
    ).withColumn("coverage", F.col("total_mappings") / F.greatest(F.lit(1), F.col("unique_subjects")))


def confidence_histogram(fused: DataFrame, column: str = "consensus_confidence") -> DataFrame:
    """bin, n: all bins, empty ones with 0; values outside are in none."""
    counts = fused.agg(*[F.count_if(_in_bin(F.col(column), a, b)).alias(name) for a, b, name in BINS])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("bin"), F.col(f"`{name}`").alias("n")) for _, _, name in BINS])).alias("x")).select("x.bin", "x.n")


def support_histogram(fused: DataFrame) -> DataFrame:
    return fused.groupBy("support_count").agg(F.count("*").alias("n"))


def predicate_histogram(fused: DataFrame) -> DataFrame:
    return fused.groupBy("predicate_id").agg(F.count("*").alias("n"))


def precision_recall(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """One row: tp, fp, fn, precision, recall, f1 over distinct keys; 0 where a denominator is 0."""
    a = predicted.select(*KEY).distinct().withColumn("a", F.lit(True))
    b = gold.select(*KEY).distinct().withColumn("b", F.lit(True))
    n = a.join(b, KEY, "full").agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("tp"), F.count_if(F.col("b").isNull()).alias("fp"), F.count_if(F.col("a").isNull()).alias("fn"))
    ratio = lambda x, y: F.coalesce(F.try_divide(x, y), F.lit(0.0))
    n = n.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return n.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def true_positives(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Distinct keys of both."""
    return predicted.select(*KEY).distinct().join(gold.select(*KEY), KEY, "left_semi")


def false_positives(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    return predicted.select(*KEY).distinct().join(gold.select(*KEY), KEY, "left_anti")


def false_negatives(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    return false_positives(gold, predicted)


def agreement(fused: DataFrame) -> DataFrame:
    """m1, m2, both, either, jaccard of every pair of matchers, also of those that share nothing.

    Pairs come from a row's list of matchers and are counted before the shuffle: no self join of the mappings.
    """
    lists = fused.select(F.array_sort(F.array_distinct("supporting_matchers")).alias("ms"))
    single = lists.select(F.explode("ms").alias("m")).groupBy("m").agg(F.count("*").alias("n"))
    pairs = lists.select(F.explode("ms").alias("m1"), "ms").select("m1", F.explode(F.filter("ms", lambda m: m > F.col("m1"))).alias("m2")).groupBy("m1", "m2").agg(F.count("*").alias("both"))
    names = single.select(F.col("m").alias("m1"), F.col("n").alias("n1"))  # one row per matcher: a handful
    other = single.select(F.col("m").alias("m2"), F.col("n").alias("n2"))
    every = names.join(other, F.col("m1") < F.col("m2"))
    out = every.join(pairs, ["m1", "m2"], "left").withColumn("both", F.coalesce("both", F.lit(0)))
    out = out.withColumn("either", F.col("n1") + F.col("n2") - F.col("both"))
    return out.select("m1", "m2", "both", "either", (F.col("both") / F.col("either")).alias("jaccard"))


def matcher_precision(fused: DataFrame, gold: DataFrame) -> DataFrame:
    """matcher, n, precision against the gold keys."""
    keys = gold.select(*KEY).distinct().withColumn("hit", F.lit(1.0))
    rows = fused.select(*KEY, F.explode("supporting_matchers").alias("matcher")).join(keys, KEY, "left")
    return rows.groupBy("matcher").agg(F.count("*").alias("n"), F.avg(F.coalesce("hit", F.lit(0.0))).alias("precision"))


def suggest_weights(fused: DataFrame, gold: DataFrame | None = None) -> DataFrame:
    """matcher, score, weight: precision against gold, else the mean agreement with the others; weights add up to 1, all alike if every score is 0."""
    if gold is not None:
        scores = matcher_precision(fused, gold).select("matcher", F.col("precision").alias("score"))
    else:
        a = agreement(fused)
        sides = a.select(F.col("m1").alias("matcher"), "jaccard").unionByName(a.select(F.col("m2").alias("matcher"), "jaccard"))
        names = fused.select(F.explode("supporting_matchers").alias("matcher")).distinct()
        scores = names.join(sides.groupBy("matcher").agg(F.avg("jaccard").alias("score")), "matcher", "left").select("matcher", F.coalesce("score", F.lit(0.0)).alias("score"))
    total = scores.agg(F.sum("score").alias("total"), F.count("*").alias("k"))  # a single row
    return scores.join(F.broadcast(total)).select("matcher", "score", F.when(F.col("total") > 0, F.col("score") / F.col("total")).otherwise(1.0 / F.col("k")).alias("weight"))


def matcher_run_summary(runs: DataFrame) -> DataFrame:
    """``runs(name, success, execution_time)``: successes, total and longest time, and the speed-up of running side by side."""
    return runs.agg(F.count_if("success").alias("successful"), F.count("*").alias("runs"), F.sum("execution_time").alias("total_time"), F.max("execution_time").alias("longest_time"), F.coalesce(F.try_divide(F.sum("execution_time"), F.max("execution_time")), F.lit(0.0)).alias("speed_up"))


def quality_report(fused: DataFrame, strategy: str | None = None, first: int = 10) -> str:
    """A readable report; only histograms and the first conflicting subjects reach the driver."""
    from meshwright.operators.conflicts import conflicting_subjects

    m = metrics(fused).first()
    total = max(1, m["total_mappings"])
    lines = ["Mapping quality report", "=" * 40, "", "Overview", f"  Total mappings: {m['total_mappings']}", f"  Unique subjects: {m['unique_subjects']}", f"  Unique objects: {m['unique_objects']}", f"  Coverage: {m['coverage']:.2f}"]
    lines += [f"  Confidence: mean {m['avg_confidence']:.3f}, {m['min_confidence']:.3f} to {m['max_confidence']:.3f}", f"  Support: mean {m['avg_support']:.2f}, {m['min_support']} to {m['max_support']}"]
    for title, frame, key in (("Confidence distribution", confidence_histogram(fused).orderBy("bin"), "bin"), ("Support distribution", support_histogram(fused).orderBy("support_count"), "support_count"), ("Predicate distribution", predicate_histogram(fused).orderBy(F.desc("n"), "predicate_id"), "predicate_id")):
        lines += ["", title, *(f"  {r[key]}: {r['n']} ({100 * r['n'] / total:.1f}%)" for r in frame.toLocalIterator())]
    if strategy is not None:
        found = conflicting_subjects(fused)
        n = found.count()
        lines += ["", "Conflicts", f"  Subjects: {n}", f"  Resolution: {strategy}", *(f"  - {r['subject_id']}" for r in found.orderBy("subject_id").limit(first).collect())]
        lines += [f"  ... and {n - first} more"] if n > first else []
    return "\n".join(lines) + "\n"
