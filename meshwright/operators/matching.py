"""Matchers: from two graphs to a mapping table. The contract is that of external tools; these run on DataFrames."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.operators.fusion import concat
from meshwright.operators.triples import match
from meshwright.vocab import CLASS, DATATYPE_PROPERTY, LABEL, MAPPINGS, OBJECT_PROPERTY, RDFS_CLASS, TYPE

REGISTRY: dict[str, type[Matcher]] = {}


class Matcher:
    """``align(source, target)`` gives rows of the mapping schema with confidences from 0 to 1."""

    name = ""

    def __init_subclass__(cls, **kwargs) -> None:
        super().__init_subclass__(**kwargs)
        if cls.name:
            REGISTRY[cls.name.lower()] = cls

    def align(self, source: DataFrame, target: DataFrame) -> DataFrame:
        raise NotImplementedError

    def rows(self, pairs: DataFrame, predicate, why: str) -> DataFrame:
        order = F.pmod(F.xxhash64("subject_id", "object_id"), F.lit(1 << 62))
        return pairs.select("subject_id", "object_id", predicate.alias("predicate_id"), F.col("score").cast("double").alias("confidence"), F.lit(self.name).alias("matcher_name"), F.lit(why).alias("mapping_justification"), order.alias("ord"))


def terms(g: DataFrame) -> DataFrame:
    """id, kind, label (normalised): declared classes and properties; without a label by local name, words split at case and punctuation."""
    kinds = F.when(F.col("o").isin(CLASS, RDFS_CLASS), "class").when(F.col("o").isin(OBJECT_PROPERTY, DATATYPE_PROPERTY), "property")
    typed = match(g, p=TYPE).select(F.col("s").alias("id"), kinds.alias("kind")).where("kind is not null").distinct()
    labels = match(g, p=LABEL).groupBy(F.col("s").alias("id")).agg(F.min("o").alias("label"))
    local = F.regexp_extract("id", r"([^/#]*)$", 1)
    words = F.regexp_replace(F.coalesce("label", local), r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return typed.join(labels, "id", "left").select("id", "kind", F.trim(F.regexp_replace(F.lower(words), r"[^\p{L}\p{N}]+", " ")).alias("label")).where("label <> ''")


def _sides(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    a = terms(source).select(F.col("id").alias("subject_id"), "kind", F.col("label").alias("a"))
    b = terms(target).select(F.col("id").alias("object_id"), "kind", F.col("label").alias("b"))
    return a, b


def let(value, body):
    """``body`` of the value, which is computed once, also where ``body`` uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class LexicalExact(Matcher):
    name = "LexicalExact"

    def align(self, source: DataFrame, target: DataFrame) -> DataFrame:
        a, b = _sides(source, target)
        pairs = a.withColumnRenamed("a", "label").join(b.withColumnRenamed("b", "label"), ["kind", "label"]).withColumn("score", F.lit(1.0))
        return self.rows(pairs, F.lit("skos:exactMatch"), "equal labels")


def _rare_first(a: DataFrame, b: DataFrame, tokens) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``w``: their distinct tokens, those that occur in the fewest labels of their kind first. Frequencies are a grouped count, joined back to the tokens."""
    split = lambda df, ident, text: df.select(F.col(ident).alias("id"), "kind", F.explode(tokens(F.col(text))).alias("token"))
    left, right = split(a, "subject_id", "a"), split(b, "object_id", "b")
    seen = left.unionByName(right).groupBy("kind", "token").agg(F.count("*").alias("n"))

    def ordered(rows: DataFrame, df: DataFrame, ident: str) -> DataFrame:
        found = rows.join(seen, ["kind", "token"]).groupBy("id", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "token"))), lambda x: x["token"]).alias("w"))
        return df.join(found.withColumnRenamed("id", ident), [ident, "kind"])

    return ordered(left, a, "subject_id"), ordered(right, b, "object_id")


class TokenJaccard(Matcher):
    """Labels that share words. Two labels of m and s words reach the threshold only with o common words, so they share one of the m - o + 1 rarest of
    the one and of the s - o + 1 rarest of the other: candidates come from a join on those and on both sizes, never from a common word alone."""

    name = "TokenJaccard"

    def __init__(self, threshold: float = 0.5):
        self.threshold = threshold

    def align(self, source: DataFrame, target: DataFrame) -> DataFrame:
        t = F.lit(self.threshold)
        a, b = _rare_first(*_sides(source, target), lambda c: F.array_distinct(F.split(c, " ")))

        def keys(df: DataFrame, mine: str, other: str) -> DataFrame:
            size = F.size("w")
            sizes = F.sequence(F.greatest(F.lit(1), F.ceil(t * size - 1e-9).cast("int")), F.floor(size / t + 1e-9).cast("int"))
            df = df.withColumn(mine, size).withColumn(other, F.explode(sizes))
            common = F.ceil(t / (1 + t) * (F.col(mine) + F.col(other)) - 1e-9).cast("int")
            return df.withColumn("token", F.explode(F.slice("w", F.lit(1), F.greatest(F.lit(0), F.col(mine) - common + 1))))

        left = keys(a, "m", "s").select("kind", "token", "m", "s", "subject_id", F.col("w").alias("x"))
        right = keys(b, "s", "m").select("kind", "token", "m", "s", "object_id", F.col("w").alias("y"))
        cand = left.join(right, ["kind", "token", "m", "s"]).select("subject_id", "object_id", "x", "y").distinct()
        both = F.size(F.array_intersect("x", "y"))
        pairs = cand.withColumn("score", both / (F.size("x") + F.size("y") - both)).where(F.col("score") >= self.threshold)
        return self.rows(pairs, F.when(F.col("score") >= 1.0, "skos:exactMatch").otherwise("skos:closeMatch"), "shared words")


class EditDistance(Matcher):
    """Labels whose edit distance is at most a share of the longer one's length.

    An edit changes at most q of a label's q-grams (which are numbered when they repeat), so labels within k edits share one of the kq + 1 rarest of
    each: candidates come from a join on those, complete for every threshold: q is 2 where that many edits leave a common pair of letters, else 1.
    """

    name = "EditDistance"

    def __init__(self, threshold: float = 0.8):
        if not 0 < threshold <= 1:
            raise ValueError("the threshold must be above 0 and at most 1")
        self.threshold, self.q = threshold, 2 if threshold >= 2 / 3 else 1

    def grams(self, c):
        whole = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - self.q + 1)), lambda i: F.substr(c, i, F.lit(self.q)))
        return let(whole, lambda g: F.transform(g, lambda x, i: F.concat(x, F.lit("#"), F.size(F.filter(F.slice(g, F.lit(1), i), lambda y: y == x)).cast("string"))))

    def align(self, source: DataFrame, target: DataFrame) -> DataFrame:
        a, b = _rare_first(*_sides(source, target), self.grams)
        # edits that a partner of any allowed length may have
        edits = lambda c: F.floor((1 - self.threshold) / self.threshold * F.length(c) + 1e-9).cast("int")
        keys = lambda df, c: df.withColumn("g", F.explode(F.slice("w", F.lit(1), edits(F.col(c)) * self.q + 1)))
        longer = F.greatest(F.length("a"), F.length("b"))
        close = F.abs(F.length("a") - F.length("b")) <= (1 - self.threshold) * longer + 1e-9
        cand = keys(a, "a").drop("w").join(keys(b, "b").drop("w"), ["kind", "g"]).where(close).select("subject_id", "object_id", "a", "b").distinct()
        pairs = cand.withColumn("score", 1 - F.levenshtein("a", "b") / longer).where(F.col("score") >= self.threshold - 1e-9)
        return self.rows(pairs, F.when(F.col("score") >= 1.0, "skos:exactMatch").otherwise("skos:closeMatch"), "edit distance")


#: Names of external tools that manifests use; the matchers here that stand in for them.
STAND_INS = {"logmap": "lexicalexact", "aml": "tokenjaccard", "bertmap": "editdistance"}


def selected(names: list[str]) -> tuple[list[Matcher], list[str]]:
    """(matchers by name, each once; names that aren't known)."""
    asked = [STAND_INS.get(n.lower(), n.lower()) for n in names]
    return [REGISTRY[n]() for n in dict.fromkeys(asked) if n in REGISTRY], [n for n, a in zip(names, asked) if a not in REGISTRY]


@dataclass(frozen=True)
class MatcherResult:
    matcher_name: str
    mappings: DataFrame | None
    success: bool
    execution_time: float
    error: str | None = None


def run_alignment(source: DataFrame, target: DataFrame, matchers: list[Matcher]) -> list[DataFrame]:
    """One after the other; a failure is raised."""
    return [m.align(source, target) for m in matchers]


def run_alignment_parallel(source: DataFrame, target: DataFrame, matchers: list[Matcher], keep: Callable[[str, DataFrame], DataFrame] | None = None, timeout: float = 300.0) -> list[MatcherResult]:
    """Jobs side by side; a failure or a timeout becomes a result, and a timed-out job is cancelled. ``keep`` stores a table and returns it reread."""
    context = source.sparkSession.sparkContext

    def one(m: Matcher) -> MatcherResult:
        began, group = time.monotonic(), f"align-{m.name}-{id(m)}"
        context.setJobGroup(group, f"matcher {m.name}", interruptOnCancel=True)
        try:
            got = m.align(source, target)
            got = keep(m.name, got) if keep else got.checkpoint(eager=True) if context.getCheckpointDir() else got
            return MatcherResult(m.name, got, True, time.monotonic() - began)
        except Exception as e:  # noqa: BLE001
            return MatcherResult(m.name, None, False, time.monotonic() - began, str(e))

    with ThreadPoolExecutor(max(1, len(matchers))) as pool:
        jobs = [(m, pool.submit(one, m)) for m in matchers]
        out, began = [], time.monotonic()
        for m, job in jobs:
            try:
                out.append(job.result(timeout=max(0.0, timeout - (time.monotonic() - began))))
            except TimeoutError:
                context.cancelJobGroup(f"align-{m.name}-{id(m)}")
                out.append(MatcherResult(m.name, None, False, timeout, "timed out"))
    return out


def all_mappings(results: list[MatcherResult]) -> DataFrame | None:
    good = [r.mappings for r in results if r.success]
    return concat(*good) if good else None


def empty_mappings(spark) -> DataFrame:
    return spark.createDataFrame([], MAPPINGS)
