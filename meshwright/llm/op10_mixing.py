"""Mixing to target weights with soft memberships.

A classifier fitted on the labelled table gives every document posteriors over domains. Nonnegative document rates r
minimise the squared difference between the expected domain totals, sum r_d tokens_d p_dk, and the targets, by projected gradient
descent from r = 1: a step adds p_d . y to every rate and clips at zero. The totals of a step are one distributed aggregate; only
vectors with one number per domain reach the driver. Distances are scaled by the inverse of sum tokens p p^T, for which a unit step descends.
If the totals still differ after STEPS such steps, or these get hardly smaller, implicit steps follow (the gradient is taken where the step ends, which Newton's method finds
from the same kind of sums), each longer than the last, until a dual bound proves that the totals are within GAP of the least-squares ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import table, written
from meshwright.llm.op2_quality import SIZE, Features, labelled_sample, sample_rows

#: Domains: the label pairs (quality, toxic), and the share of the tokens that each is to have.
DOMAINS = ("low_clean", "low_toxic", "high_clean", "high_toxic")
TARGET = {"low_clean": 0.04, "low_toxic": 0.0, "high_clean": 0.95, "high_toxic": 0.01}
#: Targets are shares of the table's tokens times this.
VOLUME = 1.0
SAMPLE = 6000
STEPS, TOLERANCE = 25, 1e-6
#: Plain steps end early if so many of them haven't halved the step.
STALL = 4
#: Largest distance of the domain totals from the least-squares optimum's, as a share of the tokens.
GAP = 1e-3


class Softmax:
    """Multinomial logistic regression over hashed words and statistics."""

    def __init__(self, classes: int):
        self.w, self.b = np.zeros((SIZE, classes), np.float32), np.zeros(classes, np.float32)

    def fit(self, rows: list, y: np.ndarray, epochs: int = 10, batch: int = 64, rate: float = 0.15, seed: int = 23) -> Softmax:
        if not len(rows):
            return self
        share = np.bincount(y, minlength=len(self.b)) + 0.5
        self.b = np.log(share / share.sum()).astype(np.float32)
        total, rng = np.full(self.w.shape, 1e-4, np.float32), np.random.default_rng(seed)
        idx = [np.concatenate([a, np.array(s, np.int32)]) for a, s in rows]
        val = [np.concatenate([np.full(len(a), 1 / math.sqrt(max(1, len(a))), np.float32), np.ones(len(s), np.float32)]) for a, s in rows]
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                take = order[at : at + batch]
                i, x = np.concatenate([idx[k] for k in take]), np.concatenate([val[k] for k in take])
                n = np.array([len(idx[k]) for k in take])
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                p = softmax(self.b + np.add.reduceat(self.w[i] * x[:, None], first, 0))
                p[np.arange(len(take)), y[take]] -= 1
                used, back = np.unique(i, return_inverse=True)
                g = np.zeros((len(used), len(self.b)), np.float32)
                np.add.at(g, back, np.repeat(p / len(take), n, 0) * x[:, None])
                total[used] += g * g
                self.w[used] -= rate * g / np.sqrt(total[used])
        return self

    def raw(self, words: np.ndarray, stats: list[int]) -> np.ndarray:
        return self.b + self.w[words].sum(0) / math.sqrt(max(1, len(words))) + self.w[stats].sum(0)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Softmax:
    pair = F.col("quality").cast("int") * 2 + F.col("toxic").cast("int")
    labels = labels.where(F.col("quality").cast("int").isin(0, 1) & F.col("toxic").cast("int").isin(0, 1))
    rows, y = sample_rows(docs, labelled_sample(labels, pair, 1, -1, sample))
    return Softmax(len(DOMAINS)).fit(rows, np.array(y, np.int64))


def posteriors(docs: DataFrame, model: Softmax, carry: list[str] | None = None) -> DataFrame:
    """doc_id, tokens (words), p (array of domain posteriors) and the columns named in ``carry`` for every row, from whole texts."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        make = Features()
        for texts, chars in batches:
            raw = [model.raw(*make(t, c)) for t, c in zip(texts, chars)]
            p = pd.Series([x.tolist() for x in softmax(np.array(raw, np.float64))] if raw else [], dtype=object)
            # words as split at ASCII white space
            yield pd.DataFrame({"p": p, "tokens": pd.Series([len(t.encode("utf-8", "surrogatepass").split()) for t in texts], dtype="int64")})

    udf = F.pandas_udf(run, "p array<double>, tokens long", F.PandasUDFType.SCALAR_ITER)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    carry = carry or []
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, udf(text, chars).alias("_scored"))
    return got.select("doc_id", *carry, F.col("_scored.tokens").alias("tokens"), F.col("_scored.p").alias("p"))


def rate(history: list[np.ndarray], p="p", floor=None):
    """The rate after the steps in ``history``: each adds -p.y, then clips at ``floor`` (a column, zero by default)."""
    r, floor = F.lit(1.0), F.lit(0.0) if floor is None else floor
    if history:
        steps = F.array(*[F.array(*[F.lit(float(y)) for y in step]) for step in history])
        move = lambda s: F.aggregate(F.zip_with(F.col(p), s, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        r = F.aggregate(steps, r, lambda acc, s: F.greatest(floor, acc - move(s)))
    return r


def implicit_steps(table_: DataFrame, goal: np.ndarray, gap: float = GAP, most: int = 20) -> list[np.ndarray]:
    """Steps that bring the totals within ``gap`` of the least-squares ones; ``table_`` has p, r, floor (at most r) and share (of all tokens), ``goal`` shares.

    A step y = (totals after it - goal) / e minimises the convex d(y) = sum share h(r - p.y) + e y.y / 2 + goal.y, where h' clips at the floor.
    For any v, |g - z|^2 / 2 >= v.g - v.v / 2 - v.z holds for all totals z in reach; v = -e y gives a bound on how far the optimum is.
    """
    k = len(goal)
    dot = lambda y: sum((F.get("p", F.lit(i)) * F.lit(float(v)) for i, v in enumerate(y)), F.lit(0.0))
    least = np.array(table_.agg(*[F.sum(F.col("floor") * F.col("share") * F.get("p", F.lit(i))) for i in range(k)]).first(), float)

    def sums(df: DataFrame, y: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """d without its last two terms, the largest p.(-y), the totals and the sum of share p p^T over the rows above their floor."""
        u, low = F.col("u"), F.col("floor")
        df = df.where("share > 0").select("p", "share", "floor", dot(y).alias("m"), (F.col("r") - dot(y)).alias("u"))
        part = F.when(u > low, u * u / 2).otherwise(low * u - low * low / 2)
        cells = [F.sum(F.when(u > low, F.col("share") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))).otherwise(0.0)) for i in range(k) for j in range(i, k)]
        got = df.agg(F.sum(F.col("share") * part), F.max(-F.col("m")), *[F.sum(F.col("share") * F.greatest(u, low) * F.get("p", F.lit(i))) for i in range(k)], *cells).first()
        h = np.zeros((k, k))
        h[np.triu_indices(k)] = got[2 + k :]
        return got[0], got[1], np.array(got[2 : 2 + k], float), np.triu(h) + np.triu(h, 1).T

    steps: list[np.ndarray] = []
    e, df = 1e-2, table_
    for _ in range(most):
        y = trial = move = np.zeros(k)
        best, far = None, math.inf
        for _ in range(80):
            part, top, z, h = sums(df, trial)
            d = part + e * trial @ trial / 2 + goal @ trial
            if best is not None and d > best + 1e-12 * (1 + abs(best)):
                move = move / 2
                if np.abs(move).max() <= 1e-12 * (1 + np.abs(y).max()):
                    break
                trial = y - move
                continue
            y, best, v = trial, d, -e * trial
            # totals in reach are the floors' and a nonnegative sum of posteriors, which is no longer than the goal is far from the floors'
            reach = v @ least + max(0.0, e * top) * math.sqrt(k) * np.linalg.norm(goal - least)
            far = math.sqrt(max(0.0, (goal - z) @ (goal - z) - 2 * (v @ goal - v @ v / 2 - reach)))
            gradient = goal + e * y - z
            if far <= gap or np.abs(gradient).max() <= 1e-3 * gap:
                break
            move = np.linalg.solve(h + e * np.eye(k), gradient)
            trial = y - move
        steps.append(y)
        if far <= gap:
            return steps
        df = df.withColumn("r", F.greatest(F.col("floor"), F.col("r") - dot(y)))
        e = max(e / 100, 1e-12)
    raise RuntimeError(f"rates did not converge: domain totals may be {far:.2g} of the tokens from the least-squares ones, {gap:.2g} is allowed")


def fit_rates(table_: DataFrame, target: dict[str, float] | None = None, volume: float = VOLUME, steps: int = STEPS, tolerance: float = TOLERANCE, floor=None, gap: float = GAP) -> list[np.ndarray]:
    """The steps of the descent (one vector of domains each); ``table_`` has tokens and p. No rate falls below ``floor`` (a column of numbers from 0 to 1).

    Steps end when they are at most ``tolerance``, or the totals provably within ``gap`` of the least-squares ones; if neither is reached, it is an error.
    """
    target = target or TARGET
    k = len(DOMAINS)
    cells = [F.sum(F.col("tokens") * F.get("p", F.lit(i)) * F.get("p", F.lit(j))).alias(f"a{i}_{j}") for i in range(k) for j in range(i, k)]
    first = table_.agg(F.sum("tokens").alias("t"), *cells).first()
    if not first["t"]:
        return []
    a = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            a[i, j] = a[j, i] = first[f"a{i}_{j}"]
    goal = np.array([target[d] for d in DOMAINS]) * volume * first["t"]
    scale = np.linalg.pinv(a + 1e-9 * np.trace(a) * np.eye(k))
    history: list[np.ndarray] = []
    sizes: list[float] = []
    for _ in range(steps):
        got = table_.select("tokens", "p", rate(history, floor=floor).alias("r")).agg(*[F.sum(F.col("r") * F.col("tokens") * F.get("p", F.lit(i))) for i in range(k)]).first()
        step = scale @ (np.array(got, float) - goal)
        sizes.append(float(np.abs(step).max()))
        if sizes[-1] <= tolerance:
            return history
        if len(sizes) > STALL and sizes[-1] > sizes[-1 - STALL] / 2:
            break
        history.append(step)
    low = (F.lit(0.0) if floor is None else floor).cast("double")
    rest = written(table_.select("p", rate(history, floor=floor).alias("r"), low.alias("floor"), (F.col("tokens") / F.lit(float(first["t"]))).alias("share")), "rates")
    return history + implicit_steps(rest, goal / first["t"], gap)


def mix(docs: DataFrame, labels: DataFrame, target: dict[str, float] | None = None, volume: float = VOLUME) -> DataFrame:
    """One row per document: doc_id, tokens, p (domain posteriors), rate (nonnegative).

    Tokens are words here, not the ids of a tokenizer. Null text counts as empty (no tokens: it has a rate but no weight); labels that are null or neither 0 nor 1 are
    left out of the fit; a null id is kept; repeated rows have equal rates; a very long text counts in full; an empty table gives no rows; other columns are ignored.
    """
    got = written(posteriors(docs, fit(docs, labels)), "posteriors")
    return got.withColumn("rate", rate(fit_rates(got, target, volume)))


def copies(rate_col, id_col, *more):
    """Times that a document is taken: its rate's whole part, and one more with the rest's probability, by the hash of the id and of ``more`` (what tells rows without an id apart)."""
    u = F.pmod(F.xxhash64(F.lit("mix"), id_col, *more), F.lit(1 << 30)) / float(1 << 30)
    return F.floor(rate_col + u).cast("int")


def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select("doc_id", "tokens", *[F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", copies(F.col("rate"), F.col("doc_id"), F.col("p")).alias("copies"))
