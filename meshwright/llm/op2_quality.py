"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document is sigmoid(w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); the pair term is
computed in linear time as half of (sum v_i x_i)^2 - sum (v_i x_i)^2 per factor.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import held_out_fold, table

BUCKETS, FACTORS = 1 << 15, 8
#: The fit uses at most so many labelled rows: those with the smallest hash of their id.
SAMPLE = 6000
FOLDS, HELD_OUT = 5, 0
#: Documents that score less are rejected.
THRESHOLD = 0.3
#: Statistics are one-hot in a range of their own behind the word buckets.
STATS, BINS = 14, 24
SIZE = BUCKETS + STATS * BINS

_UPPER, _LOWER, _DIGIT = bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58))
_SPACE, _HIGH = b" \t\n\r\x0b\x0c", bytes(range(128, 256))


def statistics(text: str, words: list[str], distinct: int, n_chars) -> list[int]:
    """Structure statistics and metadata of a document as feature numbers, one bin of each."""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    share = lambda kind: (len(raw) - len(raw.translate(None, kind))) / n
    part = lambda x: min(BINS - 1, int(math.sqrt(max(0.0, x)) * BINS))
    log = lambda x: min(BINS - 1, int(math.log2(1 + max(0, x))))
    lines = [x for x in text.split("\n") if x]
    known = n_chars is not None and n_chars == n_chars
    bins = [
        part(share(_UPPER)), part(share(_LOWER)), part(share(_DIGIT)), part(share(_SPACE)), part(share(_HIGH)), part(share(b"!?")), part(share(b"|<>{}[]=_/\\")), part(share(b"#$%&*@~^+")),
        part(1 - len(set(lines)) / max(1, len(lines))), part(1 - distinct / max(1, len(words))), min(BINS - 1, len(text) // max(1, len(words))), log(len(words)), log(len(lines)), log(n_chars) if known else BINS - 1,
    ]
    return [BUCKETS + i * BINS + b for i, b in enumerate(bins)]


class Features:
    """Feature numbers of whole texts: (word features, statistics); word values are 1/sqrt(count), statistics 1. A text of any length has at most BUCKETS word features."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str, n_chars) -> tuple[np.ndarray, list[int]]:
        words = text.lower().split()
        distinct = set(words)
        known = self.known
        if len(known) > 100_000:
            known.clear()
        out = np.empty(len(distinct), np.int32)
        for i, w in enumerate(distinct):
            h = known.get(w)
            if h is None:
                h = known[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS
            out[i] = h
        return np.unique(out), statistics(text, words, len(distinct), n_chars)


class FactorisationMachine:
    def __init__(self, size: int = SIZE, factors: int = FACTORS, seed: int = 7):
        self.w0 = 0.0
        self.w = np.zeros(size, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.01, (size, factors)).astype(np.float32)

    def raw(self, words: np.ndarray, stats: list[int]) -> float:
        c = 1 / math.sqrt(max(1, len(words)))
        vw, vs = self.v[words], self.v[stats]
        total = c * vw.sum(0) + vs.sum(0)
        squares = c * c * np.einsum("ij,ij->j", vw, vw) + np.einsum("ij,ij->j", vs, vs)
        return self.w0 + c * float(self.w[words].sum()) + float(self.w[stats].sum()) + 0.5 * float((total * total - squares).sum())

    def score(self, words: np.ndarray, stats: list[int]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.raw(words, stats)))))

    def fit(self, rows: list[tuple[np.ndarray, list[int]]], labels: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.08, decay: float = 1e-5, seed: int = 11) -> FactorisationMachine:
        """Adagrad on the logistic loss, in batches."""
        if not len(rows):
            return self
        mean = min(0.99, max(0.01, float(labels.mean())))
        self.w0 = math.log(mean / (1 - mean))
        sums = [np.full(len(self.w), 1e-4, np.float32), np.full(self.v.shape, 1e-4, np.float32)]
        rng = np.random.default_rng(seed)
        idx = [np.concatenate([a, np.array(s, np.int32)]) for a, s in rows]
        val = [np.concatenate([np.full(len(a), 1 / math.sqrt(max(1, len(a))), np.float32), np.ones(len(s), np.float32)]) for a, s in rows]
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                take = order[at : at + batch]
                i, x = np.concatenate([idx[k] for k in take]), np.concatenate([val[k] for k in take])
                n = np.array([len(idx[k]) for k in take])
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                vx = self.v[i] * x[:, None]
                total = np.add.reduceat(vx, first, 0)
                raw = self.w0 + np.add.reduceat(self.w[i] * x, first) + 0.5 * (total**2 - np.add.reduceat(vx * vx, first, 0)).sum(1)
                err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[take]).astype(np.float32) / len(take)
                self.w0 -= rate * float(err.sum())
                e = np.repeat(err, n) * x
                used, back = np.unique(i, return_inverse=True)
                gw = np.bincount(back, e, len(used)).astype(np.float32) + decay * self.w[used]
                gv = np.zeros((len(used), self.v.shape[1]), np.float32)
                np.add.at(gv, back, e[:, None] * (np.repeat(total, n, 0) - vx))
                gv += decay * self.v[used]
                sums[0][used] += gw * gw
                sums[1][used] += gv * gv
                self.w[used] -= rate * gw / np.sqrt(sums[0][used])
                self.v[used] -= 0.5 * rate * gv / np.sqrt(sums[1][used])
        return self


def inputs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    chars = F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), chars.alias("n_chars"))


def labelled_sample(labels: DataFrame, target, modulus: int, held_out: int, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, y) of at most ``sample`` labelled rows outside the held-out fold: a documented bound, by hash of the id."""
    y = labels.where(F.col("doc_id").isNotNull()).where(held_out_fold("doc_id", modulus) != held_out).groupBy("doc_id").agg(F.max(target).alias("y")).where("y is not null")
    return y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def sample_rows(docs: DataFrame, chosen: DataFrame) -> tuple[list[tuple[np.ndarray, list[int]]], list]:
    """Features and labels of the sampled documents; ``chosen`` has a bounded number of rows, so it is broadcast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Features()
        for batch in batches:
            got = [make(t, c) for t, c in zip(batch["text"], batch["n_chars"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "y": batch["y"], "words": [g[0] for g in got], "stats": [g[1] for g in got]})

    kind = chosen.schema["y"].dataType.simpleString()
    # an id counts once, however often its row is repeated
    rows = inputs(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "n_chars", "y")).alias("x")).select("doc_id", "x.*")
    found = rows.mapInPandas(run, f"doc_id long, y {kind}, words array<int>, stats array<int>").toPandas().sort_values("doc_id", kind="stable")
    return [(np.asarray(a, np.int32), list(b)) for a, b in zip(found["words"], found["stats"])], list(found["y"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> FactorisationMachine:
    rows, y = sample_rows(docs, labelled_sample(labels, F.col("quality").cast("int"), FOLDS, HELD_OUT, sample))
    return FactorisationMachine().fit(rows, np.array(y, np.float32))


def scorer(model: FactorisationMachine):
    """The model as a column function of (text, n_chars); null text counts as empty."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        make = Features()
        for texts, chars in batches:
            yield pd.Series([model.score(*make(t, c)) for t, c in zip(texts, chars)], dtype="float64")

    return F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)


def score(docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty, null n_chars as unknown; a null id has held_out null; repeated rows are scored as
    often as they occur; a very long text is read whole, and has no more features than BUCKETS and STATS; an empty table gives no rows; other columns are ignored. Without labels every score is that of the prior.
    """
    got = inputs(docs).select("doc_id", scorer(model)("text", "n_chars").alias("score"))
    return got.select("doc_id", (held_out_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: FactorisationMachine, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns."""
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.where(scorer(model)(F.coalesce(F.col("text").cast("string"), F.lit("")), chars) >= threshold)


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
