"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word's input is the sum of a word embedding and of embeddings of all of its character n-grams, both hashed; a run of letters longer than a
word is read as overlapping pieces, each a word of its own, so that no character is left out. A document is cut into overlapping windows that cover every word; each window is read by a forward and a backward
recurrent layer, pooled by attention and scored. The document's score is that of its highest window.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import held_out_fold, table

WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS = 1 << 13, 1 << 13
#: Longest word; longer runs are cut into pieces of so many characters that overlap by half. GRAMS: n-grams of the longest word.
LONGEST, GRAMS = 20, 24
DIM, HIDDEN = 12, 8
FOLDS, HELD_OUT = 3, 1
#: The fit uses at most so many labelled rows of each class: those with the smallest hash of their id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 1500, 3000
#: ... and of each at most so many windows, spread evenly over the text: what reaches the driver is bounded. Scoring has no such bound.
SAMPLE_WINDOWS = 64
_WORD = re.compile(r"[^\W_]+")


def pieces(run: str) -> list[str]:
    half = LONGEST // 2
    return [run] if len(run) <= LONGEST else [run[i : i + LONGEST] for i in range(0, len(run) - half, half)]


def words_of(text: str) -> list[str]:
    found = _WORD.findall(text.lower())
    return found if max(map(len, found), default=0) <= LONGEST else [p for w in found for p in pieces(w)]


def strips(text: str, size: int) -> Iterator[list[str]]:
    """A long text's words, ``size`` and half a window at a time: its windows are those of the strips."""
    held: list[str] = []
    for w in _WORD.finditer(text.lower()):
        held += pieces(w[0])
        while len(held) >= size + 2 * WINDOW:
            yield held[: size + STRIDE]
            held = held[size:]
    yield held


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word bucket, n-gram buckets padded with -1) of distinct words: all trigrams, and the prefix and suffix of 4 and 5."""
    h = lambda x: zlib.crc32(x.encode("utf-8", "surrogatepass"))
    a, b = np.empty(len(words), np.int32), np.full((len(words), GRAMS), -1, np.int32)
    for i, w in enumerate(words):
        raw = f"<{w}>"
        a[i] = h(w) % WORD_BUCKETS
        grams = [raw[:5], raw[:6], raw[-5:], raw[-6:], *(raw[k : k + 3] for k in range(len(raw) - 2))]
        b[i, : len(grams)] = [h(g) % GRAM_BUCKETS for g in grams]
    return a, b


def window_starts(n: int) -> list[int]:
    """Starts of windows that overlap by half and cover all of ``n`` words; the last one ends with the text."""
    return [*range(0, max(1, n - WINDOW), STRIDE), n - WINDOW] if n > WINDOW else [0]


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class BiGru:
    """Parameters: Ew, Eg (embeddings); per direction d: Wd, bd (input), Ud (recurrent); q (attention); o, c (output)."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        n = lambda *s: rng.normal(0, 0.25, s).astype(np.float32)
        self.p = {"Ew": n(WORD_BUCKETS, DIM) * 0.4, "Eg": n(GRAM_BUCKETS, DIM) * 0.4, "q": n(2 * HIDDEN), "o": n(2 * HIDDEN), "c": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"W{d}": n(DIM, 3 * HIDDEN), f"b{d}": np.zeros(3 * HIDDEN, np.float32), f"U{d}": n(HIDDEN, 3 * HIDDEN)}

    def embed(self, word: np.ndarray, grams: np.ndarray) -> np.ndarray:
        if len(word) > 4096:  # n-grams take much more room than words
            return np.concatenate([self.embed(word[i : i + 4096], grams[i : i + 4096]) for i in range(0, len(word), 4096)])
        live = grams >= 0
        scale = 1 / np.sqrt(np.maximum(1, live.sum(1, keepdims=True)))
        return self.p["Ew"][word] + (self.p["Eg"][np.where(live, grams, 0)] * live[..., None]).sum(1) * scale

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input parts of all gates of both directions, so a distinct word is multiplied once."""
        return np.concatenate([x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]], 1).astype(np.float32)

    def scan(self, inp: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States (steps, windows, hidden) in text order; ``mask`` (steps, windows, 1) is 0 past a text's end."""
        steps, n, _ = inp.shape
        h, out, u, k = np.zeros((n, HIDDEN), np.float32), np.empty((steps, n, HIDDEN), np.float32), self.p[f"U{d}"], 2 * HIDDEN
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = h @ u
            zr = _sig(inp[t, :, :k] + g[:, :k])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(inp[t, :, k:] + r * g[:, k:])
            if keep is not None:
                keep.append((t, h, z, r, new, g[:, k:]))
            h = (new + z * (h - new)) * mask[t]
            out[t] = h
        return out

    def pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = np.where(mask[..., 0] > 0, states @ self.p["q"], -1e9)
        a = np.exp(s - s.max(0)) * (mask[..., 0] > 0)
        a = a / np.maximum(a.sum(0), 1e-9)
        pooled = (a[..., None] * states).sum(0)
        return a, pooled, pooled @ self.p["o"] + self.p["c"][0]

    def logits(self, table_: np.ndarray, index: np.ndarray, strip: int = 1024) -> np.ndarray:
        """Scores of windows ``index`` (windows, steps) of rows of ``table_`` (projected words); -1 is past the end."""
        out, k = np.empty(len(index), np.float32), 3 * HIDDEN
        for at in range(0, len(index), strip):
            i = index[at : at + strip].T
            mask = (i >= 0).astype(np.float32)[..., None]
            inp = table_[i]
            states = np.concatenate([self.scan(inp[..., :k], mask, "f"), self.scan(inp[..., k:], mask, "b")], 2)
            out[at : at + strip] = self.pool(states, mask)[2]
        return out

    def gradients(self, word: np.ndarray, grams: np.ndarray, index: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss of windows ``index`` over the distinct words ``word, grams``."""
        p, k = self.p, 3 * HIDDEN
        x = self.embed(word, grams)
        i = index.T
        mask = (i >= 0).astype(np.float32)[..., None]
        inp = self.project(x)[i]
        kept = {"f": [], "b": []}
        states = np.concatenate([self.scan(inp[..., :k], mask, "f", kept["f"]), self.scan(inp[..., k:], mask, "b", kept["b"])], 2)
        a, pooled, logit = self.pool(states, mask)
        e = ((_sig(logit) - y) / len(y)).astype(np.float32)
        g = {"c": np.array([e.sum()], np.float32), "o": pooled.T @ e}
        dp = e[:, None] * p["o"]
        da = (states * dp).sum(2)
        ds = a * (da - (a * da).sum(0))
        g["q"] = np.einsum("tnh,tn->h", states, ds)
        dstates = a[..., None] * dp + ds[..., None] * p["q"]
        dx = np.zeros((*i.shape, DIM), np.float32)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            u, du, dh = p[f"U{d}"], np.zeros_like(p[f"U{d}"]), np.zeros((len(y), HIDDEN), np.float32)
            dinp = np.zeros((*i.shape, k), np.float32)
            for t, h, z, r, new, gn in reversed(kept[d]):
                dh = (dh + dstates[t, :, part]) * mask[t]
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (h - new) * z * (1 - z)
                dr = dn * gn * r * (1 - r)
                dinp[t] = np.concatenate([dz, dr, dn], 1)
                dg = np.concatenate([dz, dr, dn * r], 1)
                du += h.T @ dg
                dh = dh * z + dg @ u.T
            flat = dinp.reshape(-1, k)
            g[f"U{d}"], g[f"b{d}"] = du, flat.sum(0)
            g[f"W{d}"] = (x[i] * mask).reshape(-1, DIM).T @ flat
            dx += dinp @ p[f"W{d}"].T
        dword = np.zeros((len(word), DIM), np.float32)
        live = i >= 0
        np.add.at(dword, i[live], dx[live])
        g["Ew"] = np.zeros_like(p["Ew"])
        np.add.at(g["Ew"], word, dword)
        on = grams >= 0
        scale = 1 / np.sqrt(np.maximum(1, on.sum(1)))
        row, col = np.nonzero(on)
        g["Eg"] = np.zeros_like(p["Eg"])
        np.add.at(g["Eg"], grams[row, col], dword[row] * scale[row, None])
        return g


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(word rows of each window padded with -1, document of each window)."""
    rows, owner = [], []
    for k, ids in enumerate(docs):
        n = len(ids)
        if n > WINDOW:
            starts = np.array(window_starts(n))
            rows.append(ids[starts[:, None] + np.arange(WINDOW)].astype(np.int32))
        else:
            one = np.full((1, WINDOW), -1, np.int32)
            one[0, :n] = ids
            rows.append(one)
        owner.append(np.full(len(rows[-1]), k))
    return (np.concatenate(rows), np.concatenate(owner)) if rows else (np.empty((0, WINDOW), np.int32), np.empty(0, np.int64))


def fit_texts(texts: list[list[str]], y: np.ndarray, epochs: int = 9, batch: int = 128, rate: float = 0.012, seed: int = 3) -> BiGru:
    """Adam on windows of the runs of words in ``texts`` (a list a document): at first random ones, then each document's highest and a random one of each clean document.

    A tenth of the documents (by their order) only says when to stop: when two epochs in a row bring no lower loss of their highest windows.
    The parameters of the best epoch are kept.
    """
    model, rng = BiGru(), np.random.default_rng(seed)
    if not len(texts):
        return model
    vocab: dict[str, int] = {}
    runs = [[np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], np.int64) for t in runs or [""]] for runs in texts]
    word, grams = word_inputs(list(vocab))
    index, run = windows([r for one in runs for r in one])
    owner = np.repeat(np.arange(len(runs)), [len(one) for one in runs])[run]
    first = np.searchsorted(owner, np.arange(len(runs)))
    count = np.bincount(owner, minlength=len(runs))
    judge = np.arange(len(runs)) % 10 == 9 if len(runs) >= 200 else np.zeros(len(runs), bool)
    y = np.asarray(y, np.float32)
    m, v, step = {k: np.zeros_like(a) for k, a in model.p.items()}, {k: np.zeros_like(a) for k, a in model.p.items()}, 0
    best, kept, idle = np.inf, None, 0
    for epoch in range(epochs):
        pick = first + rng.integers(0, count)
        if epoch < 2:
            chosen = np.concatenate([pick[~judge], (first + rng.integers(0, count))[~judge]])
        else:
            logit = model.logits(model.project(model.embed(word, grams)), index)
            top = np.lexsort((logit, owner))[first + count - 1]
            if judge.any():
                z = logit[top[judge]].astype(float)
                loss = float(np.mean(np.logaddexp(0, z) - y[judge] * z))
                if loss < best - 1e-4:
                    best, kept, idle = loss, {k: a.copy() for k, a in model.p.items()}, 0
                else:
                    idle += 1
                    if idle == 2:
                        break
            chosen = np.concatenate([top[~judge], pick[~judge & (y == 0)]])
        for take in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
            used, back = np.unique(index[take], return_inverse=True)
            back = back.reshape(len(take), WINDOW) - int(used[0] < 0)
            used = used[used >= 0]
            if not len(used):
                continue
            g = model.gradients(word[used], grams[used], back, y[owner[take]])
            step += 1
            for k in model.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.001 * (g[k] * g[k] - v[k])
                model.p[k] -= rate * (0.5 if epoch > epochs - 4 else 1.0) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-6)
    if kept is not None and idle:
        model.p = kept
    return model


def sample_runs(text: str, most: int = SAMPLE_WINDOWS) -> list[str]:
    """A text's words as one run, or ``most`` windows of them spread evenly over it."""
    ws = words_of(text)
    starts = window_starts(len(ws))
    if len(starts) <= most:
        return [" ".join(ws)]
    return [" ".join(ws[s : s + WINDOW]) for s in (starts[i * (len(starts) - 1) // (most - 1)] for i in range(most))]


def fit(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> BiGru:
    y = labels.where(F.col("doc_id").isNotNull()).where(held_out_fold("doc_id", FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))
    some = lambda value, n: y.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    chosen = some(1, toxic).unionByName(some(0, clean))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[sample_runs(t) for t in batch["text"]])

    rows = text.join(F.broadcast(chosen), "doc_id").mapInPandas(run, "doc_id long, text array<string>, y int")
    # an id counts once, however often its row is repeated
    found = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).toPandas().sort_values("doc_id", kind="stable")
    return fit_texts([list(t) for t in found["text"]], found["y"].to_numpy(np.float32))


class Scorer:
    """Scores whole texts; keeps the projected inputs of words seen so far, bounded, per task."""

    LIMIT = 250_000
    #: Texts of more characters are scored strip by strip, so many words (a multiple of the stride) at a time.
    LONG, STRIP = 1 << 20, 1 << 16

    def __init__(self, model: BiGru):
        self.model, self.known = model, {}
        self.table_ = np.zeros((1024, 6 * HIDDEN), np.float32)

    def add(self, fresh: list[str]) -> None:
        if not fresh:
            return
        at = len(self.known) - len(fresh)
        rows = self.model.project(self.model.embed(*word_inputs(fresh)))
        while len(self.table_) < at + len(rows):
            self.table_ = np.concatenate([self.table_, np.zeros_like(self.table_)])
        self.table_[at : at + len(rows)] = rows

    def highest(self, docs: list[list[str]]) -> np.ndarray:
        """The highest logit of each list of words."""
        if len(self.known) > self.LIMIT:
            self.known.clear()
        rows, fresh, known = [], [], self.known
        for ws in docs:
            ids = np.empty(len(ws), np.int64)
            for k, w in enumerate(ws):
                i = known.get(w)
                if i is None:
                    i = known[w] = len(known)
                    fresh.append(w)
                ids[k] = i
            rows.append(ids)
        self.add(fresh)
        index, owner = windows(rows)
        top = np.full(len(docs), -np.inf)
        np.maximum.at(top, owner, self.model.logits(self.table_, index))
        return top

    def __call__(self, texts: list[str]) -> np.ndarray:
        top, at = np.empty(len(texts)), 0
        while at < len(texts):
            if len(texts[at]) > self.LONG:
                top[at] = max(self.highest([ws])[0] for ws in strips(texts[at], self.STRIP))
                at += 1
                continue
            docs, total = [], 0
            while at + len(docs) < len(texts) and total < 60_000 and len(texts[at + len(docs)]) <= self.LONG:
                docs.append(words_of(texts[at + len(docs)]))
                total += len(docs[-1])
            top[at : at + len(docs)] = self.highest(docs)
            at += len(docs)
        return 1 / (1 + np.exp(-np.clip(top, -30, 30)))


def score(docs: DataFrame, model: BiGru, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty (a window without words); a null id has held_out null; repeated rows are scored as
    often as they occur; a very long text is scored in all of its windows, strip by strip; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for texts in batches:
            yield pd.Series(scorer(list(texts)), dtype="float64")

    udf = F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)
    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), udf(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("score"))
    return got.select("doc_id", (held_out_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
