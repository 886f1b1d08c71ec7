import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meshwright.llm import op4_search as m


def brute(rows, queries, top=10):
    docs = [(i, Counter((t or "").lower().split())) for i, t in rows if i is not None]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    asked = {}
    for q, t in queries:
        asked.setdefault(q, Counter()).update((t or "").lower().split())
    out = {}
    for q, terms in asked.items():
        scores = []
        for i, c in docs:
            s = sum(k * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (m.K1 + 1) / (c[w] + m.K1 * (1 - m.B + m.B * sum(c.values()) / (total / n))) for w, k in terms.items() if w in c)
            if s > 0:
                scores.append((i, s))
        out[q] = sorted(scores, key=lambda x: (-round(x[1], 9), x[0]))[:top]
    return out


def check(got, want):
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert set(found) == {q for q, x in want.items() if x}
    for q, rows in found.items():
        assert all(abs(a[1] - b[1]) < 1e-6 for a, b in zip(rows, want[q])) and len(rows) == len(want[q])
        assert [r[0] for r in rows] == [r[0] for r in want[q]]


def test_equals_brute_force_over_many_shards(spark, docs_df, corpus, monkeypatch):
    monkeypatch.setattr(m, "SHARD_DOCS", 37)
    monkeypatch.setattr(m, "BLOCK", 8)
    monkeypatch.setattr(m, "QUERY_BLOCK", 3)
    rows = [(r[0], r[1]) for r in corpus]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    got = m.search(docs_df.repartition(3), docs_df.where(F.col("doc_id") % 20 == 0)).collect()
    check(got, brute(rows, queries))


@pytest.mark.parametrize("short", [0, 10_000])
def test_cursors_and_ranges_equal_brute_force(spark, docs_df, corpus, monkeypatch, short):
    monkeypatch.setattr(m, "SHORT", short)
    monkeypatch.setattr(m, "SHARD_DOCS", 64)
    monkeypatch.setattr(m, "BLOCK", 8)
    rows = [(r[0], r[1]) for r in corpus]
    queries = [r for r in rows if r[0] is not None and r[0] % 25 == 0] + [(2000, "w1 w2 w3"), (2001, "idiot scum"), (2002, "w7"), (2003, "w1 w1 zzz")]
    df = spark.createDataFrame(queries, "doc_id long, text string")
    check(m.search(docs_df, df).collect(), brute(rows, queries))


def one_shard(rows, query):
    terms, counts = m.Terms()(query)
    order = np.argsort(terms)
    return m.Shard(next(m.build([pd.DataFrame(rows, columns=["doc_id", "text"])])).iloc[0], 4.0, terms[order]), counts[order] * 1.0


def test_wand_skips_documents(monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    rng = random.Random(1)
    rows = [(i, " ".join(["rare"] * (i % 97 == 5) + ["common"] * rng.randint(1, 3) + rng.choices([f"f{j}" for j in range(50)], k=5))) for i in range(800)]
    shard, weights = one_shard(rows, "rare common f3")
    weights *= [8.0 if w == "rare" else 1.0 for w in sorted("rare common f3".split(), key=lambda w: m.Terms()(w)[0][0])]
    seen = []
    ids, scores = shard.wand(np.arange(3), weights, 0.0, 5, seen)
    assert all(i % 97 == 5 for i in ids) and len(seen) < 150
    monkeypatch.setattr(m, "SHORT", 0)
    [(want, want_scores)] = shard.search([(np.arange(3), weights)], np.zeros(1), 5)
    assert ids.tolist() == want.tolist() and np.allclose(scores, want_scores)
    assert len(shard.wand(np.arange(3), weights, scores[0] + 1, 5)[0]) == 0


def test_pruning_skips_ranges(monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 8)
    monkeypatch.setattr(m, "SHORT", 0)
    rows = [(i, "rare common" if i == 77 else "common filler words here") for i in range(400)]
    shard, weights = one_shard(rows, "rare common")
    seen, real = [], m.spans
    monkeypatch.setattr(m, "spans", lambda a, b: seen.append(1) or real(a, b))
    [(ids, scores)] = shard.search([(np.arange(2), weights)], np.zeros(1), 1)
    assert ids.tolist() == [77] and len(seen) <= 3
    assert [len(x[0]) for x in shard.search([(np.arange(2), weights)], np.array([scores[0] + 1]), 1)] == [0]


def test_queries_are_summed_together(monkeypatch):
    """A step of a shard's search serves many queries; lists that no longer fit are made again."""
    monkeypatch.setattr(m, "BLOCK", 8)
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{j}" for j in range(300)], k=rng.choice((5, 40)))) for _ in range(150)]
    made = m.Terms()
    asked = np.unique(np.concatenate([made(t)[0] for t in texts]))
    queries = [(np.searchsorted(asked, a), n * 1.0) for a, n in map(made, texts)]
    row = next(m.build([pd.DataFrame(list(enumerate(texts)), columns=["doc_id", "text"])])).iloc[0]
    calls, real = [], m.spans
    monkeypatch.setattr(m, "spans", lambda a, b: calls.append(1) or real(a, b))
    found = m.Shard(row, 20.0, asked).search(queries, np.zeros(150), 5)
    assert len(calls) <= 10
    monkeypatch.setattr(m, "AT_ONCE", 1)
    monkeypatch.setattr(m, "LISTED", 10)
    for k, ((ids, scores), (_, want)) in enumerate(zip(found, m.Shard(row, 20.0, asked).search(queries, np.zeros(150), 5))):
        assert k in ids and np.allclose(scores, want)  # documents of equal scores may change places


def test_empty_tables_and_unknown_words(spark, docs_df):
    none = docs_df.limit(0)
    assert m.search(none, docs_df).count() == 0 and m.search(docs_df, none).count() == 0
    q = spark.createDataFrame([(1, "zzz unknown"), (2, None), (None, "w1")], "doc_id long, text string")
    assert m.search(docs_df, q).count() == 0
