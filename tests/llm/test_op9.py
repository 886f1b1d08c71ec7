import random
import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from meshwright.llm import op9_toxicity as m


@given(st.integers(0, 500))
def test_windows_cover_all_words_and_overlap(n):
    starts = m.window_starts(n)
    seen = {k for s in starts for k in range(s, min(n, s + m.WINDOW))}
    assert seen == set(range(n)) and all(b - a <= m.STRIDE for a, b in zip(starts, starts[1:]))


def test_gradients_equal_finite_differences():
    model = m.BiGru()
    words = [f"word{i}" for i in range(30)]
    word, grams = m.word_inputs(words)
    rng = np.random.default_rng(0)
    index = rng.integers(0, 30, (5, m.WINDOW))
    index[2, 10:] = -1
    y = np.array([0, 1, 1, 0, 1], np.float32)
    for k in model.p:
        model.p[k] = model.p[k].astype(np.float64)
    loss = lambda: float(np.mean(np.logaddexp(0, (z := model.logits(model.project(model.embed(word, grams)).astype(np.float64), index)).astype(float)) - y * z))
    g = model.gradients(word, grams, index, y)
    for name in ("Wf", "Ub", "bf", "q", "o", "c", "Ew", "Eg"):
        flat = g[name].ravel()
        for at in np.argsort(-np.abs(flat))[:3]:
            p, eps = model.p[name].reshape(-1), 3e-3
            was = p[at]
            p[at] = was + eps
            up = loss()
            p[at] = was - eps
            down = loss()
            p[at] = was
            assert abs((up - down) / (2 * eps) - flat[at]) < 0.02 * max(0.05, abs(flat[at])) + 2e-3, name


def test_scorer_equals_a_document_at_a_time():
    model = m.BiGru()
    texts = ["one two three", "", "w " * 200, "a b c d " * 40, "x" * 5000, "one two three"]
    together, alone = m.Scorer(model)(texts), [float(m.Scorer(model)([t])[0]) for t in texts]
    assert np.allclose(together, alone, atol=1e-5)


def plain(model, words):
    """Logit of one window by a recurrent network written out word by word."""
    p, sig = model.p, lambda x: 1 / (1 + np.exp(-np.asarray(x, float)))
    xs = []
    for w in words:
        raw = f"<{w}>"
        grams = [raw[:5], raw[:6], raw[-5:], raw[-6:]] + [raw[k : k + 3] for k in range(len(raw) - 2)]
        h = lambda t: zlib.crc32(t.encode())
        xs.append(p["Ew"][h(w) % m.WORD_BUCKETS] + sum(p["Eg"][h(g) % m.GRAM_BUCKETS] for g in grams) / np.sqrt(len(grams)))
    states = []
    for d, seq in (("f", xs), ("b", xs[::-1])):
        h, out = np.zeros(m.HIDDEN), []
        for x in seq:
            a, u = x @ p[f"W{d}"] + p[f"b{d}"], h @ p[f"U{d}"]
            n = m.HIDDEN
            z, r = sig(a[:n] + u[:n]), sig(a[n : 2 * n] + u[n : 2 * n])
            h = (1 - z) * np.tanh(a[2 * n :] + r * u[2 * n :]) + z * h
            out.append(h)
        states.append(out if d == "f" else out[::-1])
    s = [np.concatenate(x) for x in zip(*states)]
    if not s:
        return float(p["c"][0])
    e = np.exp([x @ p["q"] for x in s])
    return float(sum(a * x for a, x in zip(e / e.sum(), s)) @ p["o"] + p["c"][0])


def test_scorer_equals_a_plain_recurrent_network():
    rng, model = random.Random(1), m.BiGru()
    texts = ["", "One two, three!", " ".join(rng.choices(["a", "bc", "ünlike", "wordy" * 4, "x" * 75], k=90)), "z" * 900]
    for text, got in zip(texts, m.Scorer(model)(texts)):
        ws = m.words_of(text)
        want = max(plain(model, ws[s : s + m.WINDOW]) for s in m.window_starts(len(ws)))
        assert abs(got - 1 / (1 + np.exp(-want))) < 1e-5


@given(st.integers(0, 400), st.sampled_from([16, 32, 64]))
def test_strips_have_the_windows_of_the_whole(n, size):
    words = [f"w{i}" for i in range(n)]
    cut = lambda ws: [tuple(ws[s : s + m.WINDOW]) for s in m.window_starts(len(ws))]
    assert [w for part in m.strips(" ".join(words), size) for w in cut(part)] == cut(words)


def test_long_texts_are_scored_as_others(monkeypatch):
    text, model = "some words of a text that is long " * 300 + "q" * 90, m.BiGru()
    want = m.Scorer(model)([text, "a b"])
    monkeypatch.setattr(m.Scorer, "LONG", 1000)
    monkeypatch.setattr(m.Scorer, "STRIP", 64)
    assert np.allclose(m.Scorer(model)([text, "a b"]), want, atol=1e-6)


def test_all_characters_are_inputs():
    letters = "abcdefghijklmnopqrstuvwxyz"
    for n in (5, 20, 21, 64, 75, 300):
        w = (letters * 20)[:n]
        seen = lambda t: (lambda a, b: (a.tolist(), b.tolist()))(*m.word_inputs(m.words_of(t)))
        assert all(seen(w) != seen(w[:i] + "ß" + w[i + 1 :]) for i in range(n))
    pieces = m.words_of((letters * 20)[:301])
    assert all(len(x) <= m.LONGEST for x in pieces) and pieces[0] + "".join(x[m.LONGEST // 2 :] for x in pieces[1:]) == (letters * 20)[:301]


def test_samples_of_long_texts_are_bounded():
    words = [f"w{i}" for i in range(50_000)]
    runs = m.sample_runs(" ".join(words))
    assert len(runs) == m.SAMPLE_WINDOWS and runs[0].split() == words[: m.WINDOW] and runs[-1].split() == words[-m.WINDOW :]
    assert m.sample_runs("a b") == ["a b"] and m.sample_runs("") == [""]


def test_held_out_labels_and_other_columns_are_no_inputs(spark, docs_df, labels_df):
    from pyspark.sql import functions as F

    from meshwright.llm.common import held_out_fold

    flipped = labels_df.withColumn("toxic", F.when(held_out_fold("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs_df.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    a = {(r.doc_id, r.score) for r in m.score(docs_df, m.fit(docs_df, labels_df)).collect()}
    assert a == {(r.doc_id, r.score) for r in m.score(other, m.fit(other, flipped)).collect()}


def test_scores_all_rows_and_learns(spark, docs_df, labels_df, corpus, labels):
    got = m.score(docs_df, m.fit(docs_df, labels_df)).collect()
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    toxic = {i: t for i, _, t in labels if t is not None}
    out = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(out) > 80 and np.mean([r.predicted == toxic[r.doc_id] for r in out]) > 0.95
    assert m.score(docs_df.limit(0), m.BiGru()).count() == 0 and m.fit(docs_df, labels_df.limit(0)) is not None
