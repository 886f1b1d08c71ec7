import numpy as np
import pytest

from meshwright.llm import op10_mixing as m


def brute(tokens, p, goal, steps=m.STEPS, tolerance=m.TOLERANCE):
    a = (p * tokens[:, None]).T @ p
    scale, r = np.linalg.pinv(a + 1e-9 * np.trace(a) * np.eye(p.shape[1])), np.ones(len(p))
    for _ in range(steps):
        step = scale @ ((r * tokens) @ p - goal)
        if np.abs(step).max() <= tolerance:
            break
        r = np.maximum(0, r - p @ step)
    return r


def test_rates_equal_brute_force_and_meet_reachable_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3] * 4, 500)
    tokens = rng.integers(1, 200, 500).astype(float)
    df = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))], "doc_id long, tokens long, p array<double>")
    target = dict(zip(m.DOMAINS, (0.1, 0.2, 0.5, 0.2)))
    history = m.fit_rates(df, target)
    got = np.array([r.r for r in df.select("doc_id", m.rate(history).alias("r")).orderBy("doc_id").collect()])
    goal = np.array(list(target.values())) * tokens.sum()
    assert np.allclose(got, brute(tokens, p, goal), atol=1e-6) and (got >= 0).all()
    assert np.allclose((got * tokens) @ p, goal, rtol=1e-3)


def test_mix_handles_all_rows(spark, docs_df, labels_df, corpus):
    got = m.mix(docs_df, labels_df).collect()
    assert len(got) == len(corpus) and all(r.rate >= 0 and abs(sum(r.p) - 1) < 1e-6 for r in got)
    words = {r[0]: len((r[1] or "").split()) for r in corpus}
    assert all(r.tokens == words[r.doc_id] for r in got)
    low, high = [r.rate for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 1], [r.rate for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 > 2 and r.doc_id % 7 != 2]
    assert np.mean(low) < 0.5 < np.mean(high)
    same = [r.rate for r in got if r.doc_id == 5]
    assert len(same) == 2 and same[0] == same[1]


def test_empty_tables(spark, docs_df, labels_df):
    assert m.mix(docs_df.limit(0), labels_df).count() == 0
    assert m.mix(docs_df, labels_df.limit(0)).count() == docs_df.count()


def nnls(a, b):
    """Lawson and Hanson: nonnegative x with the least |a x - b|."""
    x, on = np.zeros(a.shape[1]), []
    for _ in range(1000):
        w = a.T @ (b - a @ x)
        w[on] = -1
        if w.max() <= 1e-13:
            return x
        on.append(int(w.argmax()))
        while (s := np.linalg.lstsq(a[:, on], b, rcond=None)[0]).min() <= 0:
            old = x[on]
            old = old + (old[s <= 0] / (old[s <= 0] - s[s <= 0])).min() * (s - old)
            x[:] = 0
            x[on] = old
            on = [j for j, v in zip(on, old) if v > 1e-15]
        x[:] = 0
        x[on] = s
    raise AssertionError("no solution")


def test_totals_are_the_least_squares_ones_for_targets_out_of_reach(spark):
    rng = np.random.default_rng(4)
    p = 0.9 * rng.dirichlet([0.3, 0.1, 2.0, 0.2], 800) + 0.1 * np.array([0.1, 0.2, 0.5, 0.2])
    tokens = rng.integers(0, 200, 800).astype(float)
    df = spark.createDataFrame([(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p))], "doc_id long, tokens long, p array<double>")
    for target in ((0.04, 0.0, 0.95, 0.01), (0.0, 0.0, 0.99, 0.01), (0.0, 0.0, 0.0, 1.0)):
        goal, share = np.array(target), tokens / tokens.sum()
        history = m.fit_rates(df, dict(zip(m.DOMAINS, target)))
        got = np.array([r.r for r in df.select("doc_id", m.rate(history).alias("r")).orderBy("doc_id").collect()])
        a = (p * share[:, None]).T
        want = a @ nnls(a, goal)
        assert np.linalg.norm(a @ brute(tokens, p, goal * tokens.sum()) - want) > m.GAP
        assert (got >= 0).all() and np.linalg.norm(a @ got - want) <= m.GAP


def test_a_fit_that_does_not_converge_is_an_error(spark):
    p = [[0.7, 0.1, 0.1, 0.1], [0.1, 0.1, 0.7, 0.1], [0.1, 0.2, 0.4, 0.3]]
    df = spark.createDataFrame([(1.0, 0.0, 1 / 3, x) for x in p], "r double, floor double, share double, p array<double>")
    with pytest.raises(RuntimeError):
        m.implicit_steps(df, np.array([0.0, 0.0, 1.0, 0.0]), most=1)
