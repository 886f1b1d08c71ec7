import numpy as np

from meshwright.llm import op6_embeddings as m


def brute(rows, cosine=0.98):
    ok = lambda v, lab: lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)
    good = [k for k, (i, v, lab) in enumerate(rows) if ok(v, lab)]
    links, parent = {k: 0 for k in range(len(rows))}, list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(good):
        for b in good[:n]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], np.float32).astype(float), np.array(rows[b][1], np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    parent[root(a)] = root(b)
    out = []
    for k, (i, _, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((i, links[k], min(group) if group else None))
    return out


def vectors(seed=1, n=40, dim=16):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for c in range(n):
        base = rng.normal(size=dim)
        for noise in (0, 0.01, 0.02, 0.04, 0.06, 0.08):
            rows.append((i, (base + rng.normal(size=dim) * noise).astype(np.float32).tolist(), c % 3))
            i += 1
    rows += [(i, [2 * x for x in rows[0][1]], 0), (i + 1, rows[0][1], 0), (i + 2, rows[0][1], 1), (i + 3, rows[0][1], None), (i + 4, None, 0), (i + 5, [0.0] * dim, 0), (i + 6, [float("nan")] * dim, 0), (i + 7, [float("inf")] + [0.0] * (dim - 1), 0), (i + 8, [None] + [1.0] * (dim - 1), 0), (i + 9, [], 0), (None, rows[0][1], 0), (i + 10, rows[0][1][:4], 0), (i + 11, [-x for x in rows[0][1]], 0)]
    return rows


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n int")
    got = m.near_duplicates(df).collect()
    assert sorted(((r.vec_id is None, r.vec_id or 0), r.n_links, str(r.component_id)) for r in got) == sorted(((i is None, i or 0), n, str(c)) for i, n, c in brute(rows))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_equals_brute_force(spark):
    check(spark, vectors())


def test_large_groups_are_refined_and_cut(spark, monkeypatch):
    monkeypatch.setattr(m, "ROWS", 7)
    check(spark, vectors(2, 10))


def test_refined_cells_of_random_vectors(spark, monkeypatch):
    monkeypatch.setattr(m, "ROWS", 60)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(150, 32))
    near = base[:60] + rng.normal(size=(60, 32)) * rng.choice([0.05, 0.15, 0.2], (60, 1))
    check(spark, [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(np.concatenate([base, near]))])


def test_repeated_and_missing_ids(spark):
    a, b, c = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [1.0, 0.01, 0.0, 0.0]
    check(spark, [(1, a, 0), (1, b, 1), (2, c, 0), (3, b, 1), (None, a, 0), (None, b, 2), (7, a, 0)])


def test_huge_and_tiny_vectors(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [2e-300, 2e-300], 0), (3, [1e300, -1e300], 0)]
    got = m.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_few_of_all_pairs_are_compared():
    rng = np.random.default_rng(3)
    vec = rng.normal(size=(4000, 64))
    vec[3000:] = vec[:1000] + rng.normal(size=(1000, 64)) * 0.15
    tally, got = [], set()
    for p, q in m.linked_pairs(vec, np.ones(4000, bool), None, -1, 0.98, m.BLOCKS, tally):
        pairs = list(zip(np.minimum(p, q).tolist(), np.maximum(p, q).tolist()))
        assert not got.intersection(pairs)
        got.update(pairs)
    x = m.unit(vec)
    i, j = np.nonzero(np.triu(x @ x.T >= 0.98, 1))
    assert got == set(zip(i.tolist(), j.tolist())) and len(got) > 300
    assert sum(tally) < 4000 * 3999 / 2 / 10


def test_empty_table(spark):
    assert m.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
