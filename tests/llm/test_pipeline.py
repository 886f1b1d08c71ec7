import hashlib
import re

import numpy as np
import pytest


@pytest.fixture(scope="session")
def stages(spark, tmp_path_factory, corpus, labels):
    import corpus_pipeline as cp
    from meshwright.llm.common import table, written

    d = tmp_path_factory.mktemp("sf")
    rows = [*corpus, (6000, corpus[9][1] + " token = abcdef123456", "en", "s0", 9), (6001, "w1 w2 " + corpus[10][1], "en", "s0", 9)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(d / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(d / "labels.parquet"))
    out = [("documents", table(spark, str(d), "documents"))]
    for name, f in cp.STAGES:
        out.append((name, written(f(spark, out[-1][1], str(d)), name)))
    return d, dict(out)


def test_stages_return_the_columns_of_documents(stages):
    _, s = stages
    for name in ("quality", "near_duplicates", "secrets", "mixing"):
        assert s[name].columns == s["documents"].columns and s[name].dtypes == s["documents"].dtypes


def test_quality_drops_what_the_classifier_rejects(spark, stages):
    from meshwright.llm import op2_quality as q

    d, s = stages
    model = q.fit(s["documents"], spark.read.parquet(str(d / "labels.parquet")))
    want = sorted(str(r.doc_id) for r in q.score(s["documents"], model).where("predicted = 1").collect())
    assert sorted(str(r.doc_id) for r in s["quality"].select("doc_id").collect()) == want
    ids = {r.doc_id for r in s["quality"].collect()}
    assert sum(i in ids for i in range(400) if i % 5 != 1) > 300


def test_near_duplicates_leave_one_of_each_group(spark, stages):
    from test_op8 import slow_components, slow_fingerprint

    _, s = stages
    rows = [(r.doc_id, r.text) for r in s["quality"].collect()]
    comp = slow_components(list(range(len(rows))), [slow_fingerprint(t or "") for _, t in rows])
    least = {}
    for k, (i, t) in enumerate(rows):
        order = (i is None, i or 0, hashlib.sha256((t or "").encode()).hexdigest())
        least[comp[k]] = min(least.get(comp[k], order), order)
    got = [(r.doc_id is None, r.doc_id or 0, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in s["near_duplicates"].collect()]
    assert sorted(got) == sorted(least.values())


def test_secrets_are_gone(stages):
    from test_op3 import base

    _, s = stages
    before, after = {r.doc_id: r.text for r in s["near_duplicates"].collect()}, {r.doc_id: r for r in s["secrets"].collect()}
    assert set(before) == set(after)
    for i, t in before.items():
        if base(t or ""):
            assert not base(after[i].text) and after[i].n_chars == len(after[i].text)
        else:
            assert after[i].text == re.sub("^None$", "", str(t)) or "<secret>" in after[i].text


def test_mixing_takes_whole_documents_as_often_as_their_rate_says(stages):
    _, s = stages
    before, after = {r.doc_id: r.text for r in s["secrets"].collect()}, s["mixing"].collect()
    assert all(before[r.doc_id] == r.text for r in after)
    kept = {r.doc_id for r in after}
    clean = [i for i in before if i is not None and i < 400 and i % 5 != 1 and i % 7 != 2]
    assert np.mean([i in kept for i in clean]) > 0.9


def test_packing_holds_all_tokens(stages):
    from meshwright.llm.op5_packing import ByteBpe, default_vocabulary

    _, s = stages
    encode = ByteBpe(*default_vocabulary())
    want = sum(len(encode(r.text or "")) + 1 for r in s["mixing"].collect())
    assert sum(r.length for r in s["packing"].collect()) == want


def test_run_equals_the_stages(spark, stages):
    import corpus_pipeline as cp

    d, s = stages
    got = cp.run(spark, str(d))
    assert sorted(map(str, got.select("doc_id", "start", "ids_crc32").collect())) == sorted(map(str, s["packing"].select("doc_id", "start", "ids_crc32").collect()))


def test_mixing_keeps_every_held_out_clean_document_and_drops_toxic_weight(spark):
    import os

    from pyspark.sql import functions as F

    import corpus_pipeline as cp
    from meshwright.llm import op10_mixing as m
    from meshwright.llm.common import table, written

    d = "/root/testdata/sf0.01"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").where("doc_id is not null and quality is not null and toxic is not null").dropDuplicates(["doc_id"])
    model = m.fit(docs, labels.where("doc_id % 2 = 0"))
    # the mixing stage gets what the quality filter kept
    docs = docs.join(labels.where("quality = 0").select("doc_id"), "doc_id", "left_anti")
    scored = written(m.posteriors(docs, model), "scored")
    rated = scored.withColumn("rate", cp.mixing_rate(scored))
    rows = rated.withColumn("times", m.copies(F.col("rate"), F.col("doc_id"), F.col("p"))).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas()
    clean, toxic = rows[(rows.quality == 1) & (rows.toxic == 0)], rows[rows.toxic == 1]
    assert len(clean) > 50 and (clean.times >= 1).mean() > 0.98 and clean.times.mean() < 2
    assert toxic.rate.mean() < clean.rate.mean()
    print("clean kept", (clean.times >= 1).mean(), "toxic rate", toxic.rate.mean(), len(toxic), "clean rate", clean.rate.mean(), len(clean))


def test_a_floor_keeps_clean_documents_whose_posteriors_are_soft(spark):
    import corpus_pipeline as cp

    rng = np.random.default_rng(2)
    p = np.vstack([rng.dirichlet([1.0, 0.3, 12.0, 1.0], 300), rng.dirichlet([1.0, 0.3, 2.0, 9.0], 40)])
    df = spark.createDataFrame([(i, 50 + i % 70, x.tolist()) for i, x in enumerate(p)], "doc_id long, tokens long, p array<double>")
    got = np.array([r.r for r in df.select("doc_id", cp.mixing_rate(df).alias("r")).orderBy("doc_id").collect()])
    called = p.argmax(1) == 2
    tokens = 50 + np.arange(len(p)) % 70
    assert (got[called] >= 1).all() and got.max() < 5 and got[~called].mean() < 0.5
    want = (tokens[called] @ p[called]) / tokens[called].sum()
    assert np.allclose((got * tokens) @ p / tokens.sum(), want, atol=2e-3)
