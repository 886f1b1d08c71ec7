import zlib

import numpy as np

from meshwright.llm.op2_quality import FactorisationMachine, Features, fit, keep, score


def test_linear_time_identity_equals_all_pairs():
    fm = FactorisationMachine()
    fm.v *= 20
    fm.w[:] = np.random.default_rng(0).normal(size=len(fm.w))
    words, stats = Features()("Some words, some WORDS and | others\nline", 40)
    x = [(int(i), 1 / np.sqrt(len(words))) for i in words] + [(int(i), 1.0) for i in stats]
    slow = fm.w0 + sum(fm.w[i] * a for i, a in x) + sum(float(fm.v[i] @ fm.v[j]) * a * b for k, (i, a) in enumerate(x) for j, b in x[:k])
    assert abs(fm.raw(words, stats) - slow) < 1e-3


def test_scores_all_rows_and_learns(spark, docs_df, labels_df, corpus, labels):
    got = score(docs_df, fit(docs_df, labels_df)).collect()
    assert len(got) == len(corpus) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    quality = {i: q for i, q, _ in labels if q is not None}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    assert all(r.held_out == fold(r.doc_id) for r in got if r.doc_id is not None) and any(r.held_out is None for r in got)
    out = [r for r in got if r.held_out and r.doc_id < 400]
    assert len(out) > 40 and np.mean([r.predicted == quality[r.doc_id] for r in out]) > 0.95
    same = [r.score for r in got if r.doc_id == 5]
    assert len(same) == 2 and same[0] == same[1]


def test_held_out_labels_and_other_columns_are_no_inputs(spark, docs_df, labels_df):
    from pyspark.sql import functions as F

    from meshwright.llm.common import held_out_fold

    flipped = labels_df.withColumn("quality", F.when(held_out_fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs_df.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("zz"))
    a = {(r.doc_id, r.score) for r in score(docs_df, fit(docs_df, labels_df)).collect()}
    assert a == {(r.doc_id, r.score) for r in score(other, fit(other, flipped)).collect()}


def test_empty_tables(spark, docs_df, labels_df):
    model = fit(docs_df, labels_df.limit(0))
    assert all(abs(r.score - 0.5) < 0.2 for r in score(docs_df, model).collect())
    assert score(docs_df.limit(0), model).count() == 0
    assert keep(docs_df, model).columns == docs_df.columns
