import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meshwright.operators import conflicts, fusion, quality, voting
from meshwright.sources import sssom
from meshwright.vocab import KEY, MAPPINGS

A, B = "skos:exactMatch", "skos:closeMatch"
ROWS = [
    ("s1", "o1", A, 0.9, "m1", "first", 1), ("s1", "o1", A, 0.7, "m2", None, 2), ("s1", "o1", A, 0.4, "m1", "again", 3), ("s1", "o2", B, 0.8, "m3", None, 4),
    ("s2", "o1", A, 0.5, "m1", None, 5), ("s3", "o3", A, 0.6, "m2", None, 6), ("s3", "o4", A, 0.6, "m1", None, 7), ("s4", "o5", A, 0.0, "m1", "", 8),
]


def mappings(spark, rows=ROWS):
    return spark.createDataFrame(rows, MAPPINGS)


def test_fusion_means_over_matchers_and_keeps_order(spark):
    got = {(r.subject_id, r.object_id): r for r in fusion.fuse(mappings(spark)).collect()}
    r = got["s1", "o1"]
    assert r.confidences == {"m1": 0.9, "m2": 0.7} and r.supporting_matchers == ["m1", "m2"] and abs(r.consensus_confidence - 0.8) < 1e-12
    assert r.mapping_justification == "first; again" and r.support_count == 2 and got["s2", "o1"].mapping_justification is None
    assert got["s4", "o5"].consensus_confidence == 0.0
    low = mappings(spark, [("a", "b", A, -0.2, "m1", None, 1)])
    assert fusion.fuse(low, -1.0).first().consensus_confidence == 0.0 and fusion.fuse(low).count() == 0  # never below 0
    assert fusion.fuse(mappings(spark, [])).count() == 0


def test_votes(spark):
    f = fusion.fuse(mappings(spark))
    keys = lambda df: {(r.subject_id, r.object_id) for r in df.collect()}
    assert keys(voting.vote(f, total=3).accepted) == {("s1", "o1")}
    assert keys(voting.vote(f, voting.VotingConfig("unanimous"), 2).accepted) == {("s1", "o1")}
    assert len(keys(voting.vote(f, voting.VotingConfig("weighted", min_support_ratio=0.3), 3).accepted)) == 6  # equal weights without any
    assert keys(voting.vote(f, voting.VotingConfig("confidence_weighted", min_support_ratio=0.5, weights={"m1": 0.4, "m2": 0.4}), 3).accepted) == {("s1", "o1")}
    r = voting.vote(f, voting.VotingConfig(min_confidence=0.55), 3)
    assert keys(r.accepted) | keys(r.rejected) == {("s1", "o1"), ("s1", "o2"), ("s3", "o3"), ("s3", "o4")}  # the others are in neither
    with pytest.raises(ValueError):
        voting.vote(f, voting.VotingConfig("loudest"))


def test_conflicts_and_ties(spark):
    f = fusion.fuse(mappings(spark))
    assert {r.subject_id for r in conflicts.conflicting_subjects(f).collect()} == {"s1", "s3"}
    win = lambda s: {(r.subject_id, r.object_id) for r in conflicts.resolve(f, s).collect()}
    rest = {("s2", "o1"), ("s4", "o5"), ("s3", "o3")}  # s3 is a tie: first in input order
    assert win("confidence") == rest | {("s1", "o1")} == win("unknown strategy") and win("support") == rest | {("s1", "o1")} and win("specificity") == rest | {("s1", "o1")}
    assert len(win("keep_all")) == 6
    same = mappings(spark, [("a", "x", A, 0.5, "m", None, 1), ("a", "x", B, 0.9, "m", None, 2), (None, "x", A, 0.5, "m", None, 3), (None, "y", A, 0.6, "m", None, 4)])
    got = {(r.subject_id, r.object_id, r.predicate_id) for r in conflicts.resolve(fusion.fuse(same)).collect()}
    assert got == {("a", "x", A), ("a", "x", B), (None, "y", A)}  # several predicates to one object are no conflict


def test_quality(spark):
    f = fusion.fuse(mappings(spark))
    empty = fusion.fuse(mappings(spark, []))
    m = quality.metrics(empty).first()
    assert m.total_mappings == 0 and m.avg_confidence == 0.0 and m.max_support == 0
    assert {r.bin: r.n for r in quality.confidence_histogram(empty).collect()} == dict.fromkeys((b[2] for b in quality.BINS), 0)
    h = quality.confidence_histogram(spark.createDataFrame([(0.2,), (1.0,), (0.8,), (1.2,), (-1.0,)], "consensus_confidence double"))
    assert {r.bin: r.n for r in h.collect()} == {"0.0-0.2": 0, "0.2-0.4": 1, "0.4-0.6": 0, "0.6-0.8": 0, "0.8-1.0": 2}
    p = quality.precision_recall(empty, empty).first()
    assert (p.tp, p.precision, p.recall, p.f1) == (0, 0.0, 0.0, 0.0)
    pairs = {(r.m1, r.m2): r.jaccard for r in quality.agreement(f).collect()}
    assert pairs["m1", "m3"] == 0.0 and abs(pairs["m1", "m2"] - 1 / 5) < 1e-12
    assert abs(sum(r.weight for r in quality.suggest_weights(f).collect()) - 1) < 1e-9
    lone = fusion.fuse(mappings(spark, [("a", "b", A, 0.5, "m1", None, 1), ("c", "d", A, 0.5, "m2", None, 2)]))
    assert {r.weight for r in quality.suggest_weights(lone).collect()} == {0.5}
    text = quality.quality_report(f, "confidence")
    assert "Total mappings: 6" in text and "  - s1" in text


def test_sssom_scan_and_export(spark, tmp_path):
    p = tmp_path / "a.sssom.tsv"
    p.write_text("# comment\nsubject\tobject\tpredicate\tconfidence\tmapping_justification\nhttp://a#1\tb\t\t0.0\tx\n\tb\t\t1\t\nc\td\tskos:exactMatch\t\t\n")
    rows = sssom.load(spark, str(p), "m").collect()
    assert [(r.subject_id, r.predicate_id, r.confidence) for r in rows] == [("http://a#1", B, 0.0), ("c", A, 1.0)]
    assert sssom.load(spark, str(tmp_path / "none.tsv"), "m").count() == 0
    zero = sssom.normalise(spark.createDataFrame([("a", "b", "0.0", "0.4")], "subject_id string, object_id string, confidence string, similarity string"), "m", compat_zero_confidence=True)
    assert zero.first().confidence == 0.4
    out = sssom.export(fusion.fuse(mappings(spark)), str(tmp_path / "out" / "f.tsv"))
    lines = open(out).read().splitlines()
    assert lines[1] == "# Total mappings: 6" and lines[4].split("\t")[:4] == ["subject_id", "predicate_id", "object_id", "confidence"]
    assert lines[5].split("\t")[-1] == "Support: 2 matchers: m1, m2" and lines[6].split("\t")[5] == "ensemble_fusion"
    back = sssom.load(spark, out, "again")
    assert back.count() == 6 and sssom.load_all(spark, {"x": out, "y": out}).select("ord").distinct().count() == 12
    sssom.write_table(fusion.fuse(mappings(spark)), str(tmp_path / "parts"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.sampled_from([A, B]), st.sampled_from([0.0, 0.3, 0.5, 0.9]), st.sampled_from(["m1", "m2", "m3"])), max_size=15))
def test_properties(spark, data):
    f = fusion.fuse(mappings(spark, [(*r, None, i) for i, r in enumerate(data)])).cache()
    assert f.count() == len({r[:3] for r in data})
    v = voting.vote(f)
    assert v.accepted.select(*KEY).intersect(v.rejected.select(*KEY)).count() == 0 and v.accepted.count() + v.rejected.count() == f.count()
    low, high = (voting.vote(f, voting.VotingConfig("threshold", 1, r)).accepted.count() for r in (0.4, 0.9))
    assert high <= low
    assert conflicts.conflicting_subjects(conflicts.resolve(f)).count() == 0
