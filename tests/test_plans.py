import json

import pytest

from meshwright.plans import errors, manifest, pipeline
from meshwright.streaming import incremental
from meshwright.vocab import MAPPINGS

SCHEMA = {"title": "Person", "type": "object", "properties": {"hasName": {"type": "string"}, "location": {"type": "object", "title": "Location"}}}


def write(tmp_path, **extra):
    (tmp_path / "s.json").write_text(json.dumps(SCHEMA))
    (tmp_path / "t.csv").write_text("Agent,has value\na,1\n")
    lines = {"name": "demo", "sources": [{"id": "one", "fetch": {"type": "local", "path": "s.json"}, "convert": {"type": "json-schema", "namespace": "http://one/"}}, {"identifier": "two", "fetch": {"paths": ["t.csv"]}, "convert": {"type": "csv"}}, {"id": "off", "fetch": {"path": "missing"}, "enabled": False}], "alignment": {"voting": "threshold", "threshold": 0.1}, "pipeline": {"retry_delay": 0}}
    path = tmp_path / "m.yaml"
    path.write_text(json.dumps({**lines, **extra}))
    return str(path)


def test_run_and_resume(spark, tmp_path):
    m, work = write(tmp_path), str(tmp_path / "work")
    out = pipeline.orchestrate(spark, m, work, validate=True)
    assert set(out.converted) == {"one", "two"} and not out.errors
    fused = spark.read.parquet(out.fused)
    assert fused.where("subject_id = 'http://one/Location'").count() >= 1
    merged = spark.read.parquet(out.merged)
    assert merged.count() == merged.distinct().count() > 100
    assert "Total mappings" in open(out.report).read()
    state = json.load(open(f"{work}/state.json"))
    assert state["status"] == "completed" and set(state["done"]) == {"meta", "ingest", "align", "fuse", "resolve", "merge"}
    state["status"] = "failed"
    json.dump(state, open(f"{work}/state.json", "w"))
    again = pipeline.orchestrate(spark, m, work, resume=True)
    assert again.merged == out.merged and json.load(open(f"{work}/state.json"))["done"] == state["done"]


def test_failures_are_recorded_or_raised(spark, tmp_path):
    bad = [{"id": "bad", "fetch": {"path": "none.xsd"}}, {"id": "far", "fetch": {"type": "git", "url": "x"}}]
    with pytest.raises(errors.FetchError):
        pipeline.orchestrate(spark, write(tmp_path, sources=bad, pipeline={"fail_fast": True, "retry_delay": 0}), str(tmp_path / "a"))
    out = pipeline.orchestrate(spark, write(tmp_path, sources=bad, pipeline={"fail_fast": False, "retry_delay": 0, "parallel_sources": True}), str(tmp_path / "b"))
    assert [e["source"] for e in out.errors] == ["bad", "far"] and spark.read.parquet(out.merged).count() == 100


def test_retries():
    seen = []

    def run():
        seen.append(1)
        if len(seen) < 3:
            raise errors.FetchError("x")
        return "done"

    assert pipeline.retried(run, 3, 0) == "done" and len(seen) == 3
    with pytest.raises(errors.ConvertError):
        pipeline.retried(lambda: (_ for _ in ()).throw(errors.ConvertError("no")), 3, 0)


def test_manifests(tmp_path):
    m = manifest.load(write(tmp_path))
    assert [s.id for s in m.enabled()] == ["one", "two"] and m.matcher_names() == ["LexicalExact", "TokenJaccard", "EditDistance"]
    for change in ({"sources": []}, {"matchers": ["nope"]}, {"sources": [{"id": "a/b", "fetch": {"path": "x"}}]}, {"sources": [{"id": "a", "fetch": {"path": "x"}}] * 2}, {"sources": [{"id": "a", "fetch": {"type": "http"}}]}):
        with pytest.raises(errors.ManifestError):
            manifest.load(write(tmp_path, **change))
    found = pipeline.preflight(write(tmp_path), str(tmp_path / "w"))
    assert set(found.values()) == {"ok"}
    with pytest.raises(errors.PreflightError):
        pipeline.preflight(str(tmp_path / "none.yaml"), str(tmp_path / "w"))
    assert errors.FetchError("m", "fetch", "s").to_dict()["recoverable"] and str(errors.PlanError("m", "st")) == "m (stage=st)"


def test_incremental_fusion(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [("a", "b", "p", 0.4, "m1", None, 1), ("c", "d", "p", 0.8, "m1", None, 2)]
    spark.createDataFrame(first, MAPPINGS).write.parquet(src)
    incremental.start(spark, src, out, str(tmp_path / "cp"), 4).awaitTermination()
    spark.createDataFrame([("a", "b", "p", 0.8, "m2", None, 3)], MAPPINGS).write.mode("append").parquet(src)
    incremental.start(spark, src, out, str(tmp_path / "cp"), 4).awaitTermination()
    got = {r.subject_id: (r.support_count, round(r.consensus_confidence, 6)) for r in spark.read.parquet(f"{out}/fused").collect()}
    assert got == {"a": (2, 0.6), "c": (1, 0.8)}


def test_windowed_counts(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert incremental.windowed_counts(e).groupBy().sum("n").first()[0] == e.count()
