"""Runs a manifest: meta-ontology, fetch, ingest, align, fuse. Every stage leaves a table in the work folder and is skipped on resume."""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from meshwright.operators import conflicts, fusion, matching, quality, triples, validation, voting
from meshwright.plans import manifest as manifests
from meshwright.plans import storage
from meshwright.plans.errors import AlignError, CheckpointError, ConvertError, FetchError, PlanError, PreflightError
from meshwright.sources import meta, rdf, schemas, sssom


@dataclass
class State:
    """What a run has done, as JSON in the work folder."""

    spark: SparkSession
    path: str
    manifest: str = ""
    status: str = "running"
    done: dict[str, list[str]] = field(default_factory=dict)
    errors: list[dict] = field(default_factory=list)

    def mark(self, stage: str, item: str = "all") -> None:
        self.done.setdefault(stage, []).append(item)
        self.save()

    def has(self, stage: str, item: str = "all") -> bool:
        return item in self.done.get(stage, [])

    def save(self) -> None:
        storage.write(self.spark, self.path, json.dumps({k: v for k, v in vars(self).items() if k not in ("spark", "path")}, indent=1))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> State | None:
        try:
            text = storage.read(spark, path)
            return None if text is None else cls(spark, path, **json.loads(text))
        except (ValueError, TypeError) as e:
            raise CheckpointError(f"can't read {path}: {e}", "resume") from e

    def resumable(self, manifest: str) -> bool:
        return self.manifest == manifest and self.status not in ("completed", "cancelled")


@dataclass
class Artifacts:
    meta: str = ""
    converted: dict[str, str] = field(default_factory=dict)
    mappings: dict[str, str] = field(default_factory=dict)
    fused: str = ""
    resolved: str = ""
    merged: str = ""
    merged_turtle: str = ""
    report: str = ""
    errors: list[dict] = field(default_factory=list)


def preflight(path: str, workdir: str, strict: bool = True) -> dict[str, str]:
    """Checks by name: "ok" or what is wrong."""
    out: dict[str, str] = {}

    def check(name: str, run) -> None:
        try:
            run()
            out[name] = "ok"
        except Exception as e:  # noqa: BLE001
            out[name] = str(e) or type(e).__name__

    check("manifest exists", lambda: open(path, "rb").close())
    check("manifest is valid", lambda: manifests.load(path))
    check("work folder is writable", lambda: (os.makedirs(workdir, exist_ok=True), open(os.path.join(workdir, ".probe"), "w").close(), os.remove(os.path.join(workdir, ".probe"))))
    check("modules are there", lambda: [__import__(m) for m in ("yaml", "pydantic", "pandas", "pyarrow")])
    if out["manifest is valid"] == "ok":
        m = manifests.load(path)
        check("meta-ontology is known", lambda: meta.REGISTRY.get(m.meta_ontology.type))
        check("converters are known", lambda: [schemas.converter(s.convert.type) for s in m.enabled()])
        check("local sources exist", lambda: [open(_local(path, p), "rb").close() for s in m.enabled() if s.fetch.type == "local" for p in s.fetch.places()])
    if strict and any(v != "ok" for v in out.values()):
        raise PreflightError("; ".join(f"{k}: {v}" for k, v in out.items() if v != "ok"), "preflight")
    return out


def _local(manifest_path: str, p: str) -> str:
    beside = os.path.join(os.path.dirname(os.path.abspath(manifest_path)), p)
    return p if os.path.isabs(p) or not os.path.exists(beside) else beside


def fetch(source: manifests.Source, manifest_path: str) -> list[str]:
    if source.fetch.type != "local":
        raise FetchError(f"fetching by {source.fetch.type} isn't available; copy the files and use local", "fetch", source.id)
    found = [_local(manifest_path, p) for p in source.fetch.places()]
    if missing := [p for p in found if not os.path.exists(p)]:
        raise FetchError(f"no such file: {', '.join(missing)}", "fetch", source.id)
    return found


def retried(run, retries: int, delay: float):
    """``run()``, again after recoverable errors, with a growing delay."""
    for attempt in range(retries + 1):
        try:
            return run()
        except PlanError as e:
            if not e.recoverable or attempt == retries:
                raise
            time.sleep(delay * 2**attempt)
    return None


def orchestrate(spark: SparkSession, manifest_path: str, workdir: str, resume: bool = False, validate: bool = False) -> Artifacts:
    m = manifests.load(manifest_path)
    digest = hashlib.sha256(m.model_dump_json().encode()).hexdigest()
    at = lambda *parts: "/".join([workdir.rstrip("/"), *parts])
    state = State.load(spark, at("state.json")) if resume else None
    if state is None or not state.resumable(digest):
        state = State(spark, at("state.json"), digest)
    state.status, out = "running", Artifacts()
    single = m.pipeline.single_files  # files for readers that can't take parts; they are streamed through the driver
    keep = m.pipeline.checkpoint_enabled

    def table(stage: str, item: str, path: str, make) -> DataFrame:
        if not (keep and state.has(stage, item) and storage.exists(spark, f"{path}/_SUCCESS")):
            make().write.mode("overwrite").parquet(path)
            state.mark(stage, item)
        return spark.read.parquet(path)

    try:
        provider = meta.REGISTRY.create(spark, m.meta_ontology.type, **m.meta_ontology.options)
        label = provider.name.lower().replace(" ", "-")
        out.meta = at("meta", f"{label}.parquet")
        meta_graph = table("meta", "all", out.meta, provider.graph)
        storage.write(spark, at("meta", f"{label}-meta-ontology.ttl"), rdf.render(meta_graph, "turtle"))
        matchers, _ = matching.selected(m.matcher_names())

        def failed(e: Exception, stage: str, kind: type[PlanError], source: str) -> None:
            error = e if isinstance(e, PlanError) else kind(str(e), stage, source)
            out.errors.append(error.to_dict())
            state.errors.append(error.to_dict())
            if m.pipeline.fail_fast:
                raise error from e

        def ingest(s: manifests.Source) -> tuple[manifests.Source, DataFrame] | None:
            path = at("converted", s.id, "triples.parquet")
            try:
                files = retried(lambda: fetch(s, manifest_path), m.pipeline.max_retries, m.pipeline.retry_delay)
                options = dict(s.convert.options) | ({"base": s.convert.namespace} if s.convert.namespace else {})
                return s, table("ingest", s.id, path, lambda: triples.union(*[schemas.convert_file(spark, f, s.convert.type, **options)[0] for f in files]))
            except Exception as e:  # noqa: BLE001
                failed(e, "ingest", ConvertError, s.id)
                return None

        enabled = m.enabled()
        if m.pipeline.parallel_sources:
            with ThreadPoolExecutor(max(1, min(8, len(enabled)))) as pool:
                ready = list(pool.map(ingest, enabled))
        else:
            ready = [ingest(s) for s in enabled]
        order = [s.id for s in enabled]
        out.errors.sort(key=lambda e: order.index(e["source"]) if e["source"] in order else len(order))
        graphs, mapped = [], []
        for s, g in [r for r in ready if r]:
            out.converted[s.id] = at("converted", s.id, "triples.parquet")
            storage.write(spark, at("converted", s.id, f"{s.id}.owl"), rdf.render(g, "xml"))
            graphs.append(g)
            path = at("mappings", f"{s.id}.parquet")

            def align(g=g, s=s):
                results = matching.run_alignment_parallel(g, meta_graph, matchers, timeout=m.alignment.timeout)
                bad = [f"{r.matcher_name}: {r.error}" for r in results if not r.success]
                got = matching.all_mappings(results)
                if got is None:
                    raise AlignError("; ".join(bad) or "no matchers", "align", s.id)
                return got

            try:
                mapped.append(table("align", s.id, path, lambda align=align: retried(align, m.pipeline.max_retries, m.pipeline.retry_delay)))
                out.mappings[s.id] = path
            except Exception as e:  # noqa: BLE001
                failed(e, "align", AlignError, s.id)
        rows = fusion.concat(*mapped) if mapped else matching.empty_mappings(spark)
        out.fused, out.resolved, out.merged = at("fused.parquet"), at("resolved.parquet"), at("merged.parquet")
        fused = table("fuse", "all", out.fused, lambda: fusion.fuse(rows, m.alignment.threshold))
        accepted = voting.vote(fused, voting.VotingConfig(strategy=m.alignment.voting), len(matchers)).accepted
        table("resolve", "all", out.resolved, lambda: conflicts.resolve(accepted, m.alignment.resolution).drop("conflict"))
        merged = table("merge", "all", out.merged, lambda: triples.union(*graphs, meta_graph))
        rdf.write_ntriples(merged, at("merged.nt"))
        sssom.write_table(spark.read.parquet(out.resolved), at("mappings.sssom"))
        if single:
            out.merged_turtle = storage.write(spark, at(f"merged-{label}.ttl"), rdf.render(merged, "turtle"))
            storage.write(spark, at("mappings.sssom.tsv"), sssom.exported(spark.read.parquet(out.resolved)))
        out.report = storage.write(spark, at("quality.txt"), quality.quality_report(fused, m.alignment.resolution))
        if validate:
            found = validation.validate(merged)
            found.findings.write.mode("overwrite").parquet(at("findings.parquet"))
        state.status = "completed"
        state.save()
        if m.pipeline.cleanup_on_success:
            storage.remove(spark, at("converted"))
        return out
    except PlanError:
        state.status = "failed"
        state.save()
        raise
    except Exception as e:
        state.status = "failed"
        state.save()
        raise PlanError(str(e), "run") from e


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Convert, align and merge the schemas of a manifest.")
    parser.add_argument("manifest")
    parser.add_argument("--workdir", default="work")
    parser.add_argument("--resume", action="store_true")
    parser.add_argument("--validate", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("meshwright").getOrCreate()
    try:
        out = orchestrate(spark, args.manifest, args.workdir, args.resume, args.validate)
        print(json.dumps(vars(out), indent=1))
        return 0
    except PlanError as e:
        print(json.dumps(e.to_dict(), indent=1))
        return 1


if __name__ == "__main__":
    raise SystemExit(main())
