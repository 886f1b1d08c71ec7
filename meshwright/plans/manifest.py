"""Manifests: what to read, how to convert and align it, and how to run. Unknown keys are ignored."""

from __future__ import annotations

import warnings
from typing import Any, Literal

import yaml
from pydantic import AliasChoices, BaseModel, ConfigDict, Field, field_validator, model_validator

from meshwright.operators.matching import REGISTRY, STAND_INS, selected
from meshwright.plans.errors import ManifestError


class _Part(BaseModel):
    model_config = ConfigDict(extra="ignore", populate_by_name=True)


class Fetch(_Part):
    type: Literal["local", "http", "https", "git", "s3"] = "local"
    path: str | None = None
    paths: list[str] | None = None
    url: str | None = None
    branch: str | None = None
    credentials: dict[str, str] | None = None

    @model_validator(mode="after")
    def _some_place(self) -> Fetch:
        if self.type == "local" and not (self.path or self.paths):
            raise ValueError("a local fetch needs path or paths")
        if self.type != "local" and not self.url:
            raise ValueError(f"a {self.type} fetch needs a url")
        return self

    def places(self) -> list[str]:
        return list(self.paths or []) or [self.path or self.url or ""]


class Convert(_Part):
    type: str = "xsd"
    options: dict[str, Any] = Field(default_factory=dict)
    namespace: str | None = None
    prefix: str | None = None


class Source(_Part):
    id: str = Field(validation_alias=AliasChoices("id", "identifier"))
    fetch: Fetch
    convert: Convert = Field(default_factory=Convert)
    enabled: bool = True
    description: str | None = None

    @field_validator("id")
    @classmethod
    def _valid(cls, v: str) -> str:
        if not v.strip() or any(c in '/\\:*?"<>|' for c in v):
            raise ValueError(f"not an identifier: {v!r}")
        return v.strip()


class MetaOntology(_Part):
    type: str = "generic"
    options: dict[str, Any] = Field(default_factory=dict)


def _known(names: list[str]) -> list[str]:
    """Matchers that aren't known are left out with a warning; names of external tools stay, and others stand in for them."""
    known, unknown = selected(names)
    if unknown:
        warnings.warn(f"unknown matchers are left out: {', '.join(unknown)}; known: {', '.join(sorted(m.name for m in REGISTRY.values()))}", stacklevel=2)
    if outside := [n for n in names if n.lower() in STAND_INS]:
        warnings.warn("external matchers are not run; " + ", ".join(f"{REGISTRY[STAND_INS[n.lower()]].name} stands in for {n}" for n in outside), stacklevel=2)
    if names and not known:
        raise ValueError("none of the matchers is known")
    return [n for n in names if n not in unknown]


class Alignment(_Part):
    matchers: list[str] = Field(default_factory=list)
    timeout: float = Field(300.0, gt=0)
    threshold: float = Field(0.5, ge=0, le=1)
    voting: str = "majority"
    resolution: str = "confidence"

    _matchers = field_validator("matchers")(_known)


class PipelineOptions(_Part):
    max_retries: int = Field(3, ge=0)
    retry_delay: float = Field(1.0, ge=0)
    parallel_sources: bool = False
    checkpoint_enabled: bool = True
    fail_fast: bool = False
    cleanup_on_success: bool = False
    single_files: bool = True


class Manifest(_Part):
    name: str
    version: str = "1.0"
    description: str | None = None
    meta_ontology: MetaOntology = Field(default_factory=MetaOntology)
    sources: list[Source] = Field(min_length=1)
    matchers: list[str] = Field(default_factory=list)
    alignment: Alignment = Field(default_factory=Alignment)
    pipeline: PipelineOptions = Field(default_factory=PipelineOptions)

    _matchers = field_validator("matchers")(_known)

    @model_validator(mode="after")
    def _distinct(self) -> Manifest:
        ids = [s.id for s in self.sources]
        if twice := sorted({i for i in ids if ids.count(i) > 1}):
            raise ValueError(f"source ids occur twice: {', '.join(twice)}")
        return self

    def matcher_names(self) -> list[str]:
        return self.matchers or self.alignment.matchers or ["LexicalExact", "TokenJaccard", "EditDistance"]

    def enabled(self) -> list[Source]:
        return [s for s in self.sources if s.enabled]


def load(path: str) -> Manifest:
    try:
        with open(path, encoding="utf-8") as f:
            return Manifest.model_validate(yaml.safe_load(f))
    except OSError as e:
        raise ManifestError(f"can't read {path}: {e}", "manifest") from e
    except (ValueError, yaml.YAMLError) as e:
        raise ManifestError(f"{path}: {e}", "manifest") from e
