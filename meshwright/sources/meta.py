"""Meta-ontologies: provider classes and their registry, the generic ontology, and alignments to upper ontologies."""

from __future__ import annotations

import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.functions.terms import ALIGNMENT_PREDICATES
from meshwright.operators import triples as tr
from meshwright.operators.triples import iri, literal
from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, LABEL, META, OBJECT_PROPERTY, ONTOLOGY, OWL, RANGE, RDFS, SKOS, SUBCLASS, TYPE

#: The generic meta-ontology.
GENERIC_CLASSES = (
    ("Entity", "Generic thing of interest across domains.", None),
    ("Agent", "Person, organization, or system capable of acting.", "Entity"),
    ("Contract", "Formal agreement or policy binding agents.", "Entity"),
    ("Event", "An occurrence situated in time.", "Entity"),
    ("Location", "Geospatial or jurisdictional reference.", "Entity"),
    ("Regulation", "Rule or regulatory instrument.", "Entity"),
    ("Metric", "Quantitative or qualitative measurement.", "Entity"),
)
GENERIC_OBJECT_PROPERTIES = (
    ("participatesIn", "Relates an agent to an event they participate in.", "Agent", "Event"),
    ("hasAgent", "Relates an entity to an agent involved with it.", "Entity", "Agent"),
    ("hasLocation", "Relates an entity to its location.", "Entity", "Location"),
    ("occursAt", "Relates an event to the location where it occurs.", "Event", "Location"),
    ("governedBy", "Relates an entity to a regulation that governs it.", "Entity", "Regulation"),
    ("subjectTo", "Relates an agent to a contract they are subject to.", "Agent", "Contract"),
    ("hasMeasurement", "Relates an entity to a metric that measures it.", "Entity", "Metric"),
    ("relatedTo", "Generic relationship between entities.", "Entity", "Entity"),
)
GENERIC_DATATYPE_PROPERTIES = (
    ("hasName", "The name of an entity.", "Entity"),
    ("hasDescription", "A textual description of an entity.", "Entity"),
    ("hasIdentifier", "A unique identifier for an entity.", "Entity"),
    ("hasTimestamp", "Temporal information associated with an event.", "Event"),
    ("hasValue", "The value of a metric.", "Metric"),
    ("hasUnit", "The unit of measurement for a metric.", "Metric"),
)
BFO, DOLCE = "http://purl.obolibrary.org/obo/", "http://www.loa.istc.cnr.it/dolce/dolce-owl/"
#: Alignments of the generic classes: class, ontology, local name, type of alignment.
UPPER_ALIGNMENTS = (
    ("Entity", "BFO", "BFO_0000001", "broadMatch"),
    ("Agent", "BFO", "BFO_0000004", "closeMatch"),
    ("Event", "BFO", "BFO_0000003", "exactMatch"),
    ("Location", "BFO", "BFO_0000029", "closeMatch"),
    ("Contract", "BFO", "BFO_0000031", "closeMatch"),
    ("Regulation", "BFO", "BFO_0000031", "closeMatch"),
    ("Metric", "BFO", "BFO_0000031", "closeMatch"),
    ("Entity", "DOLCE", "particular", "broadMatch"),
    ("Agent", "DOLCE", "agentive-physical-object", "exactMatch"),
    ("Event", "DOLCE", "perdurant", "exactMatch"),
    ("Location", "DOLCE", "physical-region", "closeMatch"),
    ("Contract", "DOLCE", "social-object", "exactMatch"),
    ("Regulation", "DOLCE", "social-object", "exactMatch"),
    ("Metric", "DOLCE", "quality", "closeMatch"),
)
#: Texts that mark the objects of each upper ontology.
UPPER_MARK = {"BFO": "obolibrary.org", "DOLCE": "loa.istc.cnr.it"}
#: Modules of the financial ontology and its address.
FINANCIAL_BASE = "https://spec.edmcouncil.org/fibo/ontology/"
FINANCIAL_MODULES = ("FND", "BE", "FBC", "LOAN", "SEC", "IND", "DER")


class Provider:
    """Gives a graph, the classes to align to, and how it describes its terms. ``build`` is called once and kept."""

    name, version = "", "1.0"

    def __init__(self, spark: SparkSession, namespace: str = META):
        self.spark, self.namespace, self._graph = spark, namespace, None

    def build(self) -> DataFrame:
        raise NotImplementedError

    def graph(self) -> DataFrame:
        if self._graph is None:
            self._graph = self.build().cache()
        return self._graph

    def release(self) -> None:
        """Give back the memory of the graph; it is built again when asked for."""
        if self._graph is not None:
            self._graph.unpersist()
            self._graph = None

    def alignment_targets(self) -> DataFrame:
        return tr.classes(self.graph())

    def top_level_classes(self) -> DataFrame:
        return tr.top_level_classes(self.graph())

    def properties(self) -> DataFrame:
        return tr.properties(self.graph())

    def descriptions(self) -> DataFrame:
        return tr.describe(self.graph(), (COMMENT, LABEL))

    def describe(self, term: str) -> str | None:
        row = self.descriptions().where(F.col("s") == term).first()
        return row["description"] if row else None

    def validate_alignments(self, mappings: DataFrame) -> DataFrame:
        """``mappings`` with a column ``valid``; without further knowledge all are."""
        return mappings.withColumn("valid", F.lit(True))

    def metadata(self) -> dict[str, str]:
        return {"name": self.name, "version": self.version, "namespace": self.namespace}


class GenericOntology(Provider):
    name = "generic"

    def build(self) -> DataFrame:
        ns = self.namespace
        rows = [iri(ns.rstrip("#/"), TYPE, ONTOLOGY), literal(ns.rstrip("#/"), LABEL, "Meta-Ontology"), literal(ns.rstrip("#/"), COMMENT, "Core meta-ontology for federated semantic integration")]
        said = lambda n, kind, text: [iri(ns + n, TYPE, kind), literal(ns + n, LABEL, n), literal(ns + n, COMMENT, text)]
        for n, text, parent in GENERIC_CLASSES:
            rows += said(n, CLASS, text) + ([iri(ns + n, SUBCLASS, ns + parent)] if parent else [])
        for n, text, domain, range_ in GENERIC_OBJECT_PROPERTIES:
            rows += said(n, OBJECT_PROPERTY, text) + [iri(ns + n, DOMAIN, ns + domain), iri(ns + n, RANGE, ns + range_)]
        for n, text, domain in GENERIC_DATATYPE_PROPERTIES:
            rows += said(n, DATATYPE_PROPERTY, text) + [iri(ns + n, DOMAIN, ns + domain), iri(ns + n, RANGE, f"{RDFS}Literal")]
        return tr.graph(self.spark, rows)

    def top_level_classes(self) -> DataFrame:
        return self.spark.createDataFrame([(f"{self.namespace}Entity",)], "s string")

    def descriptions(self) -> DataFrame:
        return tr.describe(self.graph(), (COMMENT,))


class CustomOntology(Provider):
    """An ontology in RDF files, read once."""

    name = "custom"

    def __init__(self, spark: SparkSession, path: str | list[str], name: str | None = None, namespace: str = META):
        super().__init__(spark, namespace)
        self.path = path
        first = path if isinstance(path, str) else path[0]
        last = first.rsplit("/", 1)[-1]
        self.name = name or (re.sub(r"\.(owl|ttl)", "", last) if re.match("https?://", first) else os.path.splitext(last)[0])

    def build(self) -> DataFrame:
        from meshwright.sources.rdf import read

        return read(self.spark, self.path)


class ModuleOntology(Provider):
    """Modules of a published ontology from a folder of files named after them; ``download`` may fetch missing ones."""

    name = "financial"

    def __init__(self, spark: SparkSession, cache_dir: str, modules: tuple[str, ...] = ("FND", "BE"), known: tuple[str, ...] = FINANCIAL_MODULES, base: str = FINANCIAL_BASE, download=None):
        super().__init__(spark, base)
        if unknown := sorted(set(modules) - set(known)):
            raise ValueError(f"unknown modules: {', '.join(unknown)}; known: {', '.join(known)}")
        self.cache_dir, self.modules, self.download = cache_dir, modules, download

    def build(self) -> DataFrame:
        from meshwright.sources.rdf import read

        files = []
        for m in self.modules:
            found = [p for e in ("rdf", "owl", "ttl", "nt") if os.path.exists(p := os.path.join(self.cache_dir, f"{m}.{e}"))]
            if not found and self.download:
                found = [self.download(f"{self.namespace}{m}/", os.path.join(self.cache_dir, f"{m}.rdf"))]
            files += found[:1]
        if not files:
            raise FileNotFoundError(f"no module files in {self.cache_dir}")
        return read(self.spark, files)

    def alignment_targets(self) -> DataFrame:
        return tr.classes(self.graph(), (CLASS,), self.namespace)

    def top_level_classes(self) -> DataFrame:
        return tr.top_level_classes(self.graph(), self.namespace)

    def descriptions(self) -> DataFrame:
        return tr.describe(self.graph(), (COMMENT, f"{SKOS}definition", LABEL))

    def validate_alignments(self, mappings: DataFrame) -> DataFrame:
        known = self.graph().select(F.col("s").alias("object_id")).distinct().withColumn("_known", F.lit(True))
        return mappings.join(known, "object_id", "left").withColumn("valid", F.coalesce("_known", F.lit(False))).drop("_known")


class CompositeOntology(Provider):
    """Several providers in order: union of graphs, first description, valid if any says so."""

    name = "composite"

    def __init__(self, providers: list[Provider]):
        if not providers:
            raise ValueError("a composite needs providers")
        super().__init__(providers[0].spark, providers[0].namespace)
        self.providers = providers

    def build(self) -> DataFrame:
        return tr.union(*[p.graph() for p in self.providers])

    def _ordered(self, tables: list[DataFrame]) -> DataFrame:
        return tr.ordered_union([t.withColumn("pos", F.lit(0)) for t in tables], "s").select("s")

    def alignment_targets(self) -> DataFrame:
        return self._ordered([p.alignment_targets() for p in self.providers])

    def top_level_classes(self) -> DataFrame:
        return self._ordered([p.top_level_classes() for p in self.providers])

    def properties(self) -> DataFrame:
        return tr.first_value([p.properties() for p in self.providers], "s", "kind")

    def descriptions(self) -> DataFrame:
        return tr.first_value([p.descriptions() for p in self.providers], "s", "description")

    def validate_alignments(self, mappings: DataFrame) -> DataFrame:
        checked = [p.validate_alignments(mappings).select("subject_id", "object_id", "predicate_id", "matcher_name", "valid") for p in self.providers]
        votes = reduce(lambda a, b: a.unionByName(b), checked).groupBy("subject_id", "object_id", "predicate_id", "matcher_name").agg(F.max("valid").alias("valid"))
        return mappings.join(votes, ["subject_id", "object_id", "predicate_id", "matcher_name"], "left")


class Registry:
    """Provider classes by name."""

    def __init__(self) -> None:
        self._known: dict[str, type[Provider]] = {}
        self.aliases = {"fibo": "financial"}  # names that manifests use
        self.reset()

    def reset(self) -> None:
        self._known = {"generic": GenericOntology, "custom": CustomOntology, "financial": ModuleOntology, "composite": CompositeOntology}

    def register(self, name: str, kind: type[Provider], replace: bool = False) -> None:
        if not (isinstance(kind, type) and issubclass(kind, Provider)):
            raise TypeError(f"{kind!r} is no provider class")
        if name.lower() in self._known and not replace:
            raise ValueError(f"already registered: {name}")
        self._known[name.lower()] = kind

    def unregister(self, name: str) -> None:
        if name.lower() not in self._known:
            raise ValueError(f"not registered: {name}")
        del self._known[name.lower()]

    def is_registered(self, name: str) -> bool:
        return self.aliases.get(name.lower(), name.lower()) in self._known

    def list(self) -> list[str]:
        return sorted(self._known)

    def get(self, name: str) -> type[Provider]:
        if not self.is_registered(name):
            raise ValueError(f"unknown meta-ontology: {name}; known: {', '.join(self.list())}")
        return self._known[self.aliases.get(name.lower(), name.lower())]

    def create(self, spark: SparkSession, name: str, **options) -> Provider:
        """Nested configurations ``{"type": ..., "options": {...}}`` of a composite are created as well."""
        kind = self.get(name)
        try:
            if issubclass(kind, CompositeOntology):
                return kind([p if isinstance(p, Provider) else self.create(spark, p["type"], **p.get("options", {})) for p in options.get("providers", [])])
            return kind(spark, **options)
        except (TypeError, ValueError):
            raise
        except Exception as e:
            raise RuntimeError(f"{name}: {e}") from e


REGISTRY = Registry()


def upper_alignments(spark: SparkSession, namespace: str = META) -> DataFrame:
    """cls, class_name, ontology, target, alignment_type: a dimension of 14 rows."""
    at = {"BFO": BFO, "DOLCE": DOLCE}
    return spark.createDataFrame([(namespace + c, c, u, at[u] + t, k) for c, u, t, k in UPPER_ALIGNMENTS], "cls string, class_name string, ontology string, target string, alignment_type string")


def alignments_for_class(spark: SparkSession, name: str, ontology: str | None = None) -> DataFrame:
    rows = upper_alignments(spark).where(F.col("class_name") == name)
    return rows.where(F.col("ontology") == ontology) if ontology else rows


def alignment_summary(spark: SparkSession) -> DataFrame:
    """class_name, BFO, DOLCE: targets of every generic class, maybe none."""
    names = spark.createDataFrame([(c,) for c, _, _ in GENERIC_CLASSES], "class_name string")
    some = upper_alignments(spark).groupBy("class_name").pivot("ontology", ["BFO", "DOLCE"]).agg(F.array_sort(F.collect_list("target")))
    none = F.array().cast("array<string>")
    return names.join(some, "class_name", "left").select("class_name", F.coalesce("BFO", none).alias("BFO"), F.coalesce("DOLCE", none).alias("DOLCE"))


def alignment_graph(spark: SparkSession, namespace: str = META) -> DataFrame:
    """A mapping triple and five annotation triples for each alignment."""
    rows = upper_alignments(spark, namespace)
    skos = F.concat(F.lit(SKOS), F.when(F.col("alignment_type").isin(*ALIGNMENT_PREDICATES), F.col("alignment_type")).otherwise("relatedMatch"))
    node = F.concat(F.lit(namespace), "class_name", F.lit("_to_"), "ontology", F.lit("_alignment"))
    none = F.lit(None).cast("string")
    t = lambda s, p, o, kind="iri": F.struct(s.alias("s"), p.alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))
    why = F.concat("class_name", F.lit(" is aligned to "), "ontology")
    six = F.array(
        t(F.col("cls"), skos, F.col("target")), t(node, F.lit(TYPE), F.lit(f"{OWL}Axiom")), t(node, F.lit(f"{OWL}annotatedSource"), F.col("cls")),
        t(node, F.lit(f"{OWL}annotatedProperty"), skos), t(node, F.lit(f"{OWL}annotatedTarget"), F.col("target")), t(node, F.lit(COMMENT), why, "literal"),
    )
    return rows.select(F.explode(six).alias("x")).select("x.*").distinct()


def merge_with_upper_ontology(base: DataFrame, ontology: str | None = None) -> DataFrame:
    """``base`` and the alignments, on demand only the triples whose object lies in one upper ontology."""
    rows = alignment_graph(base.sparkSession)
    return tr.union(base, rows.where(F.col("o").contains(UPPER_MARK[ontology])) if ontology else rows)
