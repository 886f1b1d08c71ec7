"""Structural, profile and rule-based consistency checks of a graph; findings are rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshwright.operators.reasoning import materialize
from meshwright.operators.triples import classes, match
from meshwright.vocab import DATATYPE_PROPERTY, DOMAIN, FINDINGS, OBJECT_PROPERTY, OWL, RDF, SUBCLASS, TYPE

PROFILES = ("EL", "QL", "RL", "DL", "FULL")
#: Predicates that a profile doesn't allow.
FORBIDDEN = {"EL": (f"{OWL}allValuesFrom", f"{OWL}complementOf"), "QL": (f"{OWL}unionOf",), "RL": (), "DL": (), "FULL": ()}


@dataclass(frozen=True)
class ValidationResult:
    is_valid: bool
    findings: DataFrame
    profile: str


def _findings(df: DataFrame, severity: str, rule: str, message) -> DataFrame:
    return df.select(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), message.alias("message"), F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("o").alias("object"))


def structural(g: DataFrame) -> DataFrame:
    """Warnings: subclasses and domains that aren't declared classes, and domains of undeclared properties."""
    declared = classes(g)
    props = g.where((F.col("p") == TYPE) & F.col("o").isin(OBJECT_PROPERTY, DATATYPE_PROPERTY, f"{RDF}Property")).select("s")
    sub, domain = match(g, p=SUBCLASS), match(g, p=DOMAIN)
    say = lambda head, c: F.concat(F.lit(head), F.col(c))
    a = _findings(sub.join(declared, "s", "left_anti"), "warning", "undeclared_class", say("Subclass is not declared as a class: ", "s"))
    b = _findings(domain.join(props, "s", "left_anti"), "warning", "undeclared_property", say("Domain of an undeclared property: ", "s"))
    c = _findings(domain.where("o_kind = 'iri'").join(declared.select(F.col("s").alias("o")), "o", "left_anti"), "warning", "undeclared_domain", say("Domain is not declared as a class: ", "o"))
    return a.unionByName(b).unionByName(c)


def profile_findings(g: DataFrame, profile: str) -> DataFrame:
    if profile not in FORBIDDEN:
        raise ValueError(f"unknown profile: {profile}")
    rows = g.where(F.col("p").isin(*FORBIDDEN[profile])) if FORBIDDEN[profile] else g.limit(0)
    return _findings(rows, "error", f"profile_{profile.lower()}", F.concat(F.lit(f"Not allowed in OWL 2 {profile}: "), F.col("p")))


def clashes(g: DataFrame) -> DataFrame:
    """Errors after rule inference: members of disjoint classes or of a class and its complement, members of Nothing, terms both the same and different."""
    g = materialize(g)
    types = match(g, p=TYPE).select("s", F.col("o").alias("c"))
    apart = g.where(F.col("p").isin(f"{OWL}disjointWith", f"{OWL}complementOf")).select(F.col("s").alias("c1"), F.col("p").alias("why"), F.col("o").alias("c2"))
    both = types.withColumnRenamed("c", "c1").join(apart, "c1").join(types.withColumnRenamed("c", "c2"), ["s", "c2"])
    out = [both.select("s", F.col("why").alias("p"), F.col("c2").alias("o"), F.lit("disjoint_types").alias("rule")), types.where(F.col("c") == f"{OWL}Nothing").select("s", F.lit(TYPE).alias("p"), F.col("c").alias("o"), F.lit("member_of_nothing").alias("rule"))]
    same, different = match(g, p=f"{OWL}sameAs").select("s", "o"), match(g, p=f"{OWL}differentFrom").select("s", "o")
    out.append(same.join(different, ["s", "o"]).select("s", F.lit(f"{OWL}differentFrom").alias("p"), "o", F.lit("same_and_different").alias("rule")))
    rows = reduce(lambda a, b: a.unionByName(b), out).distinct()
    return rows.select(F.lit("error").alias("severity"), "rule", F.concat(F.lit("Inconsistent: "), F.col("s")).alias("message"), F.col("s").alias("subject"), F.col("p").alias("predicate"), F.col("o").alias("object"))


def validate(g: DataFrame, profile: str = "DL", consistency: bool = True) -> ValidationResult:
    """Structural and profile findings; for DL and FULL also clashes by rules (no description-logic reasoner). Valid without errors."""
    found = structural(g).unionByName(profile_findings(g, profile))
    if consistency and profile in ("DL", "FULL"):
        found = found.unionByName(clashes(g))
    return ValidationResult(found.where("severity = 'error'").isEmpty(), found, profile)


def is_consistent(g: DataFrame) -> bool:
    return clashes(g).isEmpty()


def empty_findings(g: DataFrame) -> DataFrame:
    return g.sparkSession.createDataFrame([], FINDINGS)
