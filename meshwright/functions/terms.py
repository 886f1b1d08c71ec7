"""Scalar functions over names, IRIs, types and formats, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from meshwright.vocab import PREDICATE_RANK, SKOS, XSD

#: Type names to XSD local names. Others are strings.
GENERIC_TYPES = {
    "string": "string", "integer": "integer", "int": "int", "long": "long", "short": "short", "byte": "byte", "decimal": "decimal", "float": "float", "double": "double",
    "boolean": "boolean", "date": "date", "time": "time", "datetime": "dateTime", "duration": "duration", "anyuri": "anyURI", "uri": "anyURI",
}
CSV_TYPES = {
    "string": "string", "integer": "integer", "int": "integer", "decimal": "decimal", "number": "decimal", "float": "float", "double": "double", "boolean": "boolean", "bool": "boolean",
    "date": "date", "datetime": "dateTime", "time": "time", "anyuri": "anyURI", "uri": "anyURI",
}
JSON_TYPES = {"string": "string", "number": "decimal", "integer": "integer", "boolean": "boolean", "null": "string"}
#: Characters that a sanitised name can't hold.
UNSAFE = " -./\\()[]{}<>&@#%?="
BOOLEAN_TOKENS = ("true", "false", "yes", "no", "0", "1", "t", "f", "y", "n")
#: Whole numbers with single underscores between digits; decimal or scientific numbers, ``nan`` and ``inf``.
INTEGER_PATTERN = r"[+-]?[0-9]+(_[0-9]+)*"
DECIMAL_PATTERN = r"(?i)[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?(e[+-]?[0-9]+)?|\.[0-9]+(_[0-9]+)*(e[+-]?[0-9]+)?|nan|inf|infinity)"
#: What a user's XML Schema type is by what its name (in lower case) holds; the first rule that fits counts, others are strings.
SIMPLE_TYPE_RULES = (
    ("integer", "int|long|short|byte"), ("decimal", "decimal|float|double|number"), ("dateTime", "date.*time|time.*date"), ("date", "^date$"), ("time", "time"), ("boolean", "bool"), ("anyURI", "uri"),
)
#: Alignment types that are mapping predicates by name; others are relatedMatch.
ALIGNMENT_PREDICATES = ("exactMatch", "closeMatch", "broadMatch", "narrowMatch")

_UNSAFE_CLASS = "[" + "".join(re.escape(c) for c in UNSAFE) + "]"


def local_name(c: Column) -> Column:
    """``{ns}L`` gives ``L``; nothing left gives ``Unnamed``."""
    rest = F.regexp_replace(c, r"^\{[^}]*\}", "")
    return F.when(rest == "", "Unnamed").otherwise(rest)


def sanitize_name(c: Column) -> Column:
    """Namespace and prefix off, unsafe characters to ``_``, ``n`` before a leading digit."""
    bare = F.substring_index(F.regexp_replace(c, r"^\{[^}]*\}", ""), ":", -1)
    safe = F.regexp_replace(bare, _UNSAFE_CLASS, "_")
    return F.when(safe.rlike("^[0-9]"), F.concat(F.lit("n"), safe)).otherwise(safe)


def sanitize_column_name(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t == "", "unnamed_column").otherwise(sanitize_name(t))


def safe_local(c: Column) -> Column:
    """Local name with all but letters, digits, ``.``, ``_`` and ``-`` replaced."""
    return F.regexp_replace(local_name(c), r"[^A-Za-z0-9._\-]", "_")


def iri_for(ns: Column, local: Column, base: str) -> Column:
    n = F.when(ns.isNull() | (ns == ""), F.lit(base)).otherwise(ns)
    return F.concat(n, F.when(n.rlike("[/#]$"), F.lit("")).otherwise(F.lit("#")), safe_local(local))


def create_iri(namespace: str | Column, name: Column) -> Column:
    return F.concat(F.lit(namespace) if isinstance(namespace, str) else namespace, sanitize_name(name))


def _mapped(c: Column, table: dict[str, str]) -> Column:
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.concat(F.lit(XSD), F.coalesce(m[c], F.lit("string")))


def xsd_of_generic(c: Column) -> Column:
    return _mapped(F.lower(c), GENERIC_TYPES)


def xsd_of_csv(c: Column) -> Column:
    return _mapped(F.lower(c), CSV_TYPES)


def xsd_of_json(c: Column) -> Column:
    return _mapped(c, JSON_TYPES)


def xsd_of_simple(c: Column) -> Column:
    """Range of an XSD simple type by its base's local name: a builtin by itself, others by what their name holds."""
    n, kind = F.lower(c), F.lit("string")
    for found, pattern in reversed(SIMPLE_TYPE_RULES):
        kind = F.when(n.rlike(pattern), found).otherwise(kind)
    return F.concat(F.lit(XSD), kind)


def display_name(iri: Column) -> Column:
    return F.substring_index(F.substring_index(iri, "#", -1), "/", -1)


def name_of_location(c: Column) -> Column:
    last = F.substring_index(c, "/", -1)
    return F.when(c.rlike("^https?://"), F.regexp_replace(F.regexp_replace(last, r"\.owl", ""), r"\.ttl", "")).otherwise(F.regexp_replace(last, r"(?<=.)\.[^.]*$", ""))


def artifact_name(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit(" "), F.lit("-"))


def predicate_rank(c: Column) -> Column:
    m = F.create_map(*[x for k, v in PREDICATE_RANK.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[c], F.lit(0))


def alignment_predicate(c: Column) -> Column:
    return F.concat(F.lit(SKOS), F.when(c.isin(*ALIGNMENT_PREDICATES), c).otherwise("relatedMatch"))


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def stat_title(c: Column) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def valid_identifier(c: Column) -> Column:
    return F.coalesce((F.trim(c) != "") & ~c.rlike(r'[/\\:*?"<>|]'), F.lit(False))


def boolean_token(c: Column) -> Column:
    return F.lower(F.trim(c)).isin(*BOOLEAN_TOKENS)


def integer_token(c: Column) -> Column:
    return F.trim(c).rlike(f"^(?:{INTEGER_PATTERN})$")


def decimal_token(c: Column) -> Column:
    return F.trim(c).rlike("(?i)^(?:" + DECIMAL_PATTERN.removeprefix("(?i)") + ")$")


def date_like(c: Column) -> Column:
    """At least four digits and one of ``- / .``."""
    return (F.length(F.regexp_replace(c, "[^0-9]", "")) >= 4) & c.rlike("[-/.]")
