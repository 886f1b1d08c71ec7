"""Views of the test tables as mappings, triples and a gold standard: the same definition as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.operators.triples import COLUMNS
from meshwright.vocab import CLASS, DATATYPE_PROPERTY, DOMAIN, LABEL, META, OBJECT_PROPERTY, OWL, RANGE, RDFS, SUBCLASS, TYPE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(c, pairs, other):
    out = None
    for k, v in pairs:
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(other)


def mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as the mapping rows of three matchers. ``ord`` is made of the row's key, so no global sort is needed."""
    rows = table(spark, sf_dir, "lineitem")
    return rows.select(
        F.concat(F.lit("part:"), F.col("l_partkey").cast("string")).alias("subject_id"),
        F.concat(F.lit("supp:"), (F.col("l_partkey") % 20 + F.when(F.col("l_suppkey") % 10 == 0, 1).otherwise(0)).cast("string")).alias("object_id"),
        _case(F.col("l_returnflag"), (("A", "skos:exactMatch"), ("N", "skos:closeMatch")), "skos:relatedMatch").alias("predicate_id"),
        (F.col("l_quantity") / 50.0).alias("confidence"),
        _case(F.col("l_linenumber") % 3, ((0, "AML"), (1, "BERTMap")), "LogMap").alias("matcher_name"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("line "), F.col("l_linenumber").cast("string"))).alias("mapping_justification"),
        ((F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber")) * (1 << 34) + F.col("l_partkey").cast("long") * (1 << 14) + F.col("l_suppkey")).alias("ord"),
    )


MAPPINGS_SQL = """m AS (SELECT 'part:' || l_partkey AS subject_id,
  'supp:' || (l_partkey % 20 + CASE WHEN l_suppkey % 10 = 0 THEN 1 ELSE 0 END) AS object_id,
  CASE l_returnflag WHEN 'A' THEN 'skos:exactMatch' WHEN 'N' THEN 'skos:closeMatch' ELSE 'skos:relatedMatch' END AS predicate_id,
  l_quantity / 50.0 AS confidence, CASE l_linenumber % 3 WHEN 0 THEN 'AML' WHEN 1 THEN 'BERTMap' ELSE 'LogMap' END AS matcher_name,
  CASE WHEN l_linestatus = 'O' THEN 'line ' || l_linenumber END AS mapping_justification,
  (CAST(l_orderkey AS BIGINT) * 8 + l_linenumber) * 17179869184 + CAST(l_partkey AS BIGINT) * 16384 + l_suppkey AS ord FROM lineitem)"""

FUSED_SQL = (
    MAPPINGS_SQL
    + """, per AS (SELECT subject_id, object_id, predicate_id, matcher_name, greatest(0.0, max(confidence)) AS c, min(ord) AS o FROM m {where} GROUP BY ALL),
 fused AS (SELECT subject_id, object_id, predicate_id, list(matcher_name ORDER BY o) AS ms, list(c ORDER BY o) AS cs, count(*) AS support_count, sum(c ORDER BY o) / count(*) AS consensus, min(o) AS ord FROM per GROUP BY subject_id, object_id, predicate_id)"""
)

GOLD_SQL = "gold AS (SELECT DISTINCT subject_id, object_id, predicate_id FROM m WHERE CAST(substr(subject_id, 6) AS BIGINT) % 3 = 0)"


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mappings(spark, sf_dir).where(F.substring("subject_id", 6, 20).cast("long") % 3 == 0)


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping rows under other column names, with zero, missing and unreadable confidences and missing subjects."""
    rows = table(spark, sf_dir, "lineitem")
    text = lambda c: F.col(c).cast("string")
    return rows.select(
        F.when(F.col("l_linenumber") != 7, F.concat(F.lit("part:"), text("l_partkey"))).alias("subject"), F.concat(F.lit("supp:"), text("l_suppkey")).alias("object"),
        F.when(F.col("l_returnflag") == "A", "skos:exactMatch").when(F.col("l_returnflag") == "N", "").alias("predicate"),
        F.when(F.col("l_quantity") == 1, "0").when(F.col("l_quantity") == 2, "n/a").when(F.col("l_quantity") > 3, (F.col("l_quantity") / 50.0).cast("string")).alias("confidence"),
        F.when(F.col("l_quantity") == 3, "0.25").alias("similarity"),
    )


DIRTY_SQL = """SELECT 'part:' || l_partkey AS subject_id, 'supp:' || l_suppkey AS object_id, CASE WHEN l_returnflag = 'A' THEN 'skos:exactMatch' ELSE 'skos:closeMatch' END AS predicate_id,
  CASE WHEN l_quantity = 1 THEN 0.0 WHEN l_quantity = 2 THEN 1.0 WHEN l_quantity = 3 THEN 0.25 ELSE round(l_quantity / 50.0, 6) END AS confidence
  FROM lineitem WHERE l_linenumber <> 7"""

_PROPS = (("knows", OBJECT_PROPERTY, "region:0", "region:1"), ("sellsIn", OBJECT_PROPERTY, "nation:1", "region:1"), ("locatedIn", OBJECT_PROPERTY, f"{META}Location", f"{META}Location"), ("hasSize", DATATYPE_PROPERTY, "nation:3", f"{RDFS}Literal"), ("hasCode", DATATYPE_PROPERTY, "region:2", f"{RDFS}Literal"))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations, suppliers and customers as a class hierarchy with labels and a few properties; some classes aren't declared."""
    none = F.lit(None).cast("string")
    row = lambda s, p, o, kind="iri": F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))
    name = lambda prefix, c: F.concat(F.lit(prefix + ":"), F.col(c).cast("string"))
    out = None
    for t, prefix, key, parent, label, declared in (
        ("region", "region", "r_regionkey", F.lit(f"{META}Location"), "r_name", F.lit(True)),
        ("nation", "nation", "n_nationkey", name("region", "n_regionkey"), "n_name", F.lit(True)),
        ("supplier", "supp", "s_suppkey", name("nation", "s_nationkey"), "s_name", F.lit(True)),
        ("customer", "cust", "c_custkey", name("nation", "c_nationkey"), "c_name", F.col("c_custkey") % 10 != 0),
    ):
        me = name(prefix, key)
        rows = F.array(row(me, SUBCLASS, parent), row(me, LABEL, F.col(label), "literal"))
        rows = F.when(declared, F.concat(rows, F.array(row(me, TYPE, F.lit(CLASS))))).otherwise(rows)
        part = table(spark, sf_dir, t).select(F.explode(rows).alias("x")).select("x.*")
        out = part if out is None else out.unionByName(part)
    fixed = [(f"prop:{n}", TYPE, k, "iri") for n, k, _, _ in _PROPS] + [(f"prop:{n}", DOMAIN, d, "iri") for n, _, d, _ in _PROPS] + [(f"prop:{n}", RANGE, r, "iri") for n, _, _, r in _PROPS]
    fixed += [("class:alone", TYPE, CLASS, "iri"), ("prop:loose", DOMAIN, "region:0", "iri"), ("_:r1", f"{OWL}allValuesFrom", "region:0", "iri"), ("_:r2", f"{OWL}unionOf", "_:l1", "bnode"), ("region:0", f"{OWL}complementOf", "region:1", "iri")]
    extra = spark.createDataFrame([(*r, None, None) for r in fixed], out.schema)
    return out.unionByName(extra).select(*COLUMNS).distinct()


def _triples_sql() -> str:
    parts = []
    for t, prefix, key, parent, label, where in (
        ("region", "region", "r_regionkey", f"'{META}Location'", "r_name", "true"), ("nation", "nation", "n_nationkey", "'region:' || n_regionkey", "n_name", "true"),
        ("supplier", "supp", "s_suppkey", "'nation:' || s_nationkey", "s_name", "true"), ("customer", "cust", "c_custkey", "'nation:' || c_nationkey", "c_name", "c_custkey % 10 <> 0"),
    ):
        me = f"'{prefix}:' || {key}"
        parts += [f"SELECT {me} AS s, '{SUBCLASS}' AS p, {parent} AS o, 'iri' AS o_kind FROM {t}", f"SELECT {me}, '{LABEL}', {label}, 'literal' FROM {t}", f"SELECT {me}, '{TYPE}', '{CLASS}', 'iri' FROM {t} WHERE {where}"]
    fixed = [(f"prop:{n}", TYPE, k, "iri") for n, k, _, _ in _PROPS] + [(f"prop:{n}", DOMAIN, d, "iri") for n, _, d, _ in _PROPS] + [(f"prop:{n}", RANGE, r, "iri") for n, _, _, r in _PROPS]
    fixed += [("class:alone", TYPE, CLASS, "iri"), ("prop:loose", DOMAIN, "region:0", "iri"), ("_:r1", f"{OWL}allValuesFrom", "region:0", "iri"), ("_:r2", f"{OWL}unionOf", "_:l1", "bnode"), ("region:0", f"{OWL}complementOf", "region:1", "iri")]
    parts.append("SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in fixed) + ") v(s, p, o, o_kind)")
    return "g AS (" + "\n UNION ".join(parts) + ")"


TRIPLES_SQL = _triples_sql()
CLOSURE_SQL = f"{TRIPLES_SQL}, c(s, o) AS (SELECT s, o FROM g WHERE p = '{SUBCLASS}' UNION SELECT c.s, e.o FROM c JOIN g e ON e.s = c.o AND e.p = '{SUBCLASS}')"
CYCLE = (("a", "b"), ("b", "a"), ("b", "c"), ("d", "d"))
