"""Registered queries over files, converters, orderings, rules and runs, each with SQL that states the expected rows."""

from __future__ import annotations

import json
import os
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.functions import terms as fn
from meshwright.operators import conflicts, fusion, matching, ordering, quality, reasoning, validation, voting
from meshwright.operators import triples as tr
from meshwright.plans import errors, manifest, pipeline
from meshwright.plans import views as v
from meshwright.plans.catalogue import _COLS, _SHOWN, FUSED, _fused, _shown, query
from meshwright.plans.views import GOLD_SQL, MAPPINGS_SQL, TRIPLES_SQL
from meshwright.sources import meta, rdf, schemas, sssom
from meshwright.streaming import incremental
from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, KEY, LABEL, MAPPINGS, OBJECT_PROPERTY, ONTOLOGY, OWL, RANGE, RDFS, SCHEMA_BASE, SUBCLASS, TYPE, XSD

B = SCHEMA_BASE
ROOT = (B.rstrip("/"), TYPE, ONTOLOGY)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    reasoning.cut(spark.range(1))
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def expected(rows: list[tuple], source: str, once: list[tuple] = (ROOT,)) -> str:
    """SQL of triples: ``rows`` for each row of ``source``, in whose texts {k} and {n} stand for its columns; literals have a fourth and maybe a fifth part."""

    def select(r: tuple, table: str) -> str:
        text = lambda t: "'" + t.replace("'", "''").replace("{k}", "' || k || '").replace("{n}", "' || n || '") + "'"
        kind, datatype = (r[3], r[4]) if len(r) > 4 else (r[3] if len(r) > 3 else "iri", "")
        return f"SELECT {text(r[0])} AS s, {text(r[1])} AS p, {text(r[2])} AS o, '{kind}' AS o_kind, '{datatype}' AS o_datatype{table}"

    return f"t AS ({source}) " + "\n UNION ".join([select(r, " FROM t") for r in rows] + [select(r, "") for r in once])


def shown(g: DataFrame) -> DataFrame:
    return g.select("s", "p", "o", "o_kind", F.coalesce("o_datatype", F.lit("")).alias("o_datatype"))


def files(spark: SparkSession, d: str, name: str, text: str) -> DataFrame:
    """A file for each supplier; {k} and {n} in ``text`` stand for its key and name."""
    k, n = F.col("s_suppkey").cast("string"), F.col("s_name")
    put = lambda t: F.replace(F.replace(F.lit(t), F.lit("{k}"), k), F.lit("{n}"), n)
    return v.table(spark, d, "supplier").select(put(name).alias("path"), put(text).cast("binary").alias("content"))


SUPPLIERS = "SELECT s_suppkey AS k, s_name AS n FROM supplier"


def said(s: str, kind: str, label: str, *more: tuple) -> list[tuple]:
    """A declared term with its label, and what else is said of it."""
    return [(s, TYPE, kind), (s, LABEL, label, "literal"), *((s, *m) for m in more)]


def required(prop: str, owner: str) -> list[tuple]:
    r = f"{prop}_Required_Restriction"
    return [(r, TYPE, f"{OWL}Restriction"), (r, f"{OWL}onProperty", prop), (r, f"{OWL}minCardinality", "1", "literal", f"{XSD}integer"), (owner, SUBCLASS, r)]


# --- converters ------------------------------------------------------------------------------------

_OBJECT = {
    "title": "S{k}", "type": "object", "description": "of {n}", "required": ["id{k}"],
    "properties": {
        "id{k}": {"type": "integer", "description": "the key"}, "kind{k}": {"type": ["string", "null"], "enum": ["A", "B"]},
        "parts{k}": {"type": "array", "items": {"type": "object", "title": "Part{k}", "properties": {"size{k}": {"type": "number"}}}},
        "home{k}": {"type": "object", "properties": {"open{k}": {"type": "boolean"}}}, "notes{k}": {"type": "array", "items": {"type": "string"}},
    },
    "patternProperties": {"^x-{k}": {"type": "string"}}, "additionalProperties": {"type": "integer"},
}
_S, _P, _H = f"{B}S{{k}}", f"{B}Part{{k}}", f"{B}home{{k}}Type"
_OBJECT_ROWS = [
    *said(_S, CLASS, "S{k}", (COMMENT, "of {n}", "literal")),
    *said(f"{B}id{{k}}", DATATYPE_PROPERTY, "id{k}", (COMMENT, "the key", "literal"), (DOMAIN, _S), (RANGE, f"{XSD}integer")), *required(f"{B}id{{k}}", _S),
    *said(f"{B}kind{{k}}", DATATYPE_PROPERTY, "kind{k}", (COMMENT, "Allowed value: A", "literal"), (COMMENT, "Allowed value: B", "literal"), (DOMAIN, _S), (RANGE, f"{XSD}string")),
    *said(f"{B}parts{{k}}", OBJECT_PROPERTY, "parts{k}", (DOMAIN, _S), (RANGE, _P)), *said(_P, CLASS, "Part{k}"),
    *said(f"{B}size{{k}}", DATATYPE_PROPERTY, "size{k}", (DOMAIN, _P), (RANGE, f"{XSD}decimal")),
    *said(f"{B}home{{k}}", OBJECT_PROPERTY, "home{k}", (DOMAIN, _S), (RANGE, _H)), *said(_H, CLASS, "home{k}Type"),
    *said(f"{B}open{{k}}", DATATYPE_PROPERTY, "open{k}", (DOMAIN, _H), (RANGE, f"{XSD}boolean")),
    *said(f"{B}notes{{k}}", OBJECT_PROPERTY, "notes{k}", (DOMAIN, _S), (RANGE, f"{XSD}string")),
    *said(f"{B}S{{k}}_^x_{{k}}_Pattern", DATATYPE_PROPERTY, "S{k}_^x_{k}_Pattern", (DOMAIN, _S), (RANGE, f"{XSD}string")),
    *said(f"{B}S{{k}}_AdditionalProperty", DATATYPE_PROPERTY, "S{k}_AdditionalProperty", (DOMAIN, _S), (RANGE, f"{XSD}integer")),
]


@query(expected(_OBJECT_ROWS, SUPPLIERS))
def json_schema_objects(spark, d):
    return shown(schemas.convert_contents(files(spark, d, "s{k}.json", json.dumps(_OBJECT)), "json-schema"))


_COMBINED = {
    "title": "Root{k}", "allOf": [{"$ref": "#/definitions/Base{k}"}, {"type": "object", "properties": {"x{k}": {"type": "integer"}}}],
    "definitions": {"Base{k}": {"type": "object", "properties": {"next{k}": {"$ref": "#/definitions/Base{k}"}}}, "Any{k}": {"anyOf": [{"$ref": "#/definitions/Base{k}"}, {"type": "object"}]}, "Multi{k}": {"type": ["string", "integer"]}},
    "$defs": {"One{k}": {"oneOf": [{"type": "object"}, {"type": "object"}]}}, "components": {"schemas": {"Late{k}": {"type": "object"}}},
}
_BASE, _ANY, _ONE, _MULTI, _RT = (f"{B}{x}{{k}}" for x in ("Base", "Any", "One", "Multi", "Root"))
_COMBINED_ROWS = [
    *said(_RT, CLASS, "Root{k}", (SUBCLASS, _BASE), (SUBCLASS, f"{_RT}_AllOf_1")), *said(f"{_RT}_AllOf_1", CLASS, "Root{k}_AllOf_1"),
    *said(f"{B}x{{k}}", DATATYPE_PROPERTY, "x{k}", (DOMAIN, f"{_RT}_AllOf_1"), (RANGE, f"{XSD}integer")), *said(_BASE, CLASS, "Base{k}", (SUBCLASS, _ANY)),
    *said(f"{B}next{{k}}", OBJECT_PROPERTY, "next{k}", (DOMAIN, _BASE), (RANGE, _BASE)), *said(_ANY, CLASS, "Any{k}", (COMMENT, "Any of 2 variants", "literal")),
    *said(f"{_ANY}_AnyOf_1", CLASS, "Any{k}_AnyOf_1", (SUBCLASS, _ANY)), *said(_ONE, CLASS, "One{k}", (COMMENT, "Exactly one of 2 variants", "literal")),
    *said(f"{_ONE}_OneOf_0", CLASS, "One{k}_OneOf_0", (SUBCLASS, _ONE), (f"{OWL}disjointWith", f"{_ONE}_OneOf_1")), *said(f"{_ONE}_OneOf_1", CLASS, "One{k}_OneOf_1", (SUBCLASS, _ONE)),
    *said(_MULTI, CLASS, "Multi{k}", (COMMENT, "Union type: string, integer", "literal"), (SUBCLASS, f"{XSD}string"), (SUBCLASS, f"{XSD}integer")), *said(f"{B}Late{{k}}", CLASS, "Late{k}"),
]


@query(expected(_COMBINED_ROWS, SUPPLIERS))
def json_schema_combinations(spark, d):
    return shown(schemas.convert_contents(files(spark, d, "c{k}.json", json.dumps(_COMBINED)), "json-schema"))


_XML = """<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:s{k}#" xmlns:t="urn:s{k}#">
<xs:complexType name="Base"><xs:attribute name="id{k}" type="xs:int"/><xs:attributeGroup ref="t:More"/></xs:complexType>
<xs:attributeGroup name="More"><xs:attribute name="size{k}" type="t:Size"/><xs:attributeGroup ref="t:More"/></xs:attributeGroup>
<xs:simpleType name="Size"><xs:restriction base="xs:decimal"/></xs:simpleType>
<xs:complexType name="Item"><xs:complexContent><xs:extension base="t:Base"><xs:sequence><xs:element name="price" type="xs:decimal"/>
<xs:choice><xs:element name="part" type="t:Base"/><xs:element name="my-stamp"><xs:complexType><xs:attribute name="at{k}" type="xs:dateTime"/></xs:complexType></xs:element></xs:choice>
</xs:sequence></xs:extension></xs:complexContent></xs:complexType><xs:element name="root" type="t:Item"/></xs:schema>"""
_N = "urn:s{k}#"
_XML_ROWS = [
    *said(f"{_N}Base", CLASS, "Base"), *said(f"{B}#id{{k}}" if B[-1] not in "/#" else f"{B}id{{k}}", DATATYPE_PROPERTY, "id{k}", (DOMAIN, f"{_N}Base"), (RANGE, f"{XSD}integer")),
    *said(f"{B}size{{k}}", DATATYPE_PROPERTY, "size{k}", (DOMAIN, f"{_N}Base"), (RANGE, f"{XSD}decimal")), *said(f"{_N}Item", CLASS, "Item", (SUBCLASS, f"{_N}Base")),
    *said(f"{_N}price", OBJECT_PROPERTY, "price", (DOMAIN, f"{_N}Item"), (RANGE, f"{XSD}decimal")), *said(f"{_N}part", OBJECT_PROPERTY, "part", (DOMAIN, f"{_N}Item"), (RANGE, f"{_N}Base")),
    *said(f"{_N}my-stamp", OBJECT_PROPERTY, "my-stamp", (DOMAIN, f"{_N}Item")), *said(f"{B}at{{k}}", DATATYPE_PROPERTY, "at{k}", (RANGE, f"{XSD}dateTime")),
    *said(f"{_N}root", OBJECT_PROPERTY, "root", (RANGE, f"{_N}Item")),
]


@query(expected([*_XML_ROWS, (f"{_N}my-stamp", RANGE, f"{_N}my-stamp"), (f"{B}at{{k}}", DOMAIN, f"{_N}my-stamp"), (f"{_N}my-stamp", TYPE, CLASS)], SUPPLIERS))
def xml_schemas(spark, d):
    return shown(schemas.convert_contents(files(spark, d, "x{k}.xsd", _XML), "xsd"))


_ECHO = """import sys
i, o = sys.stdin.buffer, sys.stdout.buffer
for n in i:
    k = i.read(int(n)).split(b'urn:s')[1].split(b'#')[0]
    made = b'<urn:s' + k + b'#Made> a <urn:tool#Class> .'
    o.write(b'%d\\n%s' % (len(made), made))
    o.flush()
"""


@query(f"SELECT 'urn:s' || s_suppkey || '#Made' AS s, '{TYPE}' AS p, CASE WHEN s_suppkey % 2 = 0 THEN 'urn:tool#Class' ELSE '{CLASS}' END AS o FROM supplier")
def external_converter(spark, d):
    """A tool of one's own for XML Schema, which stays, reads file after file and writes RDF; where it fails, the built-in converter steps in."""
    import sys

    text = '<xs:schema xmlns:xs="http://www.w3.org/2001/XMLSchema" targetNamespace="urn:s{k}#"><xs:complexType name="Made"/></xs:schema>'
    all_ = files(spark, d, "x{k}.xsd", text)
    even = F.regexp_extract("path", "x([0-9]+)", 1).cast("int") % 2 == 0
    made = schemas.convert_contents(all_.where(even), "xsd", command=[sys.executable, "-c", _ECHO], stays=True)
    own = schemas.convert_contents(all_.where(~even), "xsd", command=["no-such-tool"])
    return made.unionByName(own).where(F.col("p") == TYPE).where(F.col("s").endswith("#Made")).select("s", "p", "o")


_ROW = f"{B}Row"
_TABLE_ROWS = [
    *said(f"{B}id{{k}}", DATATYPE_PROPERTY, "id{k}", (DOMAIN, _ROW), (RANGE, f"{XSD}integer")), *said(f"{B}the_name{{k}}", DATATYPE_PROPERTY, "the name{k}", (DOMAIN, _ROW), (RANGE, f"{XSD}string")),
    *said(f"{B}share{{k}}", DATATYPE_PROPERTY, "share{k}", (DOMAIN, _ROW), (RANGE, f"{XSD}decimal")), *said(f"{B}since{{k}}", DATATYPE_PROPERTY, "since{k}", (DOMAIN, _ROW), (RANGE, f"{XSD}date")),
    *said(f"{B}open{{k}}", DATATYPE_PROPERTY, "open{k}", (DOMAIN, _ROW), (RANGE, f"{XSD}boolean")), (_ROW, COMMENT, "Represents a row in t{k}.tsv", "literal"),
]
_TABLE = "id{k}\tthe name{k}\tshare{k}\tsince{k}\topen{k}\n{k}\t{n}\t0.{k}\t2024-01-15\tyes\n27\tx\t1e3\t2023/11/30\tno\nragged\n"


@query(expected(_TABLE_ROWS, SUPPLIERS, [ROOT, *said(_ROW, CLASS, "Row")]))
def delimited_tables(spark, d):
    return shown(schemas.convert_contents(files(spark, d, "t{k}.tsv", _TABLE), "csv"))


_ABOUT = {"title": "Things", "description": "All things", "row_class": "Thing", "tableSchema": {"columns": [{"name": "key", "titles": "id", "datatype": "integer", "description": "the key"}, {"name": "label", "titles": ["name", "names"], "title": "Label", "required": True}, {"name": "third", "datatype": {"base": "date"}}]}}
_THING = f"{B}Thing"
_ABOUT_ROWS = [
    *said(_THING, CLASS, "Things", (COMMENT, "All things", "literal")), *said(f"{B}key", DATATYPE_PROPERTY, "key", (COMMENT, "the key", "literal"), (DOMAIN, _THING), (RANGE, f"{XSD}integer")),
    *said(f"{B}label", DATATYPE_PROPERTY, "Label", (DOMAIN, _THING), (RANGE, f"{XSD}string")), *required(f"{B}label", _THING), *said(f"{B}third", DATATYPE_PROPERTY, "third", (DOMAIN, _THING), (RANGE, f"{XSD}date")),
]


@query(expected(_ABOUT_ROWS, SUPPLIERS))
def described_tables(spark, d):
    return shown(schemas.convert_contents(files(spark, d, "d{k}.csv", "id,name,x{k}\n{k},{n},1\n"), "csv", metadata=_ABOUT))


@query("t(kind, stat, n) AS (VALUES ('csv', 'Classes', 1), ('csv', 'Columns', 5), ('csv', 'Datatype Properties', 5), ('csv', 'Rows Sampled', 2), ('json-schema', 'Classes', 3), ('json-schema', 'Datatype Properties', 6), ('json-schema', 'Object Properties', 3)) SELECT kind, stat, n FROM t")
def conversion_reports(spark, d):
    rows = []
    for kind, text in (("csv", _TABLE.replace("{k}", "1")), ("json-schema", json.dumps(_OBJECT).replace("{k}", "1"))):
        c = schemas.converter(kind)
        c.convert("t.tsv", text.encode())
        rows += [(kind, stat, int(n)) for stat, n in (line.split(": ") for line in schemas.report(c.stats).splitlines()[2:])]
    return spark.createDataFrame(rows, "kind string, stat string, n int")


@query("n(k) AS (SELECT p_partkey FROM part) SELECT k, CASE WHEN k % 3 = 0 THEN 'unnamed_column' ELSE 'n' || k || '_a_b' END AS col, 'file' || k AS stem, 'Name Of ' || k AS title, 'http://www.w3.org/2004/02/skos/core#' || CASE WHEN k % 2 = 0 THEN 'exactMatch' ELSE 'relatedMatch' END AS predicate FROM n")
def names_and_titles(spark, d):
    k = F.col("p_partkey").cast("string")
    place = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("https://e.org/x/file"), k, F.lit(".owl"))).otherwise(F.concat(F.lit("/data/file"), k, F.lit(".v2")))
    kind = F.when(F.col("p_partkey") % 2 == 0, "exactMatch").otherwise("other")
    column = F.when(F.col("p_partkey") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), k, F.lit("-a b ")))
    return v.table(spark, d, "part").select(F.col("p_partkey").alias("k"), fn.sanitize_column_name(column).alias("col"), fn.name_of_location(place).alias("stem"), fn.stat_title(F.concat(F.lit("name_of_"), k)).alias("title"), fn.alignment_predicate(kind).alias("predicate"))


_COLUMNS = {"region": {"r_regionkey": "integer", "r_name": "string"}, "nation": {"n_nationkey": "integer", "n_name": "string", "n_regionkey": "integer"}}
_COLUMNS["part"] = {"p_partkey": "integer", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "integer", "p_retailprice": "decimal"}
_COLUMN_ROWS = [r for t, cs in _COLUMNS.items() for r in [*said(f"{B}{t}", CLASS, t), *(x for c, k in cs.items() for x in said(f"{B}{c}", DATATYPE_PROPERTY, c, (DOMAIN, f"{B}{t}"), (RANGE, f"{XSD}{k}")))]]


@query(expected([], SUPPLIERS, [ROOT, *_COLUMN_ROWS]))
def converted_tables(spark, d):
    """Types of all columns of a table over all rows, as the ontology of that table."""
    out = None
    for name in ("region", "nation", "part"):
        t = v.table(spark, d, name)
        kinds = schemas.infer_types(t.select([F.col(c).cast("string").alias(c) for c in t.columns])).collect()  # a row per column
        b = schemas.Builder()
        owner = b.term(name, CLASS, name)
        for r in kinds:
            b.term(schemas.sanitize_column(r["column"]), DATATYPE_PROPERTY, r["column"], None, owner, XSD + fn.CSV_TYPES.get(r["type"], "string"))
        g = rdf.from_rows(spark, list(b.rows))
        out = g if out is None else tr.union(out, g)
    return shown(out)


# --- files -----------------------------------------------------------------------------------------

_NAMED = "SELECT 'urn:c:' || c_custkey AS s, 'urn:p' AS p, c_name || chr(10) || '\"é😀\\' || chr(9) || c_nationkey AS o, 'literal' AS o_kind FROM customer"


def _literals(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat("c_name", F.lit('\n"é😀\\\t'), F.col("c_nationkey").cast("string"))
    none = F.lit(None).cast("string")
    return v.table(spark, d, "customer").select(F.concat(F.lit("urn:c:"), F.col("c_custkey").cast("string")).alias("s"), F.lit("urn:p").alias("p"), text.alias("o"), F.lit("literal").alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))


@query(_NAMED)
def ntriples_files(spark, d):
    path = scratch(spark, "nt")
    rdf.write_ntriples(_literals(spark, d), path)
    return rdf.read_ntriples(spark, path, strict=True).select("s", "p", "o", "o_kind")


@query("SELECT 'urn:é' || s_suppkey AS s, 'urn:p' AS p, s_name || ' é😀' || chr(8) || chr(12) || '\"' AS o, 'de-CH' AS o_lang FROM supplier")
def ntriples_escapes(spark, d):
    line = F.concat(F.lit("<urn:\\u00e9"), F.col("s_suppkey").cast("string"), F.lit('> <urn:p> "'), "s_name", F.lit(' \\u00E9\\U0001F600\\b\\f\\""@de-CH . # said'))
    lines = v.table(spark, d, "supplier").select(F.explode(F.array(line, F.lit(""), F.lit("# a comment"))).alias("value"))
    return rdf.parse_ntriples(lines, strict=True).select("s", "p", "o", "o_lang")


_SMALL = f"{TRIPLES_SQL} SELECT s, p, o, o_kind FROM g WHERE s LIKE 'nation:%' OR s LIKE 'region:%' OR s LIKE 'prop:%'"


def _rendered(spark: SparkSession, d: str, fmt: str, name: str) -> DataFrame:
    """A schema-sized part of the graph as a file's text, and parsed again on an executor."""
    g = v.triples(spark, d).where(F.col("s").rlike("^(nation|region|prop):"))
    text = "".join(rdf.render(g, fmt))
    return rdf.parse_contents(spark.createDataFrame([(name, text.encode())], "path string, content binary")).select("s", "p", "o", "o_kind")


@query(_SMALL)
def turtle_round_trip(spark, d):
    return _rendered(spark, d, "turtle", "g.ttl")


@query(_SMALL)
def rdfxml_round_trip(spark, d):
    return _rendered(spark, d, "xml", "g.owl")


_BY_FILE = "per AS (SELECT subject_id, object_id, predicate_id, matcher_name, max(confidence) AS c FROM m GROUP BY ALL), fused AS (SELECT subject_id, object_id, predicate_id, list(matcher_name ORDER BY matcher_name) AS ms, count(*) AS support_count, avg(c) AS consensus FROM per GROUP BY ALL)"


@query(f"{MAPPINGS_SQL}, {_BY_FILE} {_SHOWN}")
def mapping_files(spark, d):
    """A TSV of each matcher, written in parts, scanned and fused in the order of the files."""
    folder, rows = scratch(spark, "sssom"), v.mappings(spark, d)
    names = {"AML": "subject", "BERTMap": "subject_id", "LogMap": "subject"}
    for m, column in names.items():
        rows.where(F.col("matcher_name") == m).select(F.col("subject_id").alias(column), "object_id", "predicate_id", "confidence").write.csv(f"{folder}/{m}", sep="\t", header=True)
    return _shown(fusion.fuse(sssom.load_all(spark, {m: f"{folder}/{m}" for m in names})))


@query(f"{FUSED} SELECT subject_id, object_id, predicate_id, round(consensus, 6) AS confidence FROM fused")
def exported_mappings(spark, d):
    path = scratch(spark, "export")
    sssom.write_table(_fused(spark, d), path)
    return sssom.load(spark, path, "again").select(*KEY, F.round("confidence", 6).alias("confidence"))


@query("SELECT CAST(0 AS BIGINT) AS n")
def missing_mapping_file(spark, d):
    return sssom.load(spark, scratch(spark, "none"), "x").agg(F.count("*").alias("n"))


@query(f"{FUSED} {_SHOWN}")
def streamed_fusion(spark, d):
    """The mappings as a stream of files, merged batch by batch."""
    folder, rows = scratch(spark, "stream"), v.mappings(spark, d)
    rows.withColumn("part", F.col("ord") % 3).select(*MAPPINGS.names, "part").repartition(3, "part").select(*MAPPINGS.names).write.parquet(f"{folder}/in")
    incremental.start(spark, f"{folder}/in", folder, f"{folder}/checkpoint", 8, files_per_batch=1).awaitTermination()
    return _shown(spark.read.parquet(f"{folder}/fused"))


@query("SELECT time_bucket(INTERVAL '5 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_event_counts(spark, d):
    return incremental.windowed_counts(v.table(spark, d, "events")).select("start", "event_type", "n")


# --- order -----------------------------------------------------------------------------------------


@query(f"{FUSED} SELECT predicate_id, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, predicate_id) AS rank FROM fused GROUP BY predicate_id")
def ranked_predicates(spark, d):
    return ordering.ranked(quality.predicate_histogram(_fused(spark, d)), F.desc("n"), "predicate_id")


@query(f"{FUSED} SELECT support_count, count(*) AS n, row_number() OVER (ORDER BY support_count) AS rank FROM fused GROUP BY support_count")
def ranked_supports(spark, d):
    return ordering.ranked(quality.support_histogram(_fused(spark, d)), "support_count").select(F.col("support_count").cast("long").alias("support_count"), "n", "rank")


@query(f"{FUSED}, c AS (SELECT subject_id, count(DISTINCT object_id) AS n_objects FROM fused GROUP BY ALL HAVING count(DISTINCT object_id) > 1) SELECT subject_id, n_objects, row_number() OVER (ORDER BY subject_id) AS rank, (SELECT count(*) FROM c) - 10 AS more FROM c ORDER BY subject_id LIMIT 10")
def first_conflicts(spark, d):
    """The report's list of the first ten, and how many more there are."""
    found = conflicts.conflicting_subjects(_fused(spark, d))
    return ordering.top(found, 10, "subject_id").withColumn("more", F.lit(found.count() - 10))


_HITS = "s AS (SELECT matcher, avg(hit) AS score FROM (SELECT unnest(ms) AS matcher, CASE WHEN g.subject_id IS NULL THEN 0.0 ELSE 1.0 END AS hit FROM fused f LEFT JOIN gold g USING (subject_id, object_id, predicate_id)) GROUP BY 1)"


@query(f"{FUSED}, {GOLD_SQL}, {_HITS} SELECT matcher, round(score / (SELECT sum(score) FROM s), 6) AS weight, row_number() OVER (ORDER BY score DESC, matcher) AS rank FROM s")
def ranked_weights(spark, d):
    w = quality.suggest_weights(_fused(spark, d), v.gold(spark, d))
    return ordering.ranked(w, F.desc("score"), "matcher").select("matcher", F.round("weight", 6).alias("weight"), "rank")


@query(f"{TRIPLES_SQL}, h(node, path) AS (SELECT 'region:1', ['region:1'] UNION ALL SELECT e.s, list_append(h.path, e.s) FROM h JOIN g e ON e.p = '{SUBCLASS}' AND e.o = h.node) SELECT node, row_number() OVER (ORDER BY path) AS rank FROM h", True)
def printed_hierarchy(spark, d):
    """The lines below a class in printed order: siblings by IRI."""
    lines = reasoning.hierarchy_lines(v.triples(spark, d), "region:1", all_paths=False)
    return ordering.ranked(lines, "path").select(F.element_at("path", -1).alias("node"), "rank")


@query(f"{FUSED}, {GOLD_SQL} SELECT DISTINCT {_COLS} FROM fused ANTI JOIN gold USING (subject_id, object_id, predicate_id) WHERE support_count >= 2")
def false_positives(spark, d):
    return quality.false_positives(fusion.filter_by_support(_fused(spark, d)), v.gold(spark, d))


@query(f"{MAPPINGS_SQL}, u AS (SELECT * FROM m WHERE matcher_name = 'AML' UNION ALL SELECT * FROM m WHERE matcher_name <> 'BERTMap') SELECT matcher_name, count(*) AS n FROM u GROUP BY ALL")
def concatenated_mappings(spark, d):
    m = v.mappings(spark, d)
    return fusion.concat(m.where("matcher_name = 'AML'"), m.where("matcher_name <> 'BERTMap'")).groupBy("matcher_name").agg(F.count("*").alias("n"))


# --- rules -----------------------------------------------------------------------------------------

X = "urn:x:"
_SCHEMA = [
    (f"{X}livesIn", f"{RDFS}subPropertyOf", f"{X}locatedIn"), (f"{X}hosts", f"{OWL}inverseOf", f"{X}locatedIn"), (f"{X}locatedIn", DOMAIN, f"{X}Agent"), (f"{X}locatedIn", RANGE, f"{X}Place"),
    (f"{X}Place", f"{OWL}equivalentClass", f"{X}Location"), (f"{X}near", TYPE, f"{OWL}SymmetricProperty"), (f"{X}partOf", TYPE, f"{OWL}TransitiveProperty"),
]


def _world(spark: SparkSession, d: str) -> DataFrame:
    """Customers live in nations, nations are part of regions, and these of the world; neighbours by key."""
    name = lambda p, c: F.concat(F.lit(f"{X}{p}"), F.col(c).cast("string"))
    none = F.lit(None).cast("string")
    row = lambda df, s, p, o: df.select(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit("iri").alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))
    c, n, r = (v.table(spark, d, t) for t in ("customer", "nation", "region"))
    parts = [row(c, name("c", "c_custkey"), f"{X}livesIn", name("n", "c_nationkey")), row(n, name("n", "n_nationkey"), f"{X}partOf", name("r", "n_regionkey"))]
    parts += [row(r, name("r", "r_regionkey"), f"{X}partOf", F.lit(f"{X}world")), row(r, name("r", "r_regionkey"), f"{X}near", F.concat(F.lit(f"{X}r"), (F.col("r_regionkey") + 1).cast("string")))]
    return tr.union(*parts, tr.graph(spark, [tr.iri(*t) for t in _SCHEMA]))


_LIVES = f"l AS (SELECT DISTINCT '{X}c' || c_custkey AS c, '{X}n' || c_nationkey AS n FROM customer)"


@query(f"""{_LIVES}, a AS (SELECT c AS s, '{X}livesIn' AS p, n AS o FROM l UNION SELECT c, '{X}locatedIn', n FROM l UNION SELECT n, '{X}hosts', c FROM l
 UNION SELECT c, '{TYPE}', '{X}Agent' FROM l UNION SELECT n, '{TYPE}', '{X}Place' FROM l UNION SELECT n, '{TYPE}', '{X}Location' FROM l
 UNION SELECT '{X}n' || n_nationkey, '{X}partOf', '{X}r' || n_regionkey FROM nation UNION SELECT '{X}n' || n_nationkey, '{X}partOf', '{X}world' FROM nation
 UNION SELECT '{X}r' || r_regionkey, '{X}partOf', '{X}world' FROM region UNION SELECT '{X}r' || r_regionkey, '{X}near', '{X}r' || (r_regionkey + 1) FROM region
 UNION SELECT '{X}r' || (r_regionkey + 1), '{X}near', '{X}r' || r_regionkey FROM region) SELECT s, p, o FROM a""")
def inferred_statements(spark, d):
    """Subproperty, inverse, domain, range, equivalence, symmetry and transitivity together."""
    got = reasoning.materialize(_world(spark, d))
    return got.where(F.col("s").rlike(f"^{X}(c|n|r)[0-9]")).select("s", "p", "o").distinct()


@query(f"""f AS (SELECT '{X}s' || s_suppkey AS subject, 'member_of_nothing' AS rule FROM supplier WHERE s_nationkey = 3
 UNION SELECT '{X}s' || s_suppkey, 'same_and_different' FROM supplier WHERE s_nationkey = 4 UNION SELECT '{X}s' || s_suppkey, 'disjoint_types' FROM supplier WHERE s_nationkey = 5) SELECT subject, rule FROM f""")
def clash_rules(spark, d):
    none, n = F.lit(None).cast("string"), F.col("s_nationkey")
    t = lambda p, o: F.struct(F.lit(p).alias("p"), F.lit(o).alias("o"))
    said_ = F.when(n == 3, F.array(t(TYPE, f"{X}Empty"))).when(n == 4, F.array(t(f"{OWL}sameAs", f"{X}o"), t(f"{OWL}differentFrom", f"{X}o"))).when(n == 5, F.array(t(TYPE, f"{X}A"), t(TYPE, f"{X}B"))).otherwise(F.array(t(TYPE, f"{X}A")))
    rows = v.table(spark, d, "supplier").select(F.concat(F.lit(f"{X}s"), F.col("s_suppkey").cast("string")).alias("s"), F.explode(said_).alias("x")).select("s", "x.p", "x.o", F.lit("iri").alias("o_kind"), none.alias("o_datatype"), none.alias("o_lang"))
    rules = [(f"{X}Empty", SUBCLASS, f"{OWL}Nothing"), (f"{X}A", f"{OWL}disjointWith", f"{X}B")]
    return validation.clashes(tr.union(rows, tr.graph(spark, [tr.iri(*r) for r in rules]))).select("subject", "rule").distinct()


@query("t(profile, valid) AS (VALUES ('DL', false), ('QL', true)) SELECT profile, valid FROM t")
def validation_verdicts(spark, d):
    """A clash makes a graph invalid under DL; without the check of consistency the same graph is valid."""
    g = tr.graph(spark, [tr.iri(f"{X}i", TYPE, f"{OWL}Nothing"), tr.iri(f"{X}A", TYPE, CLASS)])
    return spark.createDataFrame([(p, bool(validation.validate(g, p).is_valid)) for p in ("DL", "QL")], "profile string, valid boolean")


# --- matchers, providers, runs ---------------------------------------------------------------------


class _Broken(matching.Matcher):
    def align(self, source, target):
        raise RuntimeError("no such tool")


@query("SELECT 'LexicalExact' AS matcher, true AS success, count(*) AS n, '' AS error FROM nation UNION ALL SELECT '', false, 0, 'no such tool'")
def matcher_results(spark, d):
    """Matchers side by side: one works, one fails, and the failure is a result."""
    g = v.triples(spark, d).where(F.col("s").startswith("nation:"))
    got = matching.run_alignment_parallel(g, g, [matching.LexicalExact(), _Broken()])
    return spark.createDataFrame([(r.matcher_name, r.success, r.mappings.count() if r.success else 0, r.error or "") for r in got], "matcher string, success boolean, n long, error string")


@query("t(kind, name) AS (VALUES ('converter', 'csv'), ('converter', 'json-schema'), ('converter', 'xsd'), ('provider', 'composite'), ('provider', 'custom'), ('provider', 'financial'), ('provider', 'generic'), ('matcher', 'EditDistance'), ('matcher', 'LexicalExact'), ('matcher', 'TokenJaccard'), ('stand-in', 'LexicalExact'), ('unknown', 'nope')) SELECT kind, name FROM t")
def registered_names(spark, d):
    known, unknown = matching.selected(["LogMap", "nope", "lexicalexact"])
    rows = [("converter", k) for k in schemas.Converter.known] + [("provider", k) for k in meta.Registry().list()] + [("matcher", m.name) for m in matching.REGISTRY.values()]
    return spark.createDataFrame(rows + [("stand-in", m.name) for m in known] + [("unknown", n) for n in unknown], "kind string, name string")


def _raised(run) -> str:
    try:
        run()
        return "none"
    except Exception as e:  # noqa: BLE001
        return type(e).__name__


@query("t(what, error) AS (VALUES ('voting strategy', 'ValueError'), ('converter', 'ValueError'), ('provider', 'ValueError'), ('registered twice', 'ValueError'), ('no provider', 'TypeError'), ('modules', 'ValueError'), ('profile', 'ValueError'), ('fetch by git', 'FetchError'), ('manifest', 'ManifestError'), ('json root', 'ValueError'), ('alias', 'none')) SELECT what, error FROM t")
def refused_settings(spark, d):
    f = _fused(spark, d)
    far = manifest.Source.model_validate({"id": "far", "fetch": {"type": "git", "url": "x"}})
    runs = {
        "voting strategy": lambda: voting.vote(f, voting.VotingConfig("loudest")), "converter": lambda: schemas.converter("yaml"), "provider": lambda: meta.Registry().get("none"),
        "registered twice": lambda: meta.Registry().register("generic", meta.GenericOntology), "no provider": lambda: meta.Registry().register("x", dict),
        "modules": lambda: meta.ModuleOntology(spark, "/none", ("FND", "NOPE")), "profile": lambda: validation.profile_findings(f, "XL"), "fetch by git": lambda: pipeline.fetch(far, "m.yaml"),
        "manifest": lambda: manifest.load("/none.yaml"), "json root": lambda: schemas.converter("json-schema").convert("x", b"[]"), "alias": lambda: meta.Registry().get("FIBO"),
    }
    return spark.createDataFrame([(k, _raised(r)) for k, r in runs.items()], "what string, error string")


@query("t(shown, kind, recoverable) AS (VALUES ('no file (stage=fetch, source=a)', 'FetchError', true), ('bad (stage=ingest)', 'ConvertError', false), ('x', 'PlanError', false)) SELECT shown, kind, recoverable FROM t")
def error_records(spark, d):
    made = [errors.FetchError("no file", "fetch", "a"), errors.ConvertError("bad", "ingest"), errors.PlanError("x")]
    return spark.createDataFrame([(str(e), e.to_dict()["type"], e.to_dict()["recoverable"]) for e in made], "shown string, kind string, recoverable boolean")


def _plan(spark: SparkSession, d: str) -> tuple[str, str]:
    """A manifest over a JSON Schema, a table and a missing file, in a new folder that the driver can write."""
    folder = scratch(spark, "run").removeprefix("file:")
    os.makedirs(folder)
    texts = {"s.json": json.dumps({"title": "Person", "type": "object", "properties": {"hasName": {"type": "string"}}}), "t.csv": "Agent,has value\na,1\n"}
    sources = [{"id": "one", "fetch": {"path": "s.json"}, "convert": {"type": "json-schema"}}, {"identifier": "two", "fetch": {"paths": ["t.csv"]}, "convert": {"type": "csv"}}, {"id": "gone", "fetch": {"path": "none.xsd"}}, {"id": "off", "fetch": {"path": "x"}, "enabled": False}]
    texts["m.yaml"] = json.dumps({"name": "demo", "sources": sources, "matchers": ["LogMap", "AML", "nope"], "pipeline": {"retry_delay": 0}})
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return f"{folder}/m.yaml", f"{folder}/work"


@query("t(stage, items) AS (VALUES ('align', 'one,two'), ('fuse', 'all'), ('ingest', 'one,two'), ('merge', 'all'), ('meta', 'all'), ('resolve', 'all'), ('status', 'completed'), ('errors', 'FetchError gone'), ('resumed', 'true'), ('turtle', 'true')) SELECT stage, items FROM t")
def staged_run(spark, d):
    """A run with a source that fails, then a resumed one that finds all tables."""
    path, work = _plan(spark, d)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = pipeline.orchestrate(spark, path, work)
        state = pipeline.State.load(spark, f"{work}/state.json")
        rows = [(k, ",".join(x)) for k, x in state.done.items()] + [("status", state.status), ("errors", ",".join(f"{e['type']} {e['source']}" for e in out.errors))]
        state.status = "failed"
        state.save()
        again = pipeline.orchestrate(spark, path, work, resume=True)
        rows.append(("resumed", str(pipeline.State.load(spark, f"{work}/state.json").done == state.done and again.merged == out.merged).lower()))
        turtle = rdf.parse_contents(spark.read.format("binaryFile").load(f"file:{out.merged_turtle}"))
        rows.append(("turtle", str(turtle.count() == spark.read.parquet(out.merged).count()).lower()))
    return spark.createDataFrame(rows, "stage string, items string")


@query("t(name, ok) AS (VALUES ('manifest exists', true), ('manifest is valid', true), ('work folder is writable', true), ('modules are there', true), ('meta-ontology is known', true), ('converters are known', true), ('local sources exist', false)) SELECT name, ok FROM t")
def preflight_checks(spark, d):
    path, work = _plan(spark, d)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return spark.createDataFrame([(k, x == "ok") for k, x in pipeline.preflight(path, work, strict=False).items()], "name string, ok boolean")


@query("t(setting, shown) AS (VALUES ('sources', 'one,two,gone'), ('matchers', 'LogMap,AML'), ('fail_fast', 'False'), ('threshold', '0.5'), ('timeout', '300.0'), ('retries', '3'), ('meta', 'generic')) SELECT setting, shown FROM t")
def manifest_settings(spark, d):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        m = manifest.load(_plan(spark, d)[0])
    rows = {"sources": ",".join(s.id for s in m.enabled()), "matchers": ",".join(m.matcher_names()), "fail_fast": m.pipeline.fail_fast, "threshold": m.alignment.threshold, "timeout": m.alignment.timeout, "retries": m.pipeline.max_retries, "meta": m.meta_ontology.type}
    return spark.createDataFrame([(k, str(x)) for k, x in rows.items()], "setting string, shown string")


@query("t(property, kind, n) AS (VALUES ('custom', 'class', 2), ('custom', 'edge', 1), ('modules', 'class', 3)) SELECT property, kind, CAST(n AS BIGINT) AS n FROM t")
def ontology_files(spark, d):
    """An ontology in a file, and modules of one in a folder, read by their providers."""
    folder = scratch(spark, "modules").removeprefix("file:")
    os.makedirs(folder)
    for name, text in (("own.ttl", "@prefix : <urn:o#> . @prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> .\n:A a owl:Class . :B a owl:Class ; rdfs:subClassOf :A ."), ("FND.ttl", "@prefix owl: <http://www.w3.org/2002/07/owl#> . <urn:f#A> a owl:Class . <urn:f#B> a owl:Class ."), ("BE.ttl", "@prefix owl: <http://www.w3.org/2002/07/owl#> . <urn:b#A> a owl:Class .")):
        with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    own, modules = meta.CustomOntology(spark, f"file:{folder}/own.ttl").graph(), meta.REGISTRY.create(spark, "fibo", cache_dir=folder).graph()
    rows = [("custom", "class", tr.classes(own).count()), ("custom", "edge", tr.edges(own).count()), ("modules", "class", tr.classes(modules).count())]
    return spark.createDataFrame(rows, "property string, kind string, n long")
