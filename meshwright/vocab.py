"""Schemas and vocabularies shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
DC = "http://purl.org/dc/elements/1.1/"
#: Default namespaces; every function that uses them takes others.
META = "https://example.org/meta-ontology#"
SCHEMA_BASE = "https://example.org/schema/"

TYPE, LABEL, COMMENT, SUBCLASS = f"{RDF}type", f"{RDFS}label", f"{RDFS}comment", f"{RDFS}subClassOf"
DOMAIN, RANGE = f"{RDFS}domain", f"{RDFS}range"
CLASS, RDFS_CLASS = f"{OWL}Class", f"{RDFS}Class"
OBJECT_PROPERTY, DATATYPE_PROPERTY, ONTOLOGY = f"{OWL}ObjectProperty", f"{OWL}DatatypeProperty", f"{OWL}Ontology"

TRIPLES = T.StructType([T.StructField(c, T.StringType()) for c in ("s", "p", "o", "o_kind", "o_datatype", "o_lang")])
MAPPINGS = T.StructType(
    [
        T.StructField("subject_id", T.StringType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("predicate_id", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("matcher_name", T.StringType()),
        T.StructField("mapping_justification", T.StringType()),
        T.StructField("ord", T.LongType()),
    ]
)
FINDINGS = "severity string, rule string, message string, subject string, predicate string, object string"
KEY = ["subject_id", "object_id", "predicate_id"]

#: Rank of a mapping predicate by how much it says; others have 0.
PREDICATE_RANK = {
    "owl:equivalentClass": 3,
    "skos:exactMatch": 3,
    "skos:closeMatch": 2,
    "skos:relatedMatch": 1,
    "skos:broadMatch": 1,
    "skos:narrowMatch": 1,
}

#: The types that XSD knows, as the engine's column types.
SPARK_TYPE = {
    "string": "string", "anyURI": "string", "boolean": "boolean", "byte": "tinyint", "short": "smallint", "int": "int", "long": "bigint",
    "integer": "decimal(38,0)", "decimal": "decimal(38,18)", "float": "float", "double": "double", "date": "date", "dateTime": "timestamp", "time": "string", "duration": "string",
}
