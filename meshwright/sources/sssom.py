"""Mapping tables as SSSOM TSV files: scan and export."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.vocab import MAPPINGS, SKOS

#: Columns and their other names, in order of preference.
ALIASES = {"subject_id": ("subject_id", "subject"), "object_id": ("object_id", "object"), "predicate_id": ("predicate_id", "predicate"), "confidence": ("confidence", "similarity"), "mapping_justification": ("mapping_justification",)}
HEADER = ("# Fused mapping set from multiple ontology matchers", "# Fusion method: ensemble consensus", "#")


def normalise(rows: DataFrame, matcher: str, position: int = 0, compat_zero_confidence: bool = False) -> DataFrame:
    """Rows under the mapping schema: aliases, defaults, rows without subject or object dropped.

    ``ord`` holds the position of the matcher (up to 127) above the row's number, whose partition then has 23 bits.
    ``compat_zero_confidence``: a confidence of 0 counts as missing.
    """
    if not 0 <= position < 128:
        raise ValueError("at most 128 matchers keep their order")
    have = set(rows.columns)

    def value(name: str):
        found = [F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in ALIASES[name] if c in have]
        if name == "confidence":
            found = [c.try_cast("double") for c in found]
            found = [F.when(c != 0, c) for c in found] if compat_zero_confidence else found
            found.append(F.lit(1.0))
        if name == "predicate_id":
            found.append(F.lit("skos:closeMatch"))
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    order = F.col("_ord") if "_ord" in have else F.monotonically_increasing_id()
    out = rows.select(*[value(n).alias(n) for n in ("subject_id", "object_id", "predicate_id", "confidence")], F.lit(matcher).alias("matcher_name"), value("mapping_justification").alias("mapping_justification"), (order + F.lit(position << 56)).alias("ord"))
    return out.where("subject_id is not null and object_id is not null").select(*MAPPINGS.names)


def load(spark: SparkSession, path: str | list[str], matcher: str, position: int = 0, compat_zero_confidence: bool = False) -> DataFrame:
    """Mappings of a file; lines that start with ``#`` are comments. A missing or unreadable file gives no rows."""
    try:
        rows = spark.read.csv(path, sep="\t", header=True, comment="#", enforceSchema=False)
    except AnalysisException:
        return spark.createDataFrame([], MAPPINGS)
    if not rows.columns:
        return spark.createDataFrame([], MAPPINGS)
    return normalise(rows, matcher, position, compat_zero_confidence)


def load_all(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Files of several matchers in their order."""
    out = spark.createDataFrame([], MAPPINGS)
    for i, (matcher, path) in enumerate(files.items()):
        out = out.unionByName(load(spark, path, matcher, i))
    return out


def export_rows(fused: DataFrame, tool: str = "ensemble-fusion") -> DataFrame:
    return fused.select(
        "subject_id", "predicate_id", "object_id", F.col("consensus_confidence").alias("confidence"), F.lit(tool).alias("mapping_tool"),
        F.coalesce(F.nullif("mapping_justification", F.lit("")), F.lit("ensemble_fusion")).alias("mapping_justification"),
        F.concat(F.lit("Support: "), F.col("support_count").cast("string"), F.lit(" matchers: "), F.array_join("supporting_matchers", ", ")).alias("comment"),
    )


def write_table(fused: DataFrame, path: str, tool: str = "ensemble-fusion") -> None:
    """A folder of TSV parts, written in parallel."""
    export_rows(fused, tool).write.mode("overwrite").csv(path, sep="\t", header=True)


def exported(fused: DataFrame, include_metadata: bool = True, tool: str = "ensemble-fusion") -> Iterator[str]:
    """The lines of one TSV file in input order, a partition at a time."""
    rows = export_rows(fused.orderBy("ord"), tool) if "ord" in fused.columns else export_rows(fused, tool)
    clean = lambda v: "" if v is None else str(v).replace("\t", " ").replace("\n", " ")
    if include_metadata:
        yield f"{HEADER[0]}\n# Total mappings: {fused.count()}\n{HEADER[1]}\n{HEADER[2]}\n"
    yield "\t".join(rows.columns) + "\n"
    for r in rows.toLocalIterator():
        yield "\t".join(map(clean, r)) + "\n"


def export(fused: DataFrame, path: str, include_metadata: bool = True, tool: str = "ensemble-fusion") -> str:
    """One TSV file on the driver's disk; ``write_table`` writes parts in parallel."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(exported(fused, include_metadata, tool))
    return path


def expand_predicates(mappings: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Prefixed predicates as full IRIs."""
    known = {"skos": SKOS, "owl": "http://www.w3.org/2002/07/owl#", "rdfs": "http://www.w3.org/2000/01/rdf-schema#"} | (prefixes or {})
    table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv])
    head = F.substring_index("predicate_id", ":", 1)
    return mappings.withColumn("predicate_id", F.when(table[head].isNotNull(), F.concat(table[head], F.substr("predicate_id", F.length(head) + 2))).otherwise(F.col("predicate_id")))

