"""Triple sets as DataFrames: pattern access, set operations, class and property listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.vocab import CLASS, COMMENT, DATATYPE_PROPERTY, DOMAIN, LABEL, META, OBJECT_PROPERTY, RANGE, RDFS_CLASS, SKOS, SUBCLASS, TRIPLES, TYPE

COLUMNS = TRIPLES.names


def iri(s: str, p: str, o: str) -> tuple:
    return (s, p, o, "iri", None, None)


def literal(s: str, p: str, o: str, datatype: str | None = None, lang: str | None = None) -> tuple:
    return (s, p, o, "literal", datatype, lang)


def graph(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, TRIPLES).distinct()


def match(g: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None) -> DataFrame:
    """Triples of a pattern; None matches all."""
    for column, value in (("p", p), ("s", s), ("o", o)):
        if value is not None:
            g = g.where(F.col(column) == value)
    return g


def exists(g: DataFrame, probes: DataFrame) -> DataFrame:
    """The rows of ``probes(s, p, o)`` that are in the graph."""
    return probes.join(g.select("s", "p", "o"), ["s", "p", "o"], "left_semi")


def subjects(g: DataFrame, p: str | None = None, o: str | None = None) -> DataFrame:
    return match(g, p=p, o=o).select("s").distinct()


def objects(g: DataFrame, s: str | None = None, p: str | None = None) -> DataFrame:
    return match(g, s=s, p=p).select("o").distinct()


def union(*graphs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [g.select(*COLUMNS) for g in graphs]).distinct()


def classes(g: DataFrame, kinds: tuple[str, ...] = (CLASS, RDFS_CLASS), containing: str | None = None) -> DataFrame:
    """Declared classes with an IRI, on demand only those whose IRI holds a text."""
    rows = g.where((F.col("p") == TYPE) & F.col("o").isin(*kinds) & ~F.col("s").startswith("_:"))
    return (rows.where(F.col("s").contains(containing)) if containing else rows).select("s").distinct()


def properties(g: DataFrame) -> DataFrame:
    """s, kind: a property declared both ways is an object property."""
    rows = g.where((F.col("p") == TYPE) & F.col("o").isin(OBJECT_PROPERTY, DATATYPE_PROPERTY))
    return rows.groupBy("s").agg(F.max(F.col("o") == OBJECT_PROPERTY).alias("object")).select("s", F.when(F.col("object"), "object").otherwise("datatype").alias("kind"))


def edges(g: DataFrame, p: str = SUBCLASS) -> DataFrame:
    return match(g, p=p).select("s", "o").distinct()


def top_level_classes(g: DataFrame, containing: str | None = None) -> DataFrame:
    """Classes that are no subject of a subclass statement."""
    return classes(g, containing=containing).join(match(g, p=SUBCLASS).select("s"), "s", "left_anti")


def hierarchy(g: DataFrame) -> DataFrame:
    """cls, subs: every declared class with its direct subclasses, maybe none."""
    down = edges(g).select(F.col("o").alias("cls"), F.col("s").alias("sub")).groupBy("cls").agg(F.array_sort(F.collect_set("sub")).alias("subs"))
    return classes(g).withColumnRenamed("s", "cls").join(down, "cls", "left").select("cls", F.coalesce("subs", F.array().cast("array<string>")).alias("subs"))


def root_classes(g: DataFrame, tops: tuple[str, ...] = ("http://www.w3.org/2002/07/owl#Thing", "http://www.w3.org/2000/01/rdf-schema#Resource")) -> DataFrame:
    """Declared classes without a direct superclass other than the given ones."""
    return classes(g).join(match(g, p=SUBCLASS).where(~F.col("o").isin(*tops)).select("s"), "s", "left_anti")


def leaf_classes(g: DataFrame) -> DataFrame:
    return classes(g).join(match(g, p=SUBCLASS).select(F.col("o").alias("s")), "s", "left_anti")


def property_domain(g: DataFrame) -> DataFrame:
    return match(g, p=DOMAIN).select(F.col("s").alias("property"), F.col("o").alias("cls")).distinct()


def property_range(g: DataFrame) -> DataFrame:
    return match(g, p=RANGE).select(F.col("s").alias("property"), F.col("o").alias("cls")).distinct()


def describe(g: DataFrame, order: tuple[str, ...] = (COMMENT, f"{SKOS}definition", LABEL)) -> DataFrame:
    """s, description: by the first predicate of ``order`` that a term has; the smallest text if there are several."""
    rank = F.array_position(F.array(*[F.lit(p) for p in order]), F.col("p"))
    rows = g.where(F.col("p").isin(*order))
    return rows.groupBy("s").agg(F.min(F.struct(rank.alias("r"), "o")).alias("x")).select("s", F.col("x.o").alias("description"))


def add_domain_classes(g: DataFrame, iris: list[str], parent: str = f"{META}Entity") -> DataFrame:
    """Each IRI becomes a class under ``parent``; doing it twice changes nothing."""
    spark = g.sparkSession
    return union(g, graph(spark, [t for i in iris for t in (iri(i, TYPE, RDFS_CLASS), iri(i, SUBCLASS, parent))])) if iris else g


def ontology_counts(g: DataFrame) -> DataFrame:
    """One row: classes, object and datatype properties."""
    typed = match(g, p=TYPE)
    n = lambda kind, name: F.count_if(F.col("o") == kind).alias(name)
    return typed.select("s", "o").distinct().agg(n(CLASS, "classes"), n(OBJECT_PROPERTY, "object_properties"), n(DATATYPE_PROPERTY, "datatype_properties"))


def first_value(tables: list[DataFrame], key: str, value: str) -> DataFrame:
    """Per key the value of the first table that has one."""
    ranked = reduce(lambda a, b: a.unionByName(b), [t.where(F.col(value).isNotNull()).select(key, value, F.lit(i).alias("rank")) for i, t in enumerate(tables)])
    return ranked.groupBy(key).agg(F.min_by(value, F.struct("rank", value)).alias(value))


def ordered_union(tables: list[DataFrame], value: str) -> DataFrame:
    """Distinct values in order of (table, position); tables have a column ``pos``."""
    rows = reduce(lambda a, b: a.unionByName(b), [t.select(value, F.struct(F.lit(i).alias("table"), F.col("pos").cast("long").alias("pos")).alias("at")) for i, t in enumerate(tables)])
    return rows.groupBy(value).agg(F.min("at").alias("at"))


def duplicates(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1")


def select_pattern(g: DataFrame, patterns: list[tuple[str, str, str]]) -> DataFrame:
    """Basic graph pattern: names that start with ``?`` are variables; patterns are joined on the variables they share."""
    out = None
    for s, p, o in patterns:
        rows, cols, seen = g, [], {}
        for column, term in (("s", s), ("p", p), ("o", o)):
            if not term.startswith("?"):
                rows = rows.where(F.col(column) == term)
            elif term in seen:
                rows = rows.where(F.col(column) == F.col(seen[term]))
            else:
                seen[term] = column
                cols.append(F.col(column).alias(term[1:]))
        rows = rows.select(*cols).distinct()
        shared = [c for c in rows.columns if out is not None and c in out.columns]
        if out is not None and not shared:
            raise ValueError("patterns must share a variable with those before them")
        out = rows if out is None else out.join(rows, shared)
    return out.distinct()
