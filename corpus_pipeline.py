"""Corpus pipeline: quality filter, near-duplicate removal, secret redaction, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
``documents``. ``run`` writes each stage's result to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm import op2_quality, op3_secrets, op5_packing, op8_simhash, op10_mixing
from meshwright.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; the score is computed beside the other columns, without a join."""
    model = op2_quality.fit(docs, table(spark, sf_dir, "labels"))
    return op2_quality.keep(docs, model).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the least id's (rows without an id last), then the least text's. Rows that share an id but not their text are different documents."""
    return op8_simhash.keepers(docs).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of a secret replaced by a mask; n_chars follows."""
    got = op3_secrets.scan(docs, carry=("lang", "source", "n_chars"), keep_text=True)
    hit = F.size("spans") > 0
    text = op3_secrets.redact(F.col("text"), F.col("spans"))
    return got.select("doc_id", text.alias("text"), "lang", "source", F.when(hit, F.length(text).cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def mixing_rate(scored: DataFrame):
    """The rate as a column of ``scored``, which has tokens and p."""
    domains = op10_mixing.DOMAINS
    clean = F.get("p", F.lit(domains.index("high_clean"))) >= F.array_max("p")
    totals = scored.where(clean).agg(*[F.sum(F.col("tokens") * F.get("p", F.lit(i))) for i in range(len(domains))]).first()
    volume = sum(x or 0.0 for x in totals)
    if not volume:
        return F.lit(1.0)
    floor = F.when(clean, 1.0).otherwise(0.0)
    target = {d: x / volume for d, x in zip(domains, totals)}
    return op10_mixing.rate(op10_mixing.fit_rates(scored, target, floor=floor), floor=floor)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its fitted rate says; those that the classifier calls clean at least once.

    The target is the shares that the clean documents have, over the tokens of all: soft posteriors can reach it, as rates that
    are equal for the clean documents and 0 for the others do. If nothing is called clean, every document keeps rate 1.
    """
    labels = table(spark, sf_dir, "labels")
    got = written(op10_mixing.posteriors(docs, op10_mixing.fit(docs, labels), carry=[c for c in COLUMNS if c != "doc_id"]), "mixing")
    rate = mixing_rate(got)
    times = op10_mixing.copies(rate, F.col("doc_id"), F.col("p"))
    return got.withColumn("times", times).where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_packing.pack(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]
#: Trained models and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
