"""Language identification of web pages by Bayesian evidence fusion.

Evidence of a page: the likelihood of its visible text under byte-trigram models of each language, the language that its
markup declares, and the prior of its host. The last two are learnt over all pages by grouped aggregation of the text
evidence: counts of (declared language, language), and host counts shrunk to those of the host's domain, these to those of the address's
suffix, and these to the total; so the suffix counts once. A page's own evidence is taken out of all counts that it is judged by.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import table, written

BUCKETS = 1 << 16
#: The text models are fitted on at most so many labelled documents, those with the smallest hash of their id, and whole texts.
SAMPLE = 4000
#: Neighbouring trigrams depend on each other: the text's log likelihood counts by this power, and at most so many bits' worth.
TEMPER, LIMIT = 0.25, 60.0
#: Strength of the parent's share in a host's, a domain's and a suffix's counts.
SHRINK = 20.0
#: Second labels below which names are given out under a country's suffix (fixed values).
SECOND = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")
#: Bytes whose trigrams are held at once.
CHUNK = 1 << 20
_CLOSE = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style")}
_OPEN = re.compile(r"<(script|style)\b", re.I)
_LONG = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")


def visible(page: str) -> str:
    """Text outside of tags, comments, scripts and styles. One pass: an end that is missing once is never looked for again."""
    out, at, n, gone = [], 0, len(page), set()

    def end(what: str, start: int) -> int:
        if what in gone:
            return -1
        if what in _CLOSE:
            m = _CLOSE[what].search(page, start)
            found = m.end() if m else -1
        else:
            found = page.find(what, start)
            found = found + len(what) if found >= 0 else -1
        if found < 0:
            gone.add(what)
        return found

    while at < n:
        begin = page.find("<", at)
        if begin < 0:
            break
        stop = -1
        if m := _OPEN.match(page, begin):
            stop = end(m[1].lower(), m.end())
        elif page.startswith("<!--", begin):
            stop = end("-->", begin + 4)
        if stop < 0:
            stop = end(">", begin + 1)
        if stop < 0:  # no tag ends from here on
            break
        out.append(page[at:begin])
        at = stop
    out.append(page[at:])
    return html.unescape(_LONG.sub("\ufffd", " ".join(out)))


def trigrams(raw: np.ndarray) -> np.ndarray:
    """Buckets of the byte trigrams of ``raw`` (unsigned 32-bit)."""
    return ((raw[:-2] * 40503 + raw[1:-1] * 2654435 + raw[2:] * 97) % BUCKETS) if len(raw) > 2 else np.empty(0, np.uint32)


def chunks(text: str) -> Iterator[np.ndarray]:
    """All trigrams of a text of any length, some of them at a time."""
    raw = np.frombuffer(b" " + " ".join(text.lower().split()).encode("utf-8", "surrogatepass") + b" ", np.uint8)
    for at in range(0, max(1, len(raw) - 2), CHUNK):
        yield trigrams(raw[at : at + CHUNK + 2].astype(np.uint32))


def fit_text(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood table): trigram counts of the sampled documents, added up by language on the executors."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    chosen = rows.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for grams in chunks(text):
                        sums[lang] = sums.get(lang, 0) + np.bincount(grams, minlength=BUCKETS)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"lang": lang, "g": at, "n": c[at]})

    got = rows.join(F.broadcast(chosen), "doc_id").select("lang", "text").mapInPandas(run, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros((BUCKETS, max(1, len(langs))))
    for k, lang in enumerate(langs):
        own = got[got["lang"] == lang]
        counts[own["g"].to_numpy(), k] = own["n"]
    smooth = counts + 0.1
    return langs, np.log(smooth / smooth.sum(0)).astype(np.float32)


def log_likelihood(grams: np.ndarray, likelihood: np.ndarray) -> np.ndarray:
    if len(grams) < BUCKETS:
        return likelihood[grams].sum(0, dtype=np.float64)
    return np.bincount(grams, minlength=BUCKETS) @ likelihood.astype(np.float64)


def evidence(pages: DataFrame, langs: list[str], likelihood: np.ndarray) -> DataFrame:
    """page_id, declared, host, domain, suffix, ll (tempered log likelihoods of the visible text)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for page in batch:
                ll = TEMPER * sum(log_likelihood(grams, likelihood) for grams in chunks(visible(page)))
                out.append(np.maximum(ll - ll.max(), -LIMIT).tolist())
            yield pd.Series(out, dtype=object)

    udf = F.pandas_udf(run, "array<double>", F.PandasUDFType.SCALAR_ITER)
    page = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    # the first html tag is cut out by its end, so that tags which never end are read once
    tag = F.substring_index(F.regexp_extract(page, r"(?is)<html\b.*", 0), ">", 1)
    declared = F.nullif(F.lower(F.regexp_extract(tag, r"""(?is)\slang\s*=\s*["']?([A-Za-z]{2,3})\b""", 1)), F.lit(""))
    df = pages.select(F.col("page_id").cast("long").alias("page_id"), declared.alias("declared"), F.nullif(F.rtrim(host, F.lit(".")), F.lit("")).alias("host"), udf(page).alias("ll"))
    parts, number = F.split("host", r"\."), F.col("host").rlike(r"^[0-9.]+$|^\[")
    second = (F.length(F.get(parts, F.size(parts) - 1)) == 2) & F.get(parts, F.size(parts) - 2).isin(*SECOND)
    domain = F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - F.when(second, 2).otherwise(1)), 3), ".")
    # addresses that are numbers have neither suffix nor domain of others
    return df.withColumn("suffix", F.when(number, F.lit(None)).otherwise(F.element_at(parts, -1))).withColumn("domain", F.when(number, F.col("host")).otherwise(domain))


def identify(pages: DataFrame, docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per page: page_id, lang, posterior, text_lang, declared, host, suffix.

    A page without text, declaration or host is judged by what is left, at last by the total prior; null html or url count
    as missing. A null id is kept; repeated rows are judged each; a very long page takes linear time and its trigrams are counted in chunks; an
    empty table gives no rows; without labelled documents lang is null. Other columns are ignored.
    """
    langs, likelihood = fit_text(docs, sample)
    if not langs:
        return pages.select(F.col("page_id").cast("long").alias("page_id"), *[F.lit(None).cast(k).alias(c) for c, k in (("lang", "string"), ("posterior", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string"), ("suffix", "string"))])
    n = len(langs)
    at = lambda c, i: F.get(c, F.lit(i))
    exps = lambda c: [F.exp(at(c, i)) for i in range(n)]
    got = evidence(pages, langs, likelihood)
    norm = reduce(lambda a, b: a + b, exps("ll"))
    got = written(got.withColumn("p", F.array(*[e / norm for e in exps("ll")])), "evidence")

    def sums(name: str, *keys: str) -> DataFrame:
        return got.groupBy(*keys).agg(F.array(*[F.sum(at("p", i)) for i in range(n)]).alias(name))

    total = [float(x or 0.0) for x in (sums("c").first()["c"] or [0.0] * n)]
    less = lambda c, i: F.greatest(F.lit(0.0), at(c, i) - at("p", i))  # noqa: E731  a count without the page's own share

    def shrunk(own, parent):
        """Share of each language among the counts ``own`` without the page, and SHRINK more in its parent's shares."""
        size = reduce(lambda a, b: a + b, [less(own, i) for i in range(n)])
        return F.when(F.col(own).isNull(), F.col(parent)).otherwise(F.array(*[(less(own, i) + SHRINK * at(parent, i)) / (size + SHRINK) for i in range(n)]))

    # one small row a host carries the counts of its domain and suffix as well
    suffix, domain = sums("cs", "suffix"), sums("cd", "suffix", "domain")
    host = sums("ch", "suffix", "domain", "host").join(domain.withColumnsRenamed({"suffix": "s1", "domain": "d1"}), F.col("suffix").eqNullSafe(F.col("s1")) & F.col("domain").eqNullSafe(F.col("d1")))
    host = host.join(suffix.withColumnRenamed("suffix", "s2"), F.col("suffix").eqNullSafe(F.col("s2"))).where("host is not null").select("host", "ch", "cd", F.when(F.col("suffix").isNotNull(), F.col("cs")).alias("cs"))
    declared = sums("cl", "declared").where("declared is not null")
    out = got.join(host, "host", "left").join(declared, "declared", "left")
    out = out.withColumn("all", F.array(*[F.lit(x) for x in total]))
    whole = reduce(lambda a, b: a + b, [less("all", i) for i in range(n)])
    out = out.withColumn("p0", F.array(*[(less("all", i) + 1) / (whole + n) for i in range(n)]))
    for own, parent, name in (("cs", "p0", "p1"), ("cd", "p1", "p2"), ("ch", "p2", "p3")):
        out = out.withColumn(name, shrunk(own, parent))
    # P(declared | language), smoothed over the values seen
    like = lambda i: F.when(F.col("cl").isNull(), 0.0).otherwise(F.log((less("cl", i) + 0.5) / (less("all", i) + 5.0)))
    out = out.withColumn("log", F.array(*[at("ll", i) + F.log(at("p3", i)) + like(i) for i in range(n)])).withColumn("top", F.array_max("log"))
    mass = reduce(lambda a, b: a + b, [F.exp(at("log", i) - F.col("top")) for i in range(n)])
    name = lambda c: F.get(F.array(*[F.lit(x) for x in langs]), F.array_position(c, F.array_max(c)).cast("int") - 1)
    return out.select("page_id", name("log").alias("lang"), (F.lit(1.0) / mass).alias("posterior"), name("ll").alias("text_lang"), "declared", "host", "suffix")


def op1_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
