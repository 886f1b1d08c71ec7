"""SimHash near-duplicates found with Golay-code keys.

A 64-bit fingerprint is cut into segments of 22, 21 and 21 bits, each padded with zeros to a word of
the perfect Golay code (23 bits, distance 7). With at most 4 differing bits, some pair of segments
differs in at most 2 bits together, so one of these holds for that pair (i, j):

* one bit at most differs in each: x's codeword index of i is among the indices of y's words within one
  flip, and y's index of j among those of x. Rows (index of i, flips of j) meet rows (flips of i, index of j). Two
  indices are only 24 bits; as one half of i has no error, its bits make the key selective (a row for each half).
* i is equal and j differs in two bits: the words between them decode alike, so rows (i's bits, flips of j)
  of both meet; and the same with i and j exchanged.

A word has 1 or 6 codewords within one flip. Rows that meet are verified by the exact bit count. Work is on
distinct fingerprints; in each bucket only a spanning forest of the verified links leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import connected_components, table, written

WORDS, DISTANCE, SEED = 4, 4, 42
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Rows of a bucket that one task compares with as many others.
BUCKET = 2048
#: Fingerprints whose bucket rows one task makes.
DEALT = 16384
_POLY = 0xC75  # fixed value: generator polynomial of the binary Golay code


def _golay() -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest codeword for each 23-bit word, syndrome's error pattern): built from the generator."""

    def rest(word: np.ndarray) -> np.ndarray:
        r = word.copy()
        for bit in range(22, 10, -1):
            r = np.where((r >> bit) & 1, r ^ (_POLY << (bit - 11)), r)
        return r

    bits = 1 << np.arange(23)
    one, two = bits, [a | b for i, a in enumerate(bits) for b in bits[:i]]
    three = [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    errors = np.array([0, *one, *two, *three], np.int64)
    pattern = np.zeros(2048, np.int64)
    pattern[rest(errors)] = errors
    unit = rest(np.array(bits, np.int64))
    return pattern, unit


_PATTERN, _UNIT = _golay()


def decode(word: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    syndrome = np.zeros(len(word), np.int64)
    for i in range(23):
        syndrome ^= np.where((word >> i) & 1, _UNIT[i], 0)
    return (word ^ _PATTERN[syndrome]) >> 11


def flips(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the distinct codeword indices of each word and of its 23 single flips."""
    all_ = np.sort(np.stack([decode(word), *(decode(word ^ (1 << i)) for i in range(23))], 1), 1)
    first = np.concatenate([np.ones((len(word), 1), bool), all_[:, 1:] != all_[:, :-1]], 1)
    row, col = np.nonzero(first)
    return row, all_[row, col]


def fingerprint(text: str, words: int = WORDS) -> int:
    import xxhash

    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    k = max(1, len(parts) - words + 1)
    starts = np.concatenate([[0], ends[:-1] + 1])[:k]
    stops = ends[min(words, len(parts)) - 1 :]
    h = xxhash.xxh64_intdigest
    got = np.array([h(line[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, k, 65536):
        counts += np.unpackbits(got[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(((2 * counts > k).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, the columns named in ``carry``, fp): the fingerprint as a signed long; null text counts as empty."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *carry, simhash(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("fp"))


def bucket_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, side, fp) of each fingerprint; side 0 meets side 1 in a bucket, side 2 meets side 2. The key's high bits name the segment pair and the case."""
    for batch in batches:
        fp = batch["fp"].to_numpy(np.int64)
        u = fp.view(np.uint64)
        seg = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
        home, near = [decode(s) for s in seg], [flips(s) for s in seg]
        for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
            (ri, ki), (rj, kj) = near[i], near[j]
            cases = [(4 * p, (seg[i][rj] << 12) | kj, 2, rj), (4 * p + 1, (seg[j][ri] << 12) | ki, 2, ri)]
            for half, bits in enumerate((seg[i] & 0x7FF, seg[i] >> 11)):
                cases += [(4 * p + 2 + half, (bits[rj] << 24) | (home[i][rj] << 12) | kj, 0, rj), (4 * p + 2 + half, (bits[ri] << 24) | (ki << 12) | home[j][ri], 1, ri)]
            for kind, key, side, row in cases:
                yield pd.DataFrame({"key": (np.int64(kind) << 40) | key, "side": np.full(len(key), side, np.int8), "fp": fp[row]})


def forest(fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links among ``fp``: breadth-first, each frontier against all not yet reached."""
    rest = np.unique(fp)
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            strip, later = front[:512], front[512:]
            close = np.bitwise_count(strip[:, None] ^ rest[None, :]) <= distance
            hit = close.any(0)
            if hit.any():
                found = rest[hit]
                yield strip[close.argmax(0)[hit]], found
                later, rest = np.concatenate([later, found]), rest[~hit]
            front = later


def meeting(distance: int):
    """Edges of every bucket in a partition sorted by (key, x, y). Small buckets are compared together, by row offset."""

    def edges(group: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
        size = np.diff(cuts)
        for g in np.flatnonzero(size > 8):
            yield from forest(fp[cuts[g] : cuts[g + 1]], distance)
        small = np.repeat(size <= 8, size)
        for d in range(1, 8):
            if len(fp) > d:
                both = np.flatnonzero(small[d:] & (group[d:] == group[:-d]))
                x, y = fp[both], fp[both + d]
                ok = (np.bitwise_count(x ^ y) <= distance) & (x != y)
                yield x[ok], y[ok]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            if kept is not None:
                batch = pd.concat([kept, batch], ignore_index=True)
            k, x, y = (batch[c].to_numpy() for c in ("key", "x", "y"))
            new = np.concatenate([[True], (k[1:] != k[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])])[: len(batch)]
            group = np.cumsum(new)
            last = np.searchsorted(group, group[-1]) if len(batch) else 0
            kept = batch.iloc[last:]
            for u, v in edges(group[:last], batch["fp"].to_numpy(np.int64).view(np.uint64)[:last]):
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
        if kept is not None and len(kept):
            for u, v in edges(np.zeros(len(kept), np.int64), kept["fp"].to_numpy(np.int64).view(np.uint64)):
                yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges (u, v) between the distinct fingerprints ``fps(fp)`` whose closure is that of all links at ``distance`` (at most 4) or fewer bits.

    A bucket with more than BUCKET rows is cut into blocks by the fingerprint's hash; each pair of blocks is a
    group of its own, so a group holds two blocks at most and all rows of a bucket still meet.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the keys find up to 4 differing bits")
    # a fingerprint becomes about a hundred rows, so the few bytes of ``fps`` are dealt to more tasks than their size asks for
    rows = fps.select("fp").repartition(max(1, -(-fps.count() // DEALT)), "fp").mapInPandas(bucket_rows, "key long, side byte, fp long")
    rows = written(rows, "keys")  # made once, and read for the sizes and for the join
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("side").alias("hi"), F.min("side").alias("lo"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    # apart from the join, so that a hot bucket's partition can be split there
    sizes = written(sizes.where("a <> b and (hi = 2 or lo < hi)").select("key", F.ceil(F.col("n") / BUCKET).cast("int").alias("blocks")), "sizes")
    block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, block).alias("x"), F.greatest(o, block).alias("y")))
    rows = rows.select("key", "fp").join(sizes.hint("merge"), "key").select("key", "fp", F.explode(pairs).alias("pair")).select("key", "fp", "pair.x", "pair.y")
    return rows.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInPandas(meeting(distance), "u long, v long")


def named_components(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, component) of every distinct fingerprint of ``fps``: the component is its smallest fingerprint."""
    distinct = written(fps.select("fp").distinct(), "distinct")
    comp = connected_components(links(distinct, distance))
    return written(distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp")), "named")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest doc_id reachable).

    Null and empty texts have fingerprint 0 and are linked like any other. A null id is kept (its component is
    that of the documents linked to it); repeated rows stay repeated; a very long text is one row like any other; an empty table gives no rows; other columns are ignored.
    """
    fps = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = named_components(fps, distance)
    of_fp = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = written(named.join(of_fp, "fp").groupBy("component").agg(F.min("least").alias("component_id")), "least")  # apart from the join, whose large components can then be split
    return fps.join(named.join(least, "component").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def keepers(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` of each component, with all columns: that of the least id (null ids last), among rows of one id that of the least digest of its text.

    Rows are told apart by id and text, so an id that is repeated with another text is another document. Of rows with equal id and text, the one with the least hash of
    all columns stays; they are combined before the shuffle, so a row that is repeated very often goes to no task in full. Null and empty texts are equal.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    digest = F.sha2(text, 256)
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), digest)
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), digest.alias("digest"), key.alias("key"))
    fps = written(fingerprints(marked, "doc_id", "text", words, ("digest", "key")), "fingerprints")
    best = fps.join(named_components(fps, distance), "fp").groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest", "key")).alias("b"))
    keep = written(best.select(F.col("b.key").alias("_key")), "kept")
    rows = docs.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row"))
    return rows.join(keep, "_key", "left_semi").select("_row.*")


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = components(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
