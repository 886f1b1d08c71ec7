"""Exact top-k BM25 search with a sharded inverted index and block-max WAND pruning.

Shards are built where the documents are read: a bounded number of documents each, with postings sorted by term and
document, written to the shared folder. Global statistics (documents, mean length, document frequencies of the query terms) come
from the shards, so their scores agree and the merge of their best rows is exact. Queries go in blocks of bounded size.

Within a shard, documents form ranges of BLOCK consecutive ones, and each posting list knows its maximum by range. A query of few terms is searched by
block-max WAND: cursors on its posting lists, the pivot where the lists' bounds add up to the k-th best score known, a check of the pivot range's maxima,
and skips. For a query of many terms (a whole document) cursors cost far more than they save, so its ranges are the pivots: bounds of all ranges and queries are
matrix products of frequent terms, on top of the rare terms' exact sums, and ranges are scored in order of their bounds until none reaches the k-th best score. A task carries its best rows from shard to shard and gives them out once.

Terms are told apart by 63 bits of a hash.
"""

from __future__ import annotations

import itertools
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meshwright.llm.common import shared_dir, table, written

K1, B, TOP = 1.2, 0.75, 10
BLOCK = 64
#: A term in at least one of so many documents of a shard (and in FEW documents) is held as a column.
DENSE, FEW = 16, 8
#: Queries of at most so many terms go by cursors.
SHORT = 12
#: Queries whose scores of a shard are held at once.
AT_ONCE = 64
#: Postings of a shard that are kept as lists between queries.
LISTED = 250_000
#: Bounds and scores are summed in different orders.
SLACK = 1e-7
#: A shard is closed at so many documents or postings.
SHARD_DOCS, SHARD_POSTINGS = 4096, 1_000_000
#: Queries and terms of theirs that are searched at once, on average: what a pass collects and broadcasts is bounded (16 bytes a term).
QUERY_BLOCK, QUERY_TERMS = 4096, 1_000_000
_INDEX = "n_docs long, total long, ids binary, lengths binary, terms binary, first binary, doc binary, tf binary"


class Terms:
    """64-bit term numbers of a text's words (lower case, split at white space) and their counts."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        import xxhash

        counts = Counter(text.lower().split())
        known = self.known
        if len(known) > 100_000:
            known.clear()
        terms = np.empty(len(counts), np.int64)
        for i, w in enumerate(counts):
            t = known.get(w)
            if t is None:
                t = known[w] = (xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) >> 1) - (1 << 62)
            terms[i] = t
        return terms, np.fromiter(counts.values(), np.int32, len(counts))


def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    make, ids, terms, tfs = Terms(), [], [], []

    def close(ids: list, terms: list, tfs: list) -> pd.DataFrame:
        # documents that are alike (by their commonest word, then by length) share ranges, whose bounds are then closer
        like = sorted(range(len(ids)), key=lambda i: (int(terms[i][tfs[i].argmax()]) if len(tfs[i]) else 0, int(tfs[i].sum()), ids[i]))
        ids, terms, tfs = [ids[i] for i in like], [terms[i] for i in like], [tfs[i] for i in like]
        length = np.array([int(t.sum()) for t in tfs], np.int64)
        term, tf = np.concatenate(terms), np.concatenate(tfs)
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), [len(t) for t in terms])
        order = np.argsort(term, kind="stable")  # documents stay in order within a term
        term, tf, doc = term[order], tf[order], doc[order]
        distinct, first = np.unique(term, return_index=True)
        data = [len(ids), int(length.sum()), np.array(ids, np.int64).tobytes(), length.tobytes(), distinct.tobytes(), np.append(first, len(term)).astype(np.int32).tobytes(), doc.tobytes(), tf.astype(np.int32).tobytes()]
        return pd.DataFrame([data], columns=[c.split()[0] for c in _INDEX.split(", ")])

    held = 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            t, n = make(text)
            ids.append(int(doc_id))
            terms.append(t)
            tfs.append(n)
            held += len(t)
            if len(ids) >= SHARD_DOCS or held >= SHARD_POSTINGS:
                yield close(ids, terms, tfs)
                ids, terms, tfs, held = [], [], [], 0
    if ids:
        yield close(ids, terms, tfs)


class Shard:
    """An index shard opened for a block of queries over the sorted terms ``asked``.

    Terms in at least one of DENSE documents are kept as columns of gains, so that their bounds of all queries are one
    matrix product and their scores in a range another; the postings of the others stay sparse, and are summed for AT_ONCE queries in one go.
    """

    def __init__(self, row, mean_length: float, asked: np.ndarray):
        read = lambda c, kind: np.frombuffer(row[c], kind)
        self.ids, terms, first, doc, tf = read("ids", np.int64), read("terms", np.int64), read("first", np.int32), read("doc", np.int32), read("tf", np.int32)
        norm = K1 * (1 - B + B * read("lengths", np.int64) / max(mean_length, 1e-9))
        self.ranges = -(-len(self.ids) // BLOCK)
        at = np.minimum(np.searchsorted(terms, asked), max(0, len(terms) - 1))
        here = np.flatnonzero(terms[at] == asked) if len(terms) else np.empty(0, np.int64)
        start, end = first[at[here]].astype(np.int64), first[at[here] + 1].astype(np.int64)
        often = (end - start) * DENSE >= max(len(self.ids), FEW * DENSE)  # of few long documents none is: columns would be mostly room
        gain = lambda posts: tf[posts] * (K1 + 1) / (tf[posts] + norm[doc[posts]])
        # columns of frequent terms, and their maxima by range
        self.dense = here[often]
        posts = spans(start[often], end[often])
        self.column = np.zeros((self.ranges * BLOCK, len(self.dense)))
        self.column[doc[posts], np.repeat(np.arange(len(self.dense)), (end - start)[often])] = gain(posts)
        self.column_max = self.column.reshape(self.ranges, BLOCK, len(self.dense)).max(1)
        # postings of the others, and their maxima by run of one term in one range
        posts = spans(start[~often], end[~often])
        self.gain, self.doc = gain(posts), doc[posts].astype(np.int64)
        n = (end - start)[~often]
        run = np.repeat(np.arange(len(n)), n) * np.int64(max(1, self.ranges)) + self.doc // BLOCK
        self.run_first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.empty(0, np.int64)
        self.run_end = np.append(self.run_first[1:], len(run))[: len(self.run_first)]
        self.run_max = np.maximum.reduceat(self.gain, self.run_first) if len(run) else np.empty(0)
        self.run_range = self.doc[self.run_first] // BLOCK
        self.dense_slot, self.slot = np.full(len(asked), -1, np.int64), np.full(len(asked), -1, np.int64)  # of a term among either kind
        self.dense_slot[self.dense] = np.arange(len(self.dense))
        self.slot[here[~often]] = np.arange(len(n))
        self.slot_first = np.concatenate([[0], np.cumsum(n)])
        self.listed: dict[int, tuple] = {}  # posting lists by term, and their postings
        self.held = 0
        self.slot_run = np.searchsorted(run[self.run_first], np.arange(len(n) + 1) * np.int64(max(1, self.ranges)))

    def lists(self, terms: np.ndarray) -> list[tuple[list[int], list[float], list[int], list[float]]]:
        """Posting list of each asked term that occurs here: documents and the end of all, gains, ranges and their maxima."""
        out, end = [], [self.ranges * BLOCK]
        for t in terms.tolist():
            if t in self.listed:
                out.append(self.listed[t])
                continue
            if (c := self.dense_slot[t]) >= 0:
                doc = np.flatnonzero(self.column[:, c])
                ranges = np.flatnonzero(self.column_max[:, c])
                out.append((doc.tolist() + end, self.column[doc, c].tolist(), ranges.tolist(), self.column_max[ranges, c].tolist()))
            elif (c := self.slot[t]) >= 0:
                a, b = self.slot_run[c], self.slot_run[c + 1]
                post = slice(self.run_first[a], self.run_end[b - 1])
                out.append((self.doc[post].tolist() + end, self.gain[post].tolist(), self.run_range[a:b].tolist(), self.run_max[a:b].tolist()))
            else:
                out.append((end, [], [], []))
            self.held += len(out[-1][0])
            if self.held > LISTED:
                self.listed, self.held = {}, len(out[-1][0])
            self.listed[t] = out[-1]
        return out

    def wand(self, terms: np.ndarray, weights: np.ndarray, floor: float, top: int, seen: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of a query's best documents with a positive score that reaches ``floor``, by block-max WAND. ``seen`` gets the documents scored."""
        # a cursor: its document, position, weight, bound, and the list; the list's end stands after all documents
        cursors = [[docs[0], 0, w, w * max(maxima), docs, gains, ranges, maxima] for (docs, gains, ranges, maxima), w in zip(self.lists(terms), weights.tolist()) if gains and w > 0]
        end, heap = self.ranges * BLOCK, []  # (score, -id): the worst of the best first

        def bound(c: list, r: int) -> float:  # of the list's postings in a range
            k = bisect_left(c[6], r)
            return c[2] * c[7][k] if k < len(c[6]) and c[6][k] == r else 0.0

        def move(c: list, to: int) -> None:
            c[1] = bisect_left(c[4], to, c[1])
            c[0] = c[4][c[1]]

        while True:
            cursors.sort(key=itemgetter(0))
            while cursors and cursors[-1][0] >= end:
                cursors.pop()
            total, pivot = 0.0, None
            for pivot, c in enumerate(cursors):
                total += c[3]
                if total >= floor - SLACK:
                    break
            else:
                break
            doc = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == doc:
                pivot += 1
            here = cursors[: pivot + 1]
            if sum(bound(c, doc // BLOCK) for c in here) >= floor - SLACK:
                if here[0][0] < doc:  # cursors before the pivot catch up
                    for c in here:
                        move(c, doc)
                    continue
                score = sum(c[2] * c[5][c[1]] for c in here)
                if seen is not None:
                    seen.append(doc)
                for c in here:
                    c[1] += 1
                    c[0] = c[4][c[1]]
                if score > 0 and score >= floor - SLACK:
                    heappush(heap, (score, -int(self.ids[doc])))
                    if len(heap) > top:
                        heappop(heap)
                    if len(heap) == top:
                        floor = max(floor, heap[0][0])
            else:  # nothing in this range: skip to the next one, or to the next list's document
                to = (doc // BLOCK + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                for c in here:
                    move(c, to)
        heap.sort(key=lambda x: (-x[0], -x[1]))
        return np.array([-i for _, i in heap], np.int64), np.array([s for s, _ in heap], float)

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of each query's best documents with a positive score that reaches its floor; ties by the smaller id.

        ``queries``: positions in the asked terms, and weights. A floor is a score that ``top`` documents are known to reach.
        What sparse terms add is summed for all documents. A range's bound is the most of that in it, and the maxima of the frequent terms.
        Ranges are taken in rounds in order of their bounds; in a round, the queries that still need a range share its product.
        """
        short = [k for k, (terms, _) in enumerate(queries) if len(terms) <= SHORT]
        if short:
            out = [self.wand(*queries[k], floors[k], top) if len(queries[k][0]) <= SHORT else None for k in range(len(queries))]
            rest = [k for k in range(len(queries)) if out[k] is None]
            for k, got in zip(rest, self.search([queries[k] for k in rest], floors[rest], top) if rest else []):
                out[k] = got
            return out
        out = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        for a in range(0, len(queries), AT_ONCE):
            out[a : a + AT_ONCE] = self.ranged(queries[a : a + AT_ONCE], floors[a : a + AT_ONCE].copy(), top)
        return out

    def ranged(self, queries: list[tuple[np.ndarray, np.ndarray]], floors: np.ndarray, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
        terms, w = np.concatenate([x[0] for x in queries]), np.concatenate([x[1] for x in queries])
        query = np.repeat(np.arange(len(queries)), [len(x[0]) for x in queries])
        weight, at = np.zeros((len(queries), len(self.dense))), self.dense_slot[terms]
        often = np.flatnonzero(at >= 0)
        weight[query[often], at[often]] = w[often]
        at = self.slot[terms]
        seldom = np.flatnonzero(at >= 0)
        at, n = at[seldom], self.ranges * BLOCK
        first, end = self.slot_first[at], self.slot_first[at + 1]
        posts = spans(first, end)
        score = np.bincount(self.doc[posts] + np.repeat(query[seldom] * n, end - first), self.gain[posts] * np.repeat(w[seldom], end - first), len(queries) * n).reshape(len(queries), self.ranges, BLOCK)
        bounds = weight @ self.column_max.T + score.max(2)
        rank = np.argsort(np.argsort(-bounds, axis=1, kind="stable"), axis=1, kind="stable")
        out = [(np.empty(0, np.int64), np.empty(0)) for _ in queries]
        done, step = 0, 4
        while done < self.ranges:
            live = (rank >= done) & (rank < done + step) & (bounds > 0) & (bounds >= floors[:, None] - SLACK)
            for r in np.flatnonzero(live.any(0)):
                ks = np.flatnonzero(live[:, r])
                score[ks, r] += weight[ks] @ self.column[r * BLOCK : (r + 1) * BLOCK].T
            k, r = np.nonzero(live)
            mine = score[k, r]
            i, d = np.nonzero(mine > np.maximum(0.0, floors - SLACK)[k, None])
            ids, scores, first = self.ids[r[i] * BLOCK + d], mine[i, d], np.searchsorted(k[i], np.arange(len(queries) + 1))
            for k in np.flatnonzero(first[1:] > first[:-1]):
                found = slice(first[k], first[k + 1])
                mine_ids, mine_scores = np.concatenate([out[k][0], ids[found]]), np.concatenate([out[k][1], scores[found]])
                best = np.lexsort((mine_ids, -mine_scores))[:top]
                out[k] = mine_ids[best], mine_scores[best]
                if len(best) == top:
                    floors[k] = max(floors[k], mine_scores[best[-1]])
            done += step
            step *= 8
        return out


def spans(first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All positions of the ranges [first, end), one range after the other."""
    n = (end - first).astype(np.int64)
    total = int(n.sum())
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total) if total else np.empty(0, np.int64)


def search(docs: DataFrame, queries: DataFrame, top: int = TOP, doc_id: str = "doc_id", doc_text: str = "text", query_id: str = "doc_id", query_text: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score: the ``top`` documents of each query by BM25 (ties by the smaller id).

    A query's weight of a term is its count in the query. Null texts have no words; queries without words in the corpus have no
    rows; rows with a null id are neither searched nor found; repeated document rows are found as often as they
    occur, repeated query ids are one query each row's text adds to; a very long text closes its shard (a shard's postings then pass the limit by that text's distinct words);
    empty tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("text")
    index = written(docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), text(doc_text)).mapInPandas(build, _INDEX), "shards")
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("total").alias("t")).first()
    schema = "query_id long, doc_id long, score double"
    if not total["n"]:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    n, mean = int(total["n"]), total["t"] / total["n"]

    def of_queries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Terms()
        for batch in batches:
            got = [make(t) for t in batch["text"]]
            yield pd.DataFrame({"query_id": batch["query_id"], "terms": [g[0] for g in got], "counts": [g[1] for g in got]})

    asked = queries.where(F.col(query_id).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), text(query_text))
    asked = written(asked.mapInPandas(of_queries, "query_id long, terms array<long>, counts array<int>"), "queries")
    load = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(1, -(-load["n"] // QUERY_BLOCK), -(-load["terms"] // QUERY_TERMS))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    found, asked_any = f"{shared_dir(spark).rstrip('/')}/found-{uuid.uuid4().hex}.parquet", False  # one table for all blocks
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).orderBy("query_id").collect()  # a block: bounded
        if not rows:
            continue
        asked_any = True
        merged: dict[int, Counter] = {}
        for r in rows:
            merged.setdefault(r["query_id"], Counter()).update(dict(zip(r["terms"], r["counts"])))
        distinct = np.unique(np.fromiter(itertools.chain.from_iterable(merged.values()), np.int64))
        sent = spark.sparkContext.broadcast(distinct)

        def frequencies(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            want, df = sent.value, np.zeros(len(sent.value), np.int64)
            for batch in batches:
                for terms, first in zip(batch["terms"], batch["first"]):
                    t, f = np.frombuffer(terms, np.int64), np.frombuffer(first, np.int32)
                    if len(t):
                        at = np.minimum(np.searchsorted(t, want), len(t) - 1)
                        df += np.where(t[at] == want, f[at + 1] - f[at], 0)
            hit = np.flatnonzero(df)
            yield pd.DataFrame({"i": hit, "df": df[hit]})

        df = np.zeros(len(distinct), np.int64)
        for r in index.select("terms", "first").mapInPandas(frequencies, "i long, df long").groupBy("i").agg(F.sum("df").alias("df")).toLocalIterator():
            df[r["i"]] = r["df"]
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        ask = []
        for q, counts in merged.items():
            at = np.searchsorted(distinct, np.fromiter(counts, np.int64, len(counts)))
            ask.append((q, at, np.fromiter(counts.values(), np.float64, len(counts)) * idf[at]))
        sent_queries = spark.sparkContext.broadcast((distinct, ask))

        def scored(batches: Iterator[pd.DataFrame], sent_queries=sent_queries) -> Iterator[pd.DataFrame]:
            distinct, ask = sent_queries.value
            # the best rows in this task so far: the last score is a floor for its other shards
            best = [(np.empty(0, np.int64), np.empty(0))] * len(ask)
            floors, queries = np.zeros(len(ask)), [x[1:] for x in ask]
            for batch in batches:
                for row in batch.to_dict("records"):
                    for k, (ids, scores) in enumerate(Shard(row, mean, distinct).search(queries, floors, top)):
                        if len(ids):
                            ids, scores = np.concatenate([best[k][0], ids]), np.concatenate([best[k][1], scores])
                            order = np.lexsort((ids, -scores))[:top]
                            best[k] = ids[order], scores[order]
                            if len(order) == top:
                                floors[k] = scores[order[-1]]
            yield pd.DataFrame({"query_id": np.repeat([x[0] for x in ask], [len(o[0]) for o in best]).astype(np.int64), "doc_id": np.concatenate([o[0] for o in best]), "score": np.concatenate([o[1] for o in best])})

        index.select("ids", "lengths", "terms", "first", "doc", "tf").mapInPandas(scored, schema).write.mode("append").parquet(found)
        sent.unpersist()
        sent_queries.unpersist()
    if not asked_any:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    every = spark.read.schema(schema).parquet(found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return every.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "doc_id", "score")


def op4_bm25_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return search(docs, docs.where(F.col("doc_id") % 100 == 0))
