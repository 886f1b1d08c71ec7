"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c differ by a squared distance of 2 - 2c. Rotated vectors are split into blocks; of two
vectors within that distance, some block differs by at most its share (in proportion to its dimensions). So each block is range-joined under
its budget, and the candidates are verified exactly, in double precision, and counted in the first block whose budget they meet.

The range join has two levels. A label's vectors are one group as long as they are few. A group that isn't is taken apart: it is joined block by block,
and cells over the block's coordinates, twice the block radius wide, send a vector to its own cell and, as a probe, to the neighbours that its
budget still reaches; one coordinate after the other, only in cells that are still large. Within a group a finer grid over the block's first
coordinates, with cells of one radius, gives the pairs to compare. Of two near vectors in different cells, the one in the earlier cell probes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshwright.llm.common import connected_components, cut, table, written

COSINE = 0.98
BLOCKS = 8
#: Coordinates of the grid within a group.
GRID = 5
#: A group that one task joins has at most so many rows, and numbers in its vectors.
ROWS, VALUES = 16384, 1 << 22
#: Pairs whose distances are computed at once.
PAIRS = 1 << 18


def rotation(dim: int, seed: int = 17) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def block_slices(dim: int, blocks: int) -> list[slice]:
    ends = [round(i * dim / blocks) for i in range(blocks + 1)]
    return [slice(a, b) for a, b in zip(ends, ends[1:]) if b > a]


def squared_budget(cosine: float) -> float:
    return max(0.0, 2 - 2 * cosine) + 1e-6  # rotation and scaling are inexact; the verification is not


def doubles(vectors: pd.Series) -> np.ndarray:
    """Vectors in double precision, each scaled by a power of two (which is exact), so that no square overflows."""
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None]) if x.size else x


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def refine(dim: int, cosine: float, blocks: int, depth: int):
    """Rows of a large cell, dealt by the block's next coordinate. Role 0 is at home, role 1 a probe that has used a part of its budget."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, parts, budget = rotation(dim), block_slices(dim, blocks), squared_budget(cosine)
        for batch in batches:
            if not len(batch):
                continue
            x = unit(doubles(batch["vec"])) @ turn
            if depth == 0:  # from a label's only group to a cell for each block
                rows = [(batch.assign(block=k), x) for k in range(len(parts))]
            else:
                rows = [(batch[at], x[at]) for k in range(len(parts)) if (at := (batch["block"] == k).to_numpy()).any()]
            for own, y in rows:
                part = parts[int(own["block"].iloc[0])]
                if depth >= part.stop - part.start:  # this block has no more coordinates
                    yield own.assign(cell=[[*c, 0] for c in own["cell"]])
                    continue
                share = budget * (part.stop - part.start) / dim + 1e-9
                width = 2 * np.sqrt(share)
                z = y[:, part.start + depth] / width
                home = np.floor(z).astype(np.int64)
                probes, used = own["role"].to_numpy() == 1, own["used"].to_numpy()
                for step, gap in ((0, np.zeros(len(z))), (1, home + 1 - z), (-1, z - home)):
                    spent = used + (gap * width) ** 2
                    go = spent <= share
                    if step < 0:
                        go &= probes  # from its home a vector probes upwards only; later coordinates differ in either direction
                    if go.any():
                        cells = [[*c, int(h) + step] for c, h in zip(own["cell"].to_numpy()[go], home[go])]
                        yield own[go].assign(cell=cells, used=spent[go], role=np.where(probes[go] | (step != 0), 1, 0).astype(np.int32))

    return run


def near_pairs(x: np.ndarray, radius: float, grid: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (each at most once, in bounded portions) among which are all rows of ``x`` within ``radius``: equal or neighbouring cells of a grid one radius wide."""
    z = x[:, :grid] / radius
    cell = np.floor(z).astype(np.int64)
    cell -= cell.min(0)
    sizes = cell.max(0) + 3
    while np.prod(sizes.astype(float)) > 2.0**62:
        z, cell, sizes = z[:, :-1], cell[:, :-1], sizes[:-1]
    scale = np.append(np.cumprod(sizes[::-1])[::-1][1:], 1)
    code = (cell + 1) @ scale
    order = np.argsort(code, kind="stable")
    z, code, n = z[order], code[order], len(order)
    up = np.floor(z) + 1 - z

    def expand(rows: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        some = end > first
        rows, first, count = rows[some], first[some], (end - first)[some]
        total = np.cumsum(count)
        at = 0
        while at < len(rows):
            stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
            c = count[at:stop]
            i = np.repeat(rows[at:stop], c)
            j = np.repeat(first[at:stop] - np.concatenate([[0], np.cumsum(c)[:-1]]), c) + np.arange(int(c.sum()))
            yield order[i], order[j]
            at = stop

    every = np.arange(n)
    yield from expand(every, every + 1, np.searchsorted(code, code, "right"))
    for step in itertools.product((-1, 0, 1), repeat=z.shape[1]):
        if step <= (0,) * len(step):
            continue  # the earlier of two cells probes the later
        gap = sum(((up[:, d] if s > 0 else 1 - up[:, d]) ** 2 for d, s in enumerate(step) if s), np.zeros(n))
        rows = np.flatnonzero(gap <= 1)  # the ball around the row reaches the cell
        if len(rows):
            to = code[rows] + int(np.dot(step, scale))
            yield from expand(rows, np.searchsorted(code, to), np.searchsorted(code, to, "right"))


def linked_pairs(vec: np.ndarray, home: np.ndarray, side: np.ndarray | None, block: int, cosine: float, blocks: int, tally: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified index pairs of a group, each in the first block whose budget it meets; of ``block`` only, unless that is -1.

    Pairs of two probes are left out; with ``side``, so are those of one side. ``tally`` gets the number of pairs compared.
    """
    dim = vec.shape[1]
    x, parts, budget = unit(vec) @ rotation(dim), block_slices(dim, blocks), squared_budget(cosine)
    share = lambda s: budget * (s.stop - s.start) / dim + 1e-9

    def close(p: np.ndarray, q: np.ndarray, s: slice) -> np.ndarray:
        d = x[p, s] - x[q, s]
        return np.einsum("ij,ij->i", d, d) <= share(s)

    for k, part in enumerate(parts):
        if block not in (-1, k):
            continue
        for p, q in near_pairs(x[:, part], np.sqrt(share(part)) * (1 + 1e-9), min(GRID, part.stop - part.start)):
            if tally is not None:
                tally.append(len(p))
            ok = close(p, q, part) & (home[p] | home[q])
            if side is not None:
                ok &= side[p] != side[q]
            p, q = p[ok], q[ok]
            for s in parts[:k]:
                later = ~close(p, q, s)
                p, q = p[later], q[later]
            ok = exact_cosine(vec[p], vec[q]) >= cosine
            yield p[ok], q[ok]


class Forest:
    """Spanning forest of the links seen."""

    def __init__(self, n: int):
        self.label, self.edges = np.arange(n), []

    def add(self, p: np.ndarray, q: np.ndarray) -> None:
        for at in range(0, len(p), 4096):
            u, v = p[at : at + 4096], q[at : at + 4096]
            apart = self.label[u] != self.label[v]
            for a, b in zip(u[apart].tolist(), v[apart].tolist()):
                if (la := self.label[a]) != (lb := self.label[b]):
                    self.label[self.label == lb] = la
                    self.edges.append((a, b))


def meet(cosine: float, blocks: int):
    """Per group: n (rows linked) of each class, and a spanning forest of the links."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first, second = int(key[3]), int(key[4])
        vec, cls, n = doubles(pdf["vec"]), pdf["cls"].to_numpy(), pdf["n"].to_numpy()
        side = None if first == second else pdf["own"].to_numpy() == first
        counts, forest = np.zeros(len(pdf), np.int64), Forest(len(pdf))
        for p, q in linked_pairs(vec, pdf["role"].to_numpy() == 0, side, int(key[1]), cosine, blocks):
            np.add.at(counts, p, n[q])
            np.add.at(counts, q, n[p])
            forest.add(p, q)
        some = np.flatnonzero(counts)
        u, v = np.array(forest.edges, np.int64).reshape(-1, 2).T
        other = pd.array([None] * len(some), "Int64")
        return pd.concat([pd.DataFrame({"cls": cls[some], "other": other, "n": counts[some]}), pd.DataFrame({"cls": cls[u], "other": pd.array(cls[v], "Int64"), "n": 0})], ignore_index=True)

    return run


def groups(classes: DataFrame, dim: int, cosine: float, blocks: int) -> DataFrame:
    """``classes`` (label, vec, cls, n) as rows of groups (label, block, cell, a, b), each small enough for a task."""
    most = max(2, min(ROWS, VALUES // max(1, dim)))
    key = "label", "block", "cell"
    rows = classes.select("label", F.lit(-1).alias("block"), F.expr("cast(array() as array<int>)").alias("cell"), F.lit(0).alias("role"), F.lit(0.0).alias("used"), "cls", "n", "vec")
    schema, done = rows.schema, []
    for depth in range(max(s.stop - s.start for s in block_slices(dim, blocks)) + 1):
        # a cell needs a row at home and another one; the counts are written, so that a large cell's partition can be split
        load = rows.groupBy(*key).agg(F.count("*").alias("m"), F.min("role").alias("least")).where("m > 1 and least = 0").select(*key, "m")
        load = written(load, "cells")
        rows = rows.join(load, [*key])
        done.append(rows.where(F.col("m") <= most))
        rows = rows.where(F.col("m") > most)
        if load.where(F.col("m") > most).isEmpty():
            rows = None
            break
        if depth == max(s.stop - s.start for s in block_slices(dim, blocks)):
            break
        rows = written(rows.select(*schema.names).mapInPandas(refine(dim, cosine, blocks, depth), schema), "refined")
    small = done[0]
    for more in done[1:]:
        small = small.unionByName(more)
    small = small.withColumns({"own": F.lit(0), "a": F.lit(0), "b": F.lit(0)})
    if rows is None:
        return small
    # rows that agree in all coordinates of a block's grid: each pair of parts is a group of its own
    parts = F.ceil(F.col("m") / most).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls"), parts).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("a"), F.greatest(o, F.col("own")).alias("b")))
    rows = rows.withColumn("pair", F.explode(pairs)).withColumns({"a": F.col("pair.a"), "b": F.col("pair.b")}).drop("pair")
    return small.unionByName(rows)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, or hold null or non-finite components, and rows without a label, link with nothing.
    Copies (equal label and vector) are joined first: one class carries their number, so the join never sees
    them. Vectors are compared with those of their own length. Rows are told apart by label and vector, never by id: repeated ids give repeated
    rows, each with its own links. A null id links like another; it is no component's id unless all ids there are null (then the component's id is null), and such a row
    is not kept. Vectors of any finite size are scaled exactly. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>").alias("vec") if dict(vectors.dtypes)[vector_col] != "array<double>" else F.col(vector_col).alias("vec"), F.col(label_col).alias("label"))
    fine = F.col("label").isNotNull() & F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vec", lambda x: x != 0)
    df = df.withColumn("fine", F.coalesce(fine, F.lit(False)))
    good = df.where("fine")
    classes = cut(good.groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count("*").alias("n")).withColumn("cls", F.monotonically_increasing_id()))
    linked = spark.createDataFrame([], "cls long, other long, n long")
    for r in classes.select(F.size("vec").alias("d")).distinct().collect():  # vector lengths, a handful
        found = groups(classes.where(F.size("vec") == r["d"]), r["d"], cosine, blocks).select("label", "block", "cell", "a", "b", "own", "role", "cls", "n", "vec")
        linked = linked.unionByName(found.groupBy("label", "block", "cell", "a", "b").applyInPandas(meet(cosine, blocks), "cls long, other long, n long"))
    linked = written(linked, "linked")
    counts = linked.where("other is null").groupBy("cls").agg(F.sum("n").alias("linked"))
    comp = connected_components(linked.where("other is not null").select(F.col("cls").alias("u"), F.col("other").alias("v"))).withColumnRenamed("node", "cls")
    named = cut(classes.join(counts, "cls", "left").join(comp, "cls", "left").select("label", "vec", "least", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "cls").alias("component")))
    least = cut(named.groupBy("component").agg(F.min("least").alias("component_id")))  # apart from the join, whose large components can then be split
    out = good.join(named.join(least, "component").select("label", "vec", "n_links", "component_id"), ["label", "vec"]).select("vec_id", "n_links", "component_id")
    rest = df.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_embedding_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
