"""Vectors within a cosine of each other, by epsilon grid order join.

Unit vectors with a cosine of at least c lie within epsilon = sqrt(2 - 2c). They are rotated
so that the leading dimensions spread most, laid into a grid of side epsilon there and sorted
by cell. Blocks of the sorted sequence are paired where their boxes are within epsilon; inside
a pair the sequence intervals are halved recursively, and provably distant ones are skipped
(Boehm, Braunmueller, Krebs and Kriegel, 2001). What remains is compared in full, in double
precision. Distances in some rotated dimensions never exceed whole distances, so nothing is
lost, however well the rotation fits.

Equal vectors are one node with a weight. A pair of blocks returns, per node, how many vectors
it links to, and a spanning forest of the links, never the links themselves.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from assayframe.operators.ranking import number_rows
from assayframe.session import settle

from .components import components
from .text import map_arrow
from .vectors import matrix_of

#: Leading dimensions of the grid; vectors the rotation is fitted on, at most, chosen by a hash
#: of their key; vectors of a block; vectors of an interval that is compared at once.
DIMS, SAMPLE, BLOCK, LEAF = 8, 5000, 4096, 256
#: Slack for rounding in bounds; cosines this close to the limit are summed exactly.
_SLACK = 1e-9
#: Links a task holds before it reduces them to a forest.
_HELD = 1 << 20


def _unit(v: np.ndarray) -> np.ndarray:
    top = np.abs(v).max(axis=1, keepdims=True)
    v = v / np.where(top > 0, top, 1)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _rotation(nodes: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """(width, axes): the longest vector's length, and the leading principal axes of a sample."""
    width = nodes.agg(F.max(F.size("v"))).first()[0] or 1
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v").collect()
    v = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        v[i, :len(r[0])] = r[0]
    if len(v) < 2:
        return width, np.eye(width)[:, :dims]
    v = _unit(v)
    _, axes = np.linalg.eigh(np.cov(v, rowvar=False).reshape(width, width))
    return width, axes[:, ::-1][:, :dims]


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    dot = math.fsum(a * b)
    return dot / math.sqrt(math.fsum(a * a) * math.fsum(b * b))


class Joiner:
    """Joins two blocks (or one with itself): unit vectors, projections, node weights."""

    def __init__(self, a, b, limit: float, leaf: int = LEAF):
        self.same = b is None
        self.a, self.b = a, a if self.same else b
        self.limit, self.eps2 = limit, (2 - 2 * limit) * (1 + _SLACK) + _SLACK
        self.leaf = leaf
        self.na, self.nb = len(self.a[0]), len(self.b[0])
        size = self.na + (0 if self.same else self.nb)
        self.shift = 0 if self.same else self.na
        self.links = np.zeros(size, np.int64)
        self.i: list[np.ndarray] = []
        self.j: list[np.ndarray] = []
        self.held = self.compared = 0

    def _far(self, a0, a1, b0, b1) -> bool:
        p, q = self.a[1][a0:a1], self.b[1][b0:b1]
        gap = np.maximum(0, np.maximum(p.min(0) - q.max(0), q.min(0) - p.max(0)))
        return float(gap @ gap) > self.eps2

    def join(self, a0: int, a1: int, b0: int, b1: int) -> None:
        if self.same and (a0, a1) == (b0, b1):
            if a1 - a0 <= self.leaf:
                self._compare(a0, a1, b0, b1)
                return
            m = (a0 + a1) // 2
            self.join(a0, m, a0, m)
            self.join(a0, m, m, a1)
            self.join(m, a1, m, a1)
            return
        if self._far(a0, a1, b0, b1):
            return
        if max(a1 - a0, b1 - b0) <= self.leaf:
            self._compare(a0, a1, b0, b1)
        elif a1 - a0 >= b1 - b0:
            m = (a0 + a1) // 2
            self.join(a0, m, b0, b1)
            self.join(m, a1, b0, b1)
        else:
            m = (b0 + b1) // 2
            self.join(a0, a1, b0, m)
            self.join(a0, a1, m, b1)

    def _compare(self, a0, a1, b0, b1) -> None:
        self.compared += (a1 - a0) * (b1 - b0)
        near = self.a[0][a0:a1] @ self.b[0][b0:b1].T
        i, j = np.nonzero(near >= self.limit - _SLACK)
        if self.same:
            keep = i + a0 < j + b0
            i, j = i[keep], j[keep]
        for k in np.flatnonzero(near[i, j] < self.limit + _SLACK):
            if _exact(self.a[0][a0 + i[k]], self.b[0][b0 + j[k]]) < self.limit:
                i[k] = -1
        i, j = i[i >= 0] + a0, j[i >= 0] + b0
        if len(i) == 0:
            return
        np.add.at(self.links, i, self.b[2][j])
        np.add.at(self.links, j + self.shift, self.a[2][i])
        self.i.append(i)
        self.j.append(j + self.shift)
        self.held += len(i)
        if self.held > _HELD:
            self.forest()

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """The links held, as stars below the first node of each component."""
        if not self.i:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        i, j = np.concatenate(self.i), np.concatenate(self.j)
        label = np.arange(len(self.links))
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            label = label[label]
            if (label == before).all():
                break
        node = np.flatnonzero(label != np.arange(len(label)))
        self.i, self.j, self.held = [node], [label[node]], len(node)
        return node, label[node]


def _block_rows(cells: DataFrame, size: int, kind: str) -> DataFrame:
    """One row per block: ids, weights, vectors and the box of its projections."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position").combine_chunks()
        _, v = matrix_of(table["v"].combine_chunks())
        p = np.array(table["p"].to_pylist())
        return pa.table({
            "block": table["block"][:1], "n": [len(v)],
            "ids": [table["node"].to_numpy().astype(np.int64).tobytes()],
            "weights": [table["weight"].to_numpy().astype(np.int64).tobytes()],
            "vectors": [v.astype(kind).tobytes()], "low": [p.min(0)], "high": [p.max(0)]})

    return cells.withColumn("block", F.floor((F.col("position") - 1) / size)) \
        .groupBy("block").applyInArrow(
            run, "block long, n long, ids binary, weights binary, vectors binary, "
                 "low array<double>, high array<double>")


def _pairs(blocks: DataFrame, eps: float) -> DataFrame:
    """(a, b): numbers of blocks whose boxes are within eps. Blocks meet in strips of the
    leading dimension, and a pair counts in the first strip both reach."""
    box = blocks.select("block", "low", "high",
                        F.floor(F.expr("low[0]") / eps).alias("from"),
                        (F.floor(F.expr("high[0]") / eps) + 1).alias("to")) \
        .withColumn("strip", F.explode(F.sequence("from", "to")))
    a, b = box.alias("a"), box.alias("b")
    gap = F.expr("aggregate(zip_with(zip_with(a.low, b.high, (x, y) -> x - y), "
                 "zip_with(b.low, a.high, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D)), 0D, "
                 "(s, x) -> s + x * x)")
    return a.join(b, F.expr("a.strip = b.strip AND a.block <= b.block "
                            "AND a.strip = greatest(a.from, b.from)")) \
        .where(gap <= eps * eps * (1 + _SLACK) + _SLACK) \
        .select(F.col("a.block").alias("a"), F.col("b.block").alias("b"))


def near_links(nodes: DataFrame, limit: float, dims: int = DIMS, block: int = BLOCK,
               leaf: int = LEAF) -> DataFrame:
    """(node, links, other): per node and pair of blocks, the weight of what ``node`` links to
    there, and (if not null) a node it is connected to. ``nodes``: node, weight, v."""
    eps = math.sqrt(2 - 2 * limit)
    width, axes = _rotation(nodes, dims)
    kind = "f4" if isinstance(nodes.schema["v"].dataType.elementType, T.FloatType) else "f8"

    def project(batch: pa.RecordBatch):
        _, v = matrix_of(batch.column(2))
        v = np.pad(v, ((0, 0), (0, width - v.shape[1])))
        p = _unit(v) @ axes
        cell = np.floor(p / eps).astype(np.int64)
        yield [*batch.columns[:2], batch.column(2).cast(pa.list_(pa.float64())),
               pa.array(list(p), pa.list_(pa.float64())),
               pa.array(list(cell), pa.list_(pa.int64()))]

    out = "node long, weight long, v array<double>, p array<double>, cell array<long>"
    placed = nodes.select("node", "weight", "v").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays(x, names=["node", "weight", "v", "p", "cell"])
                         for b in batches for x in project(b)), out)
    cells = number_rows(placed, [], ["cell", "node"])
    blocks = settle(_block_rows(cells, block, kind), "grid-blocks")
    payload = blocks.select("block", "n", "ids", "weights", "vectors")
    left = payload.select([F.col(c).alias(f"a_{c}") for c in payload.columns])
    right = payload.select([F.col(c).alias(f"b_{c}") for c in payload.columns])
    pairs = settle(_pairs(blocks, eps), "grid-pairs").repartition("a", "b")
    met = pairs.join(left, F.expr("a = a_block")).join(right, F.expr("b = b_block")) \
        .repartition("a", "b").drop("a_block", "b_block")

    def read(row: dict, side: str):
        ids = np.frombuffer(row[f"{side}_ids"], np.int64)
        v = np.frombuffer(row[f"{side}_vectors"], kind).astype(np.float64)
        v = v.reshape(len(ids), -1)
        u = _unit(np.pad(v, ((0, 0), (0, max(0, width - v.shape[1])))))
        return ids, (u, u @ axes, np.frombuffer(row[f"{side}_weights"], np.int64))

    def compare(batch: pa.RecordBatch):
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
            ids, a = read(row, "a")
            joiner = Joiner(a, None, limit, leaf)
            if row["a"] != row["b"]:
                more, b = read(row, "b")
                ids, joiner = np.concatenate((ids, more)), Joiner(a, b, limit, leaf)
            joiner.join(0, joiner.na, 0, joiner.nb)
            node, root = joiner.forest()
            other = np.full(len(ids), -1)
            other[node] = root
            on = np.flatnonzero(joiner.links)
            yield [ids[on], joiner.links[on],
                   pa.array(ids[other[on]], pa.int64(), mask=other[on] < 0)]

    return map_arrow(met, compare, "node long, links long, other long")


def link_vectors(vectors: DataFrame, limit: float = 0.95, key: str = "vec_id",
                 vector: str = "embedding", dims: int = DIMS, block: int = BLOCK,
                 leaf: int = LEAF) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept.

    ``n_links``: other rows whose cosine is at least ``limit``; ``component_id``: the least
    key reachable by links, its own included. Null, empty and zero vectors and those with null
    or non-finite components link with nothing. Repeated rows are vectors of their own. Rows
    without a key link with nothing and are kept. Shorter vectors count as filled with zeros.
    """
    if not 0 < limit <= 1:
        raise ValueError("the limit is a cosine above zero")
    base = vectors.select(vectors[key].cast("long").alias("key"), vectors[vector].alias("v"))
    fine = (F.col("key").isNotNull() & F.col("v").isNotNull()
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    valid = base.where(F.coalesce(fine, F.lit(False)))
    nodes = settle(valid.groupBy("v").agg(F.min("key").alias("node"),
                                          F.count("*").alias("weight")), "grid-nodes")
    found = settle(near_links(nodes, limit, dims, block, leaf), "grid-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL")
                       .select(F.col("node").alias("a"), F.col("other").alias("b")), "grid")
    of = settle(nodes.join(counts, "node", "left")
                .join(roots.withColumnRenamed("node", "r"), F.expr("node = r"), "left")
                .select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
                        F.coalesce("root", "node").alias("root")), "grid-of")
    # Vectors that link with nothing keep their row: their v matches no node.
    joined = base.withColumn("w", F.when(F.coalesce(fine, F.lit(False)), F.col("v"))) \
        .join(of.withColumnRenamed("v", "u"), F.expr("w = u"), "left")
    component = F.coalesce("root", "key")
    return joined.select(F.col("key").alias(key), F.coalesce("links", F.lit(0)).alias("n_links"),
                         component.alias("component_id"),
                         F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"))
