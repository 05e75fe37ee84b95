"""Exact nearest vectors by inner product, with vector-approximation files.

Candidates lie in blocks. A block holds two parts: cells (one byte per component, the number
of its quantile interval) and exact vectors. A query block scans the cells for an upper bound
of each inner product, then reads exact vectors in the order of their bounds until its kth
result is certain. Every pair of a query block and a candidate block is one row of a grid,
dealt out by both numbers, so neither side is collected or broadcast; the best of each grid
row (k per query at most) are merged by a partial aggregate.

Components are turned into floor(scale * x), 64-bit whole numbers; bounds are computed in
double precision and are widened by more than its rounding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from assayframe.operators.ranking import number_rows
from assayframe.session import settle

from .text import map_arrow
from .vectors import matrix_of

#: Candidates and queries of one block.
BLOCK, QUERIES = 4096, 512
#: Intervals per component.
CELLS = 16


def quantise(v: np.ndarray, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, low, high): each component's interval number, and the least and greatest value
    that lies in each interval (rows: intervals; columns: components)."""
    dims = v.shape[1]
    code = np.zeros(v.shape, np.uint8)
    low, high = np.zeros((cells, dims)), np.zeros((cells, dims))
    for d in range(dims):
        cuts = np.unique(np.quantile(v[:, d], np.linspace(0, 1, cells + 1)[1:-1]))
        code[:, d] = np.searchsorted(cuts, v[:, d], "right")
        for c in np.unique(code[:, d]):
            inside = v[code[:, d] == c, d]
            low[c, d], high[c, d] = inside.min(), inside.max()
    return code, low, high


def search(query_ids, queries, ids, vectors, code, low, high, k: int):
    """(query row, vector row, score): the k best rows of a block for each query, ties to the
    smaller id; the query's own row is left out."""
    width = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    if vectors.shape[1] < width:
        extra = width - vectors.shape[1]
        vectors = np.pad(vectors, ((0, 0), (0, extra)))
        code, low, high = (np.pad(x, ((0, 0), (0, extra))) for x in (code, low, high))
    dims = np.arange(width)
    up, down = high[code, dims], low[code, dims]
    q = queries.astype(np.float64)
    bound = np.maximum(q, 0) @ up.T + np.minimum(q, 0) @ down.T
    bound += 1 + 1e-9 * (np.abs(q) @ np.maximum(np.abs(up), np.abs(down)).T)
    out = []
    for i in range(len(q)):
        best: list[tuple[int, int, int]] = []
        order = np.argsort(-bound[i], kind="stable")
        step, at = 4 * k, 0
        while at < len(order):
            rows = order[at:at + step]
            if len(best) == k and bound[i, rows[0]] < -best[-1][0]:
                break
            exact = vectors[rows] @ queries[i]
            best += [(-int(s), int(ids[r]), int(r)) for s, r in zip(exact, rows, strict=True)
                     if ids[r] != query_ids[i]]
            best = sorted(best)[:k]
            at, step = at + step, step * 2
        out += [(i, r, -s) for s, _, r in best]
    return out


def _blocks(vectors: DataFrame, key: str, vector: str, scale: int, size: int,
            cells: int) -> DataFrame:
    """(block, n, width, ids, exact, cells, low, high) per block of at most ``size`` rows."""
    schema = ("n long, width long, ids binary, exact binary, cells binary, low binary, "
              "high binary")

    def run(batch: pa.RecordBatch):
        good, v = matrix_of(batch.column(1))
        keys = batch.column(0).to_numpy()
        for i in range(0, len(good), size):
            whole = np.floor(scale * v[i:i + size])
            most = np.abs(whole).max(initial=0)
            if most >= 2.0 ** 53 or most * most * whole.shape[1] >= 2.0 ** 62:
                raise OverflowError("inner products of such components leave 64 bits")
            exact = whole.astype(np.int64)
            code, low, high = quantise(whole, cells)
            ids = keys[good[i:i + size]]
            yield [[len(exact)], [exact.shape[1]], [ids.tobytes()], [exact.tobytes()],
                   [code.tobytes()], [low.tobytes()], [high.tobytes()]]

    rows = map_arrow(vectors.select(vectors[key].cast("long").alias("key"),
                                    vectors[vector].alias("vector"))
                     .where("key IS NOT NULL"), run, schema)
    return rows.withColumn("block", F.monotonically_increasing_id())


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id",
          vector: str = "embedding", scale: int = 256, block: int = BLOCK,
          query_block: int = QUERIES, cells: int = CELLS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the ``k`` rows of
    ``vectors`` with the highest integer inner product, its own key left out.

    All if there are fewer; ties go to the smaller key. Null or empty vectors, those with null
    or non-finite components and rows without key take no part. Repeated rows stay apart, so
    a repeated query has its results once per repeat (by rank of the whole) -- keys are meant
    to be unique. Components whose inner products could leave 64 bits raise OverflowError.
    """
    data = settle(_blocks(vectors, key, vector, scale, block, cells), "va-blocks")
    asked = number_rows(_blocks(queries, key, vector, scale, query_block, cells)
                        .select("block", F.col("n").alias("qn"), F.col("width").alias("qw"),
                                F.col("ids").alias("qids"), F.col("exact").alias("qexact")),
                        [], ["block"], "q").drop("block")
    # Every block meets every query block: the grid holds numbers, payloads are joined to it.
    grid = data.select("block", F.explode(F.sequence(F.lit(1), F.lit(max(1, asked.count()))))
                       .alias("q")).repartition("block", "q")
    pairs = grid.join(data, "block").join(asked, "q").repartition("block", "q")

    def run(batch: pa.RecordBatch):
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            v = np.frombuffer(row["exact"], np.int64).reshape(row["n"], row["width"])
            code = np.frombuffer(row["cells"], np.uint8).reshape(v.shape)
            low = np.frombuffer(row["low"]).reshape(cells, row["width"])
            high = np.frombuffer(row["high"]).reshape(cells, row["width"])
            qids = np.frombuffer(row["qids"], np.int64)
            q = np.frombuffer(row["qexact"], np.int64).reshape(row["qn"], row["qw"])
            found = search(qids, q, ids, v, code, low, high, k)
            if found:
                i, r, s = map(np.array, zip(*found, strict=True))
                yield [qids[i], ids[r], s]

    best = map_arrow(pairs, run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
