"""Quality rules with a robust test for texts that are unlike the rest of their group.

One narrow pass over whole texts counts what the plain rules ask for. Texts that pass those
become a vector of transformed statistics (``FEATURES``). For each language and source a
minimum-covariance-determinant estimate (Rousseeuw and Van Driessen, 1999) gives centre and
scatter of the ``SHARE`` of rows that lie closest together, and rows are rejected by their
Mahalanobis distance.

Spread and bounds. Rows of a group are merged, map side first, into cells of a fixed grid:
each holds its number of rows and their exact sums and products. A group of any size, a third
of all rows too, is then a table of at most ``CELLS`` cells, which one task takes. Trial
subsets and concentration steps choose whole cells by the distance of their mean (the last one
in part), so centre and scatter come from all rows, not from a sample; distances at the end are
those of the rows' own vectors. Estimates are one row per group, joined to the rows.

A group of fewer than ``LEAST`` usable rows takes the estimate of its language, and that of all
rows if its language has too few as well. Null groups are groups. A ``FLOOR`` per statistic is
added to the scatter, since most texts have no symbols or repeats at all and would make any
that has one an outlier.

Null and empty texts have no words and fail the plain rules, as do all short ones. Repeated
rows count each; ties at the border of a subset share its last places in proportion. An empty
table gives an empty result. A text of any length is one row of a task, at some 30 bytes a byte.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from assayframe.session import settle

from .text import Words, byte_hashes, gram_hashes, map_arrow, mix, slices

#: Plain rules: least words, most per cent of words in repeated windows, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Share of rows an estimate rests on, usable rows a group needs, tail of the final test.
SHARE, LEAST, TAIL = 0.75, 100, 1e-4
#: Per statistic: what it is, lowest and highest border of its cells, cells, and the standard
#: deviation that is added to its scatter.
FEATURES = (
    ("log2 of words", 4.0, 20.0, 16, 1.0),
    ("log2 of characters per word", 0.0, 5.0, 16, 0.25),
    ("log2 of 1 + symbols per 1,024 characters", 0.0, 10.0, 12, 1.0),
    ("log2 of 1 + repeated lines per 1,024 words", 0.0, 10.0, 12, 1.5),
    ("arcsine of the root of the share of words in repeated windows", 0.0, 1.2, 12, 0.15),
)
CELLS = math.prod(f[3] for f in FEATURES)
_D = len(FEATURES)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _repeated_words(words: Words, window: int) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in it."""
    doc = words.doc
    if len(doc) < window:
        return np.zeros(len(words.first) - 1, np.int64)
    grams = gram_hashes(words.hashes(), window)
    place = np.flatnonzero(doc[:len(grams)] == doc[window - 1:])
    key = mix(grams[place] + mix(doc[place].astype(np.uint64)))
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = place[count[back] > 1]
    step = np.zeros(len(doc) + 1, np.int32)
    np.add.at(step, twice, 1)
    np.add.at(step, twice + window, -1)
    return _per_text(np.cumsum(step)[:-1] > 0, words.first)


def _repeated_lines(words: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of it."""
    data, at = words.data, words.offsets
    full = np.flatnonzero(at[1:] > at[:-1])
    breaks = np.flatnonzero(data == 10)
    start = np.sort(np.concatenate((at[full], breaks + 1)))
    owner = np.searchsorted(at, start, "right") - 1
    end = np.append(start[1:], len(data))
    # A line ends before its break, or with its text; the last break of a text opens an empty one.
    end = np.minimum(end, at[np.minimum(owner + 1, len(at) - 1)])
    end = np.where((end > start) & (data[np.maximum(end - 1, 0)] == 10), end - 1, end) \
        if len(data) else end
    worded = np.searchsorted(words.start, start) < np.searchsorted(words.start, end)
    start, end, owner = start[worded], end[worded], owner[worded]
    key = mix(byte_hashes(data, start, end) + mix(owner.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    n = len(at) - 1
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)


def count_texts(data: np.ndarray, at: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """The columns ``_COUNTS`` of the texts of a slice."""
    words = Words(data, at)
    letters = (data & 0xC0) != 0x80
    letters &= ~((data == 32) | ((data >= 9) & (data <= 13)))
    return [np.diff(words.first), _per_text(letters, at), _per_text(_SYMBOL[data], at),
            _repeated_lines(words), _repeated_words(words, window)]


def statistics(docs: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without its text, with the counts of each text (columns ``_COUNTS``)."""
    passed = [c for c in docs.columns if c != text]
    base = docs.select(text, *passed)
    schema = base.drop(text)
    for name in _COUNTS:
        schema = schema.withColumn(name, F.lit(0).cast("long"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [count_texts(data, at, window) for _, data, at in slices(batch.column(0))]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] or \
            [np.zeros(0, np.int64)] * len(_COUNTS)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], *(pa.array(c, pa.int64()) for c in columns)],
            names=[*passed, *_COUNTS])

    return base.mapInArrow(lambda batches: map(run, batches), schema.schema)


def vector() -> list[Column]:
    """The transformed statistics of a row that has words."""
    words, chars, symbols, lines, repeated = (F.col(c) for c in _COUNTS)
    return [F.log2(words), F.log2(chars / words), F.log2(1 + 1024 * symbols / chars),
            F.log2(1 + 1024 * lines / words), F.asin(F.sqrt(repeated / words))]


def _cell(values: list[Column]) -> Column:
    out = F.lit(0)
    for v, (_, low, high, n, _) in zip(values, FEATURES, strict=True):
        level = F.floor((v - low) * (n / (high - low)))
        out = out * n + F.greatest(F.lit(0), F.least(F.lit(n - 1), level))
    return out.cast("int")


def chi2_share(x: float, degrees: int) -> float:
    """Share of a chi-squared variable below ``x``, by the series of the incomplete gamma."""
    a, z = degrees / 2, x / 2
    if z <= 0:
        return 0.0
    term = total = 1 / a
    for n in range(1, 1000):
        term *= z / (a + n)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total * math.exp(a * math.log(z) - z - math.lgamma(a)))


def chi2_border(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_share(middle, degrees) < share else (low, middle)
    return high


def _consistency(share: float) -> float:
    """Factor that makes the scatter of the inner ``share`` that of the whole, if normal."""
    return share / chi2_share(chi2_border(share, _D), _D + 2)


class Cells:
    """A group's cells: rows ``n``, their sums and products."""

    def __init__(self, n: np.ndarray, total: np.ndarray, product: np.ndarray):
        self.n, self.total, self.product = n, total, product
        self.mean = total / n[:, None]
        self.floor = np.diag([f[4] ** 2 for f in FEATURES])

    def scatter(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centre and covariance of all cells' rows, weighted by cell."""
        rows = weight @ self.n
        centre = weight @ self.total / rows
        return centre, (weight @ self.product).reshape(_D, _D) / rows - np.outer(centre, centre)

    def distance(self, centre: np.ndarray, cov: np.ndarray) -> np.ndarray:
        away = self.mean - centre
        return np.einsum("ij,ij->i", away @ np.linalg.inv(cov), away)

    def concentrate(self, centre: np.ndarray, cov: np.ndarray, keep: float):
        """One step: centre and covariance of the ``keep`` rows closest to the given ones."""
        order = np.argsort(self.distance(centre, cov), kind="stable")
        n = self.n[order]
        weight = np.empty(len(n))
        weight[order] = np.clip(keep - (np.cumsum(n) - n), 0, n) / n
        centre, raw = self.scatter(weight)
        return centre, raw, np.linalg.det(raw + self.floor)

    def estimate(self, share: float, starts: int = 24, seed: int = 17):
        """Centre and scatter of the subset of least determinant that is found."""
        keep = max(1.0, math.ceil(share * self.n.sum()))
        rng, tried = np.random.default_rng(seed), []
        draw = self.n / self.n.sum()
        for i in range(starts):
            if i == 0:
                centre, raw = self.scatter(np.ones(len(self.n)))
            else:
                chosen = self.mean[rng.choice(len(self.n), _D + 1, p=draw)]
                centre, raw = chosen.mean(0), np.cov(chosen.T, bias=True)
            for _ in range(2):
                centre, raw, det = self.concentrate(centre, raw + self.floor, keep)
            tried.append((det, i, centre, raw))
        best = None
        for det, i, centre, raw in sorted(tried, key=lambda t: t[:2])[:5]:
            for _ in range(100):
                last = det
                centre, raw, det = self.concentrate(centre, raw + self.floor, keep)
                if det >= last * (1 - 1e-9):
                    break
            if best is None or det < best[0]:
                best = det, centre, raw
        _, centre, raw = best
        # Rows within the 0.975 border of the raw estimate give the final one.
        inner = self.distance(centre, raw * _consistency(share) + self.floor)
        weight = (inner <= chi2_border(0.975, _D)).astype(float)
        if weight.any():
            centre, raw = self.scatter(weight)
            return centre, raw * _consistency(0.975) + self.floor
        return centre, raw * _consistency(share) + self.floor


_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]


def estimates(rows: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """(g0, g1, level, usable, centre, inverse): the estimate that each group of ``rows``
    (g0, g1, x0, x1, ...) takes; level 2 is its own, 1 its language's, 0 that of all."""
    x = [F.col(f"x{i}") for i in range(_D)]
    sums = [F.count("*").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)],
            *[F.sum(x[i] * x[j]).alias(f"p{i}{j}") for i, j in _PAIRS]]
    names = [*[f"s{i}" for i in range(_D)], *[f"p{i}{j}" for i, j in _PAIRS]]
    cells = settle(rows.groupBy("g0", "g1", _cell(x).alias("cell")).agg(*sums), "cells")
    level = F.explode(F.array(F.lit(2), F.lit(1), F.lit(0))).alias("level")
    k0, k1 = F.when(F.col("level") > 0, F.col("g0")), F.when(F.col("level") > 1, F.col("g1"))
    raised = cells.select("*", level).groupBy(
        "level", k0.alias("k0"), k1.alias("k1"), "cell").agg(
        F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("cell")
        value = {c: table[c].to_numpy().astype(np.float64) for c in ("n", *names)}
        product = np.empty((table.num_rows, _D, _D))
        for i, j in _PAIRS:
            product[:, i, j] = product[:, j, i] = value[f"p{i}{j}"]
        centre, cov = Cells(value["n"], np.stack([value[f"s{i}"] for i in range(_D)], 1),
                            product.reshape(-1, _D * _D)).estimate(share)
        head = table.select(["level", "k0", "k1"]).slice(0, 1)
        lists = pa.list_(pa.float64())
        return head.append_column("usable", pa.array([int(value["n"].sum())], pa.int64())) \
            .append_column("centre", pa.array([centre.tolist()], lists)) \
            .append_column("inverse", pa.array([np.linalg.inv(cov).ravel().tolist()], lists))

    kinds = {f.name: f.dataType.simpleString() for f in raised.schema.fields}
    found = raised.groupBy("level", "k0", "k1").applyInArrow(
        fit, f"level int, k0 {kinds['k0']}, k1 {kinds['k1']}, usable long, "
             "centre array<double>, inverse array<double>")
    groups = cells.select("g0", "g1").distinct().select("*", level.alias("at")) \
        .select("g0", "g1", "at", F.when(F.col("at") > 0, F.col("g0")).alias("a0"),
                F.when(F.col("at") > 1, F.col("g1")).alias("a1"))
    met = groups.join(found, (F.col("at") == F.col("level")) & F.col("a0").eqNullSafe(F.col("k0"))
                      & F.col("a1").eqNullSafe(F.col("k1"))) \
        .where((F.col("usable") >= least) | (F.col("level") == 0))
    best = met.groupBy("g0", "g1").agg(
        F.max(F.struct("level", "usable", "centre", "inverse")).alias("best"))
    return settle(best.select("g0", "g1", "best.*"), "estimates")


def check(docs: DataFrame, key: str = "doc_id", text: str = "text",
          group: tuple[str, str] = ("lang", "source"), keep: tuple[str, ...] = (),
          share: float = SHARE, least: int = LEAST, tail: float = TAIL) -> DataFrame:
    """One row per row of ``docs``: key, ``keep`` columns, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, level, distance, kept.

    ``base_failed``: fewer than ``LEAST_WORDS`` words, or more than ``MOST_REPEATED`` per cent of
    them in windows of ``WINDOW`` words that the text holds twice. ``distance`` is the squared
    Mahalanobis distance from the centre at ``level`` (null for rows that failed); ``kept`` rows
    did not fail and lie within all but ``tail`` of a chi-squared variable. Other columns of
    ``docs`` are not read, so their names can't clash.
    """
    chosen = docs.select(docs[key].alias("key"), docs[text].alias("text"),
                         *[docs[c].alias(f"g{i}") for i, c in enumerate(group)],
                         *[docs[c].alias(f"keep_{i}") for i, c in enumerate(keep)])
    failed = (F.col("n_words") < LEAST_WORDS) | \
        (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    counted = settle(statistics(chosen).withColumn("base_failed", failed), "statistics")
    usable = counted.where("NOT base_failed")
    fitted = estimates(usable.select("g0", "g1", *[v.alias(f"x{i}") for i, v in
                                                   enumerate(vector())]), share, least) \
        .withColumnsRenamed({"g0": "e0", "g1": "e1"})
    joined = counted.join(fitted, F.col("g0").eqNullSafe(F.col("e0"))
                          & F.col("g1").eqNullSafe(F.col("e1")), "left")
    away = [v - F.get("centre", F.lit(i)) for i, v in enumerate(vector())]
    total = sum((a * b * F.get("inverse", F.lit(i * _D + j))
                 for i, a in enumerate(away) for j, b in enumerate(away)), F.lit(0.0))
    out = joined.withColumn("distance", F.when(~F.col("base_failed"), total))
    kept = ~F.col("base_failed") & F.coalesce(
        F.col("distance") <= chi2_border(1 - tail, _D), F.lit(True))
    return out.select(F.col("key").alias(key),
                      *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)], *_COUNTS,
                      "base_failed", "level", "distance", kept.alias("kept"))
