"""A quality classifier: support vectors on n-gram indicators scaled by naive Bayes.

Indicators are hashed n-grams of words and of word shapes (letter case, digits, marks at the
end, length, whether the word repeats the one before). Shape n-grams also come with the share
of the text they make up, in powers of four, so that long texts don't all look alike. Each
indicator is scaled by the log ratio of its class counts (Wang and Manning, 2012); a linear
hinge-loss model is fitted to them by dual coordinate descent (Hsieh et al., 2008), and its
margin is turned into a probability by a logistic curve fitted on rows set apart.

Features are made by tasks, in one pass over the sample and one over all texts. The driver holds
the sample's indicators as 32-bit numbers, ``ENTRIES`` at most, and values of one row at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayframe.session import bound_batches, settle

from .fitting import NAMES, SCORED_BYTES, add_score, labelled_sample, remainder
from .text import Words, gram_hashes, map_arrow, mix, slices

#: Buckets of hashed indicators; labelled rows of each class that the model is fitted on, and
#: indicators of a class's rows together (4 bytes each on the driver).
BUCKETS, PER_CLASS, ENTRIES = 1 << 18, 6000, 16_000_000
#: Bound of a row's weight in the dual, passes over the rows at most.
COST, ROUNDS = 1.0, 30
_LEVELS = 6
_UPPER, _LETTER, _DIGIT = (np.zeros(257, np.int64) for _ in range(3))
_UPPER[65:91] = 1
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:256] = 1
_DIGIT[48:58] = 1


def _shapes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """A small number per word that tells its shape."""
    data, start, end = words.data, words.start, words.end

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags[data])))
        return total[end] - total[start]

    size = end - start
    letters, upper, digits = count(_LETTER), count(_UPPER), count(_DIGIT)
    last = data[end - 1].astype(np.int64)
    before = data[np.maximum(end - 2, start)].astype(np.int64)
    mark = np.where(_LETTER[last] + _DIGIT[last] > 0, 0, last)
    twice = (mark > 0) & (before == last) & (size > 1)
    same = np.zeros(len(size), np.int64)
    same[1:] = (hashes[1:] == hashes[:-1]) & (words.doc[1:] == words.doc[:-1])
    case = np.where(upper == 0, 0, np.where(upper == 1, 1, np.where(2 * upper > letters, 3, 2)))
    line = np.zeros(len(size), np.int64)
    line[1:] = data[start[1:] - 1] == 10
    parts = (case, np.minimum(digits, 3), mark, twice, same, line,
             np.minimum(np.log2(size + 1).astype(np.int64), 5), letters == 0)
    code = np.zeros(len(size), np.uint64)
    for p in parts:
        code = code * np.uint64(131) + p.astype(np.uint64)
    return mix(code)


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each indicator of the texts of a slice, ordered, without repeats."""
    words = Words(data, at)
    doc, hashes = words.doc, words.hashes(lower=True)
    n_words = np.diff(words.first)
    shape = _shapes(words, hashes) if len(hashes) else hashes
    rows, buckets = [], []

    def put(d, h):
        rows.append(d)
        buckets.append((mix(h) >> np.uint64(40)).astype(np.int64) % BUCKETS)

    for n, values, salt in ((1, hashes, 11), (2, hashes, 12), (1, shape, 21), (2, shape, 22),
                            (3, shape, 23)):
        grams = gram_hashes(values, n) + np.uint64(salt)
        inside = doc[:len(grams)] == doc[n - 1:] if len(grams) else np.zeros(0, bool)
        d, h = doc[:len(grams)][inside], grams[inside]
        if values is hashes:
            put(d, h)
            continue
        key, count = np.unique(d.astype(np.uint64) << np.uint64(44) | h >> np.uint64(20),
                               return_counts=True)
        d, h = (key >> np.uint64(44)).astype(np.int64), key << np.uint64(20)
        level = np.minimum(np.log2(n_words[d] / count) / 2, _LEVELS - 1).astype(np.uint64)
        put(d, h + np.uint64(salt))
        put(d, h + np.uint64(salt * 1000) + level)
    size = np.log2(n_words + 1).astype(np.uint64)
    put(np.arange(len(n_words)), size + np.uint64(77))
    key = np.unique(np.concatenate(rows) * BUCKETS + np.concatenate(buckets))
    return key // BUCKETS, key % BUCKETS


class Sample:
    """Labelled rows: row ``i`` has the indicators index[at[i]:at[i + 1]] and label[i]."""

    def __init__(self, at: np.ndarray, index: np.ndarray, label: np.ndarray):
        self.at, self.index, self.label = at, index, label

    def row(self, i: int) -> np.ndarray:
        return self.index[self.at[i]:self.at[i + 1]]

    def ratios(self, rows: np.ndarray) -> np.ndarray:
        """log of (count in class 1 + 1, normalised) over (count in class 0 + 1, normalised),
        over some rows, block by block."""
        count = np.ones((2, BUCKETS), np.int64)
        for c in (0, 1):
            mine = rows[self.label[rows] == c]
            for k in range(0, len(mine), 200):
                count[c] += np.bincount(np.concatenate([self.row(i) for i in mine[k:k + 200]]),
                                        minlength=BUCKETS)
        return np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())

    def norms(self, ratio: np.ndarray, rows: np.ndarray) -> np.ndarray:
        square = ratio ** 2
        return np.sqrt(np.maximum([square[self.row(i)].sum() for i in rows], 1e-12))


def fit_hinge(sample: Sample, rows: np.ndarray, ratio: np.ndarray, cost: float = COST,
              rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(weights, dual weights) that minimise half the squared length of the weights plus
    ``cost`` times the hinge losses of ``rows``, by dual coordinate descent in random order.

    A row's values are its ratios over their length, made when its turn comes."""
    weight, alpha = np.zeros(BUCKETS), np.zeros(len(rows))
    norm = sample.norms(ratio, rows)
    sign = np.where(sample.label[rows] == 1, 1.0, -1.0)
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            here = sample.row(rows[k])
            value = ratio[here] / norm[k]
            size = value @ value
            if size == 0:
                continue
            gradient = sign[k] * (value @ weight[here]) - 1
            new = min(max(alpha[k] - gradient / size, 0.0), cost)
            if new != alpha[k]:
                weight[here] += (new - alpha[k]) * sign[k] * value
                moved = max(moved, abs(new - alpha[k]))
                alpha[k] = new
        if moved < 1e-3 * cost:
            break
    return weight, alpha


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the curve that fits the labels best, by Newton's steps, with the
    smoothed targets of Platt (1999)."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)) @ x.T + 1e-3 * np.eye(2),
                               x @ (p - target))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def read_sample(sample: DataFrame, entries: int = ENTRIES) -> Sample:
    """The indicators of (key, text, label), rows in order of a hash of their key: of each class
    the first rows that hold up to ``entries`` indicators together."""

    def run(batch: pa.RecordBatch):
        for row, data, at in slices(batch.column(1), SCORED_BYTES):
            doc, bucket = features(data, at)
            first = np.searchsorted(doc, np.arange(len(at)))
            part = slice(row, row + len(at) - 1)
            yield [batch.column(0)[part], batch.column(2)[part], np.diff(first),
                   [bucket[i:j].astype(np.int32).tobytes()
                    for i, j in zip(first[:-1], first[1:], strict=True)]]

    found = settle(map_arrow(sample, run, "key long, label int, size long, entries binary"),
                   "entries")
    rank = F.xxhash64(F.col("key").cast("string"))
    table = found.select("key", "label", "size", rank.alias("rank")).toArrow() \
        .sort_by([("rank", "ascending"), ("key", "ascending")])
    key, label, size = (table[c].to_numpy() for c in ("key", "label", "size"))
    kept = np.zeros(len(key), bool)
    for c in (0, 1):
        mine = np.flatnonzero(label == c)
        kept[mine[np.cumsum(size[mine]) <= entries]] = True
    key, label, size = key[kept], label[kept].astype(np.int8), size[kept]
    at = np.concatenate(([0], np.cumsum(size)))
    index = np.empty(at[-1], np.int32)
    place = {k: i for i, k in enumerate(key.tolist())}
    # One partition at a time, straight into place.
    for r in found.select("key", "entries").toLocalIterator():
        i = place.get(r["key"])
        if i is not None:
            index[at[i]:at[i + 1]] = np.frombuffer(r["entries"], np.int32)
    return Sample(at, index, label)


def train(sample: DataFrame) -> tuple[np.ndarray, float, float]:
    """(weights with the ratios multiplied in and squared ratios, slope, shift) from
    (key, text, label)."""
    held = read_sample(sample)
    if len(set(held.label.tolist())) < 2:
        return np.zeros((2, BUCKETS), np.float32), 1.0, 30.0 if held.label.any() else 0.0
    rows = np.random.default_rng(5).permutation(len(held.label))
    apart, rest = rows[::5], rows[np.arange(len(rows)) % 5 > 0]
    ratio = held.ratios(rest)
    weight = fit_hinge(held, rest, ratio)[0] * ratio
    norm = held.norms(ratio, apart)
    margin = np.array([weight[held.row(i)].sum() for i in apart]) / norm
    slope, shift = logistic(margin, held.label[apart].astype(np.int64))
    ratio = held.ratios(rows)
    weight = fit_hinge(held, rows, ratio)[0] * ratio
    return np.stack([weight, ratio ** 2]).astype(np.float32), slope, shift


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
             text: str = "text", modulus: int = 3, held: int = 1, per_class: int = PER_CLASS,
             threshold: float = 0.5, names: tuple[str, str, str] = NAMES) -> DataFrame:
    """Every row of ``docs`` with all its columns, held_out, score and predicted (``names``).

    Fitted on up to ``per_class`` labelled rows of each class (and ``ENTRIES`` indicators of
    theirs) whose crc32(key) modulo ``modulus`` isn't ``held``, the first by a hash of the key;
    scores read nothing but the text. Repeated rows score alike. Null and empty texts are
    scored from their length alone. Without labels of both classes every score is the same
    (0.5 without any). Columns of these names in ``docs`` are replaced.
    """
    bound_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, key, modulus, held, per_class, text)
    weight, slope, shift = train(sample)
    columns = [c for c in docs.columns if c not in names]
    base = docs.select(*[docs[c] for c in columns])

    def score(data: np.ndarray, at: np.ndarray) -> np.ndarray:
        rows, index = features(data, at)
        n = len(at) - 1
        total = np.bincount(rows, weight[0][index], n)
        norm = np.sqrt(np.maximum(np.bincount(rows, weight[1][index], n), 1e-12))
        return 1 / (1 + np.exp(-np.clip(slope * total / norm + shift, -30, 30)))

    scored = add_score(base, text, names[1], score)
    return scored.select(*columns, (remainder(key, modulus) == held).alias(names[0]), names[1],
                         (F.col(names[1]) >= threshold).cast("int").alias(names[2]))
