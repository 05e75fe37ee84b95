"""Plain statements of what the operators return, over small lists."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def lower(text):
    return [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words(text)]


def components(n, near):
    """Component of each of n nodes: its least node."""
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in near:
            low = min(label[i], label[j])
            if label[i] != low or label[j] != low:
                label[i] = label[j] = low
                changed = True
    return label


def fingerprint(text):
    w = lower(text)
    if not w:
        return 0
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def removed_bytes(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def removed_words(texts, window):
    """Texts in the order of their keys."""
    seen, out = set(), []
    for t in texts:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            now = tuple(w[i:i + window])
            if now in seen:
                gone[i:i + window] = [True] * window
            seen.add(now)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


class KneserNey:
    def __init__(self, texts):
        runs = [lower(t) + [None] for t in texts]
        self.count = Counter(w for r in runs for w in r)
        self.total, self.known = sum(self.count.values()), len(self.count)
        self.pair = Counter(p for r in runs for p in zip(["begin", *r], r))
        self.cont = Counter(b for _, b in self.pair)
        self.after = defaultdict(lambda: [0, 0, 0, 0])
        for (a, _), n in self.pair.items():
            self.after[a][0] += n
            self.after[a][min(n, 3)] += 1
        self.high, self.low = self.discounts(self.pair), self.discounts(self.cont)
        kinds = Counter(min(v, 3) for v in self.cont.values())
        self.uniform = 1 / (self.known + 1)
        if self.pair:
            self.uniform *= sum(self.low[i] * kinds[i] for i in (1, 2, 3)) / len(self.pair)

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        out = [0, 0.5, 1.0, 1.5]
        if n[1] and n[2]:
            y = n[1] / (n[1] + 2 * n[2])
            out[1] = 1 - 2 * y * n[2] / n[1]
            if n[3]:
                out[2] = 2 - 3 * y * n[3] / n[2]
                if n[4]:
                    out[3] = 3 - 4 * y * n[4] / n[3]
        return [min(max(d, 0), i) for i, d in enumerate(out)]

    def one(self, w):
        k = self.cont[w]
        return (k - self.low[min(k, 3)]) / max(1, len(self.pair)) + self.uniform

    def prob(self, a, b):
        if a not in self.after:
            return self.one(b)
        total, *n = self.after[a]
        k = self.pair[(a, b)]
        return (k - self.high[min(k, 3)]) / total \
            + sum(self.high[i + 1] * n[i] for i in range(3)) / total * self.one(b)

    def score(self, text):
        run = lower(text) + [None]
        base = sum(math.log10((self.count[w] + 0.5) / (self.total + 0.5 * (self.known + 1)))
                   for w in run)
        log = sum(math.log10(self.prob(a, b)) for a, b in zip(["begin", *run], run))
        return len(run), sum(self.count[w] > 0 for w in run), self.total, base, log


def nearest(ids, vectors, k):
    whole = [[math.floor(256 * float(x)) for x in v] for v in vectors]
    out = []
    for q, a in zip(ids, whole):
        if q % 50:
            continue
        found = sorted((-sum(x * y for x, y in zip(a, b)), i)
                       for i, b in zip(ids, whole) if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def links(vectors, limit):
    """(links per vector, component) with None for vectors that take no part."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
            and any(v) for v in vectors]
    near = [(i, j) for i in range(len(vectors)) for j in range(i)
            if good[i] and good[j] and np.dot(vectors[i], vectors[j]) >= limit * math.sqrt(
                np.dot(vectors[i], vectors[i]) * np.dot(vectors[j], vectors[j]))]
    count = Counter(x for p in near for x in p)
    return [count[i] for i in range(len(vectors))], components(len(vectors), near)


def best_fit(pieces, capacity):
    bins, out = [], []
    for size, source, cluster in pieces:
        fits = [(room, b) for b, (room, s, c) in enumerate(bins)
                if room >= size and (source is None or source not in s)
                and (cluster is None or cluster not in c)]
        if fits:
            b = min(fits)[1]
        else:
            bins.append([capacity, set(), set()])
            b = len(bins) - 1
        bins[b][0] -= size
        bins[b][1].add(source)
        bins[b][2].add(cluster)
        out.append(b)
    return out
