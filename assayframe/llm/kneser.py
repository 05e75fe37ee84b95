"""An interpolated modified Kneser-Ney model of word pairs, counted in Spark and looked up by
workers in memory-mapped sorted hash arrays.

Counting. Tasks count distinct pairs of a few million tokens at a time and send them on by
ranges of the pair's hash, packed; each range is merged by one task, which writes a sorted
array of hashes and one of counts to the shared folder and sends its sums per word on by
ranges of the word's hash; these are merged and written the same way. A pair or word of any
frequency is one record per task and batch, so none is hot, and ranges are of a bounded size.
Files are renamed when complete: a task that runs again writes the same file.

Scoring is one narrow pass over the texts. A worker maps the files, sorts the hashes of a
slice and searches each range in order; mapped pages are shared and are not its own memory.

A text's tokens are its words and one end; the word before the first is the begin mark. Word
hashes have 64 bits: among a thousand million distinct words any two agree with a chance of some
3 in 100. Chen and Goodman's three discounts are estimated from counts of counts;
the lower order is smoothed the same way and interpolated with a uniform share for each of
the V known tokens and one unknown.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayframe.session import fresh_path, settle

from .fitting import remainder
from .text import Words, map_arrow, mix, slices

#: Bytes of training text per range of pairs; tokens counted at once; bytes scored at once.
RANGE_BYTES, BATCH_TOKENS, SCORE_BYTES = 16 << 20, 2_000_000, 4_000_000
_BEGIN, _END = np.uint64(1), np.uint64(2)
_WORD = np.dtype([("count", "i8"), ("followed", "i8"), ("cont", "u4"), ("one", "u4"),
                  ("two", "u4"), ("more", "u4")])
_FACTOR = np.uint64(0xA24BAED4963EE407)


def tokens_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, first): word hashes with a begin mark before and an end after each text's
    words, and where each text's begin."""
    words = Words(data, at)
    hashes = words.hashes(lower=True)
    n = len(at) - 1
    first = words.first + 2 * np.arange(n + 1)
    out = np.empty(first[-1], np.uint64)
    out[first[:-1]] = _BEGIN
    out[first[1:] - 1] = _END
    out[np.arange(len(hashes)) + 2 * words.doc + 1] = hashes
    return out, first


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(before * _FACTOR) + word)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of numbers by byte planes, compressed."""
    raw = b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes()
                   for c in columns)
    return len(columns[0]).to_bytes(8, "little") + len(raw).to_bytes(8, "little") \
        + pa.compress(raw, "zstd", asbytes=True)


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n, size = (int.from_bytes(blob[i:i + 8], "little") for i in (0, 8))
    raw = np.frombuffer(pa.decompress(blob[16:], size, "zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for kind in map(np.dtype, kinds):
        planes = raw[at:at + n * kind.itemsize].reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += n * kind.itemsize
    return out


def _merge(key: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct keys, the row of each, and the sums of each value."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
    sums = [np.add.reduceat(v[order], head) if len(head) else v for v in values]
    return [key[head], order[head], *sums]


def _route(key: np.ndarray, bits: int, ranges: int) -> np.ndarray:
    """Borders of the ranges in sorted keys of ``bits`` bits."""
    width = -(-(1 << bits) // ranges)
    return np.searchsorted(key, np.array([min(i * width, (1 << bits) - 1)
                                          for i in range(1, ranges)], np.uint64))


def _cuts(key, bits, ranges):
    return zip(range(ranges), np.concatenate(([0], _route(key, bits, ranges))),
               np.concatenate((_route(key, bits, ranges), [len(key)])), strict=True)


def _write(path: str, array: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    array.tofile(part)
    os.replace(part, path)


def mounted(path: str) -> str:
    """A path that can be memory-mapped on every machine."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError("the model is memory-mapped: spark.checkpoint.dir has to be a mounted "
                         "folder (file:...) that all machines share")
    return path


def _count_pairs(docs: DataFrame, ranges: int) -> DataFrame:
    """(part, blob): distinct pairs of tokens with their counts, by range of their hash."""

    def run(batches):
        pairs, held = [], 0

        def flush():
            a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
            key, row, count = _merge(pair_keys(a, b), np.ones(len(a), np.int64))
            a, b = a[row], b[row]
            for part, i, j in _cuts(key, 64, ranges):
                if j > i:
                    o = np.argsort(a[i:j], kind="stable") + i
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()),
                         pa.array([_pack(a[o], b[o], count[o].astype(np.uint32))], pa.binary())],
                        names=["part", "blob"])

        for batch in batches:
            for _, data, at in slices(batch.column(0)):
                tokens, first = tokens_of(data, at)
                keep = np.ones(len(tokens), bool)
                keep[first[:-1]] = False
                place = np.flatnonzero(keep)
                pairs.append((tokens[place - 1], tokens[place]))
                held += len(place)
                if held >= BATCH_TOKENS:
                    yield from flush()
                    pairs, held = [], 0
        if held:
            yield from flush()

    return docs.select("text").mapInArrow(run, "part int, blob binary")


def _store_pairs(packed: DataFrame, folder: str, ranges: int) -> DataFrame:
    """Writes each range's pairs; returns (kind, part, blob): sums per word (kind 0) by range
    of the word, and the range's counts of counts (kind 1)."""

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        parts = [_unpack(b.as_py(), "u8", "u8", "u4") for b in table["blob"]]
        a, b, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        key, row, count = _merge(pair_keys(a, b), count.astype(np.int64))
        a, b = a[row], b[row]
        _write(f"{folder}/pair-{part}.key", key)
        _write(f"{folder}/pair-{part}.count", count)
        zero = np.zeros(len(a), np.int64)
        word, _, *sums = _merge(np.concatenate((a, b)), *(np.concatenate(x) for x in (
            (count, zero), ((count == 1) * 1, zero), ((count == 2) * 1, zero),
            ((count > 2) * 1, zero), (zero, count), (zero, zero + 1))))
        kinds, numbers, blobs = [], [], []
        for p, i, j in _cuts(word, 64, ranges):
            if j > i:
                kinds.append(0), numbers.append(p)
                blobs.append(_pack(word[i:j], *[s[i:j] for s in sums]))
        kinds.append(1), numbers.append(0)
        blobs.append(np.bincount(np.minimum(count, 5), minlength=6).astype(np.int64).tobytes())
        return pa.table({"kind": pa.array(kinds, pa.int32()),
                         "part": pa.array(numbers, pa.int32()),
                         "blob": pa.array(blobs, pa.binary())})

    return packed.groupBy("part").applyInArrow(run, "kind int, part int, blob binary")


def _store_words(sums: DataFrame, folder: str) -> DataFrame:
    """Writes each range's words; returns one row of counts per range."""
    names = ["tokens", "known", *[f"m{i}" for i in range(1, 6)]]

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        parts = [_unpack(b.as_py(), "u8", *["i8"] * 6) for b in table["blob"]]
        key, _, followed, one, two, more, count, cont = _merge(
            *(np.concatenate(x) for x in zip(*parts, strict=True)))
        rows = np.zeros(len(key), _WORD)
        for name, v in (("count", count), ("followed", followed), ("cont", cont), ("one", one),
                        ("two", two), ("more", more)):
            rows[name] = v
        _write(f"{folder}/word-{part}.key", key)
        _write(f"{folder}/word-{part}.row", rows)
        m = np.bincount(np.minimum(cont, 5), minlength=6)
        return pa.table({n: pa.array([int(x)], pa.int64()) for n, x in
                         zip(names, [count.sum(), (count > 0).sum(), *m[1:]], strict=True)})

    return sums.groupBy("part").applyInArrow(run, ", ".join(f"{n} long" for n in names))


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more, from the counts of counts. Where too few counts
    are there to estimate one it is half of the count."""
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2 * n2)
        out[1] = 1 - 2 * y * n2 / n1
        if n3:
            out[2] = 2 - 3 * y * n3 / n2
            if n4:
                out[3] = 3 - 4 * y * n4 / n3
    return np.clip(out, 0, [0, 1, 2, 3])


class Model:
    """The files of a model, mapped when first used, and its constants."""

    def __init__(self, folder: str, ranges: int, tokens: int, known: int, pairs, conts):
        self.folder, self.ranges = folder, ranges
        self.tokens, self.known = tokens, known
        self.pairs = int(sum(pairs))
        self.high, self.low = discounts(*pairs[:4]), discounts(*conts[:4])
        rest = [conts[0], conts[1], sum(conts[2:])]
        self.uniform = 1 / (known + 1)
        if self.pairs:
            self.uniform *= float(self.low[1:] @ rest) / self.pairs
        self._maps: dict[str, np.ndarray | None] = {}

    def __getstate__(self):
        return {**self.__dict__, "_maps": {}}

    def _map(self, name: str, kind) -> np.ndarray | None:
        if name not in self._maps:
            path = f"{self.folder}/{name}"
            there = os.path.exists(path) and os.path.getsize(path) > 0
            self._maps[name] = np.memmap(path, kind, "r") if there else None
        return self._maps[name]

    def _find(self, kind: str, bits: int, sorted_keys: np.ndarray, tail: str, dtype):
        out = np.zeros(len(sorted_keys), dtype)
        for part, i, j in _cuts(sorted_keys, bits, self.ranges):
            keys = self._map(f"{kind}-{part}.key", np.uint64) if j > i else None
            if keys is None:
                continue
            at = np.minimum(np.searchsorted(keys, sorted_keys[i:j]), len(keys) - 1)
            hit = keys[at] == sorted_keys[i:j]
            out[i:j][hit] = self._map(f"{kind}-{part}.{tail}", dtype)[at[hit]]
        return out

    def words(self, hashes: np.ndarray) -> np.ndarray:
        keys, back = np.unique(hashes, return_inverse=True)
        return self._find("word", 64, keys, "row", _WORD)[back]

    def counts(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        keys, back = np.unique(pair_keys(before, word), return_inverse=True)
        return self._find("pair", 64, keys, "count", np.int64)[back]

    def score(self, data: np.ndarray, at: np.ndarray):
        """(n_tokens, n_known, base, log10 probability) of each text of a slice."""
        tokens, first = tokens_of(data, at)
        rows = self.words(tokens)
        n = len(at) - 1
        doc = np.repeat(np.arange(n), np.diff(first))
        keep = np.ones(len(tokens), bool)
        keep[first[:-1]] = False
        place, doc = np.flatnonzero(keep), doc[keep]
        here, last = rows[place], rows[place - 1]
        base = np.log10((here["count"] + 0.5) / (self.tokens + 0.5 * (self.known + 1)))
        cont = here["cont"].astype(np.float64)
        p = (cont - self.low[np.minimum(here["cont"], 3)]) / max(1, self.pairs) + self.uniform
        joint = self.counts(tokens[place - 1], tokens[place])
        total = last["followed"]
        safe = np.maximum(total, 1)
        left = (self.high[1] * last["one"] + self.high[2] * last["two"]
                + self.high[3] * last["more"]) / safe
        seen = (joint - self.high[np.minimum(joint, 3)]) / safe
        p = np.where(total > 0, seen + left * p, p)
        return (np.diff(first) - 1, np.bincount(doc, here["count"] > 0, n).astype(np.int64),
                np.bincount(doc, base, n), np.bincount(doc, np.log10(p), n))


def train(docs: DataFrame, text: str = "text", range_bytes: int = RANGE_BYTES) -> Model:
    """Counts every row of ``docs`` (null texts are empty) and writes the model's files."""
    spark = docs.sparkSession
    plain = docs.select(F.coalesce(docs[text], F.lit("")).alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // range_bytes))
    folder = mounted(fresh_path(spark, "pair-model"))
    os.makedirs(folder, exist_ok=True)
    sums = settle(_store_pairs(_count_pairs(plain, ranges), folder, ranges), "pair-sums")
    pairs = np.zeros(6, np.int64)
    for row in sums.where("kind = 1").select("blob").toLocalIterator():  # one row per range
        pairs += np.frombuffer(row[0], np.int64)
    total = settle(_store_words(sums.where("kind = 0"), folder), "word-sums").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
          for c in ("tokens", "known", "m1", "m2", "m3", "m4", "m5")]).first()
    return Model(folder, ranges, total["tokens"], total["known"], pairs[1:].tolist(),
                 [total[f"m{i}"] for i in range(1, 6)])


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", modulus: int = 5,
          held: int = 1, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text).

    Learns from all rows whose crc32(key) modulo ``modulus`` isn't ``held``; a null key counts
    as remainder 0. A null or empty text has its end as its only token. Without any training
    text every token has probability one (V = 0 leaves the unknown token alone).
    """
    model = train(docs.where(remainder(key, modulus) != held), text, range_bytes)

    def run(batch: pa.RecordBatch):
        for row, data, at in slices(batch.column(2), SCORE_BYTES):
            n, known, base, log = model.score(data, at)
            part = slice(row, row + len(at) - 1)
            yield [batch.column(0)[part], batch.column(1)[part], n, known,
                   np.full(len(n), model.tokens), base, log]

    return map_arrow(docs.select(docs[key].cast("long").alias(key),
                                 (remainder(key, modulus) == held).alias("held_out"),
                                 docs[text].alias("text")), run,
                     f"{key} long, held_out boolean, n_tokens long, n_known long, "
                     "train_tokens long, base_score double, score double")
