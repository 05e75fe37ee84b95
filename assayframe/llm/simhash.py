"""SimHash fingerprints and their near neighbours by multi-index hashing.

A fingerprint's bit is set if more than half of a text's shingle hashes set it. Two
fingerprints within three bits have a half that differs in one bit at most, so the small
Hamming ball of each half (the half and its one-bit changes) is enumerated and looked up in
the tables of halves; complete distances are verified on what meets. Of two halves one bit
apart one has the bit set: clearing set bits on either side is enough.

Equal fingerprints are one node, so copies don't fill a bucket. Buckets of more than ``BUCKET``
nodes are split again by the other half's quarters (of at most three bits there, a quarter has one
at most). A split bucket holds values of the half that are its key or have one more bit set (33 at
most), of the quarter likewise (17), and any of the last quarter (65,536): 36.8 million nodes of 8
bytes at most, whatever the input. Buckets yield a spanning forest of their links, not their pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from assayframe.session import settle

from .components import components
from .text import map_arrow

BITS = 3
#: Nodes of a bucket that are compared at once; larger ones are split by further bits.
BUCKET = 1024
_SEED = 42


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text: A-Z in lower case, shingles joined by a space."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    h = np.array([digest(g, _SEED) for g in grams], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        part = h[i:i + 4096]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id",
                 shingle: int = 3) -> DataFrame:
    """(key, print, fp): fingerprints as signed 64-bit numbers, beside a hash of the text; one
    narrow pass over whole texts."""

    def run(batch: pa.RecordBatch):
        got = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], np.uint64)
        yield [batch.column(0), batch.column(1), got.view(np.int64)]

    return map_arrow(docs.select(docs[key].cast("long").alias(key),
                                 F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("print"),
                                 docs[text].alias("text")),
                     run, f"{key} long, print long, fp long")


def _ball(part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value): each value and its changes that clear one set bit."""
    rows, values = [np.arange(len(part))], [part]
    for bit in range(width):
        on = np.flatnonzero(part >> np.uint64(bit) & np.uint64(1))
        rows.append(on)
        values.append(part[on] ^ np.uint64(1 << bit))
    return np.concatenate(rows), np.concatenate(values)


def _probes(nodes: DataFrame) -> DataFrame:
    """(seg, key, fp): the balls of both halves."""

    def run(batch: pa.RecordBatch):
        fp = batch.column(0).to_numpy().view(np.uint64)
        for seg in (0, 1):
            rows, values = _ball(fp >> np.uint64(32 * seg) & np.uint64(0xFFFFFFFF), 32)
            for i in range(0, len(rows), 50_000):
                r, v = rows[i:i + 50_000], values[i:i + 50_000]
                yield [np.full(len(r), seg, np.int32), v.view(np.int64), fp[r].view(np.int64)]

    return map_arrow(nodes.select("fp"), run, "seg int, key long, fp long")


def _finer(hot: DataFrame) -> DataFrame:
    """The balls of both quarters of the half that a bucket leaves open."""

    def run(batch: pa.RecordBatch):
        seg, key = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fp = batch.column(2).to_numpy().view(np.uint64)
        other = fp >> (np.uint64(32) * (1 - seg).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
        for quarter in (0, 1):
            rows, values = _ball(other >> np.uint64(16 * quarter) & np.uint64(0xFFFF), 16)
            for i in range(0, len(rows), 50_000):
                r, v = rows[i:i + 50_000], values[i:i + 50_000]
                yield [seg[r] * 2 + quarter + 2, key[r] << 16 | v.view(np.int64),
                       fp[r].view(np.int64)]

    return map_arrow(hot.select("seg", "key", "fp"), run, "seg int, key long, fp long")


def forest(fp: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) that connect what lies within ``bits`` of each other: each node is
    compared once with the nodes not yet reached, in blocks."""
    left, a, b = np.unique(fp), [], []
    while len(left):
        front, left, root = left[:1], left[1:], left[0]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for i in range(0, len(front), 256):
                far = np.flatnonzero(~near)
                for j in range(0, len(far), 8192):
                    f = far[j:j + 8192]
                    x = front[i:i + 256, None] ^ left[None, f]
                    near[f] |= (np.bitwise_count(x) <= bits).any(0)
            front, left = left[near], left[~near]
            a.append(front)
            b.append(np.full(len(front), root, np.uint64))
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(a + none), np.concatenate(b + none)


def _bucket_links(buckets: DataFrame, bits: int) -> DataFrame:
    """Links inside buckets of a bounded size, each an array of nodes."""

    def run(batch: pa.RecordBatch):
        column = batch.column(0)
        at, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        a, b = [], []
        for i, j in zip(at[:-1], at[1:], strict=True):
            if j - i == 2:
                if bin(int(flat[i]) ^ int(flat[i + 1])).count("1") <= bits:
                    a.append(flat[i:i + 1])
                    b.append(flat[i + 1:j])
                continue
            x, y = forest(flat[i:j], bits)
            a.append(x)
            b.append(y)
        if a:
            yield [np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)]

    return map_arrow(buckets.select("fps"), run, "a long, b long")


def near_links(nodes: DataFrame, bits: int = BITS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``nodes`` that connect all
    that lie within ``bits`` bits of each other (three at most)."""
    if not 0 <= bits <= 3:
        raise ValueError("halves and one-bit balls find links of up to three bits")
    probes = _probes(nodes)
    size = probes.groupBy("seg", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Spark sizes either side like the fingerprints, which become some 30 rows each, and would
    # broadcast one from the driver.
    met = settle(probes.hint("merge").join(size, ["seg", "key"]), "probes")
    cold = met.where(F.col("n") <= bucket).groupBy("seg", "key")
    fine = _finer(met.where(F.col("n") > bucket)).groupBy("seg", "key")
    links = [_bucket_links(g.agg(F.collect_list("fp").alias("fps")).where("size(fps) > 1"), bits)
             for g in (cold, fine)]
    return links[0].union(links[1])


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3,
                    bits: int = BITS) -> DataFrame:
    """One row per row of ``docs``: key, print (a hash of the text), fingerprint (16 hex
    digits), component_id, root (the least fingerprint of the component, as a signed number).

    ``component_id`` is the least key reachable by links of at most ``bits`` differing bits.
    A null text is empty; texts without words have fingerprint zero and link like any other.
    A null key takes no part in the least key; a component of such rows only has a null id.
    """
    prints = settle(fingerprints(docs, text, key, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min(key).alias("least"))
    # Joins by merging: tables with a row per fingerprint are several times their files' size in
    # memory, and below Spark's limit by those would be broadcast.
    roots = components(near_links(nodes, bits), "near").hint("merge")
    placed = settle(nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "placed")
    # Written first: adaptive execution splits a hot key only between two plain exchanges.
    ids = settle(placed.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    of = settle(placed.join(ids.hint("merge"), "root").select(F.col("fp").alias("node"), "root",
                                                                   "component_id"), "of")
    return prints.join(of.hint("merge"), prints["fp"] == of["node"]).select(
        key, "print", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3,
             bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: the one with the least key, and
    of several with that key the one with the least hash of its text. A row without a key
    stands behind all keys. Texts are shuffled once, by the row they belong to."""
    own = F.coalesce(docs[key].cast("long"), F.lit((1 << 63) - 1))
    named = docs.select(own.alias("own"), docs[text].alias("text"))
    first = near_duplicates(named, "text", "own", shingle, bits).groupBy("root") \
        .agg(F.min(F.struct("own", "print")).alias("at")).select("at.own", "at.print") \
        .withColumnsRenamed({"own": "near_own", "print": "near_print"})
    # The caller's columns travel in a struct, so no name of theirs can clash.
    tagged = docs.select(own.alias("near_key"),
                         F.xxhash64(F.coalesce(docs[text], F.lit(""))).alias("near_text"),
                         F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    return tagged.join(first, F.expr("near_key = near_own AND near_text = near_print"), "left_semi") \
        .dropDuplicates(["near_key", "near_text"]).select("row.*")
