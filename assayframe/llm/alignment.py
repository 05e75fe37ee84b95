"""Alignment of two tokenizers by the byte offsets where tokens of both end.

Both tokenizers' end offsets are rising lists. The shorter one drives a galloping search into
the longer: from a guessed place an exponential search brackets each offset and a binary search
finds it (``gallop``; all offsets of a batch move in step). Common ends cut both lists into
groups, and the differences of their ranks are the ranges of tokens that overlap. All pairs of
tokens of a group are linked.

Spread and bounds. Texts are encoded in one narrow pass over whole texts. A text is cut before
a space that follows a visible character, where no token of either kind can cross (checked when
the vocabularies are loaded; else a text is one piece); both have an end there, so equal pieces
are aligned once per task and a text of any length is worked on in slices. A text keeps its
distinct id pairs only, at most so many as the two vocabularies allow. How many documents hold a
pair is counted by Spark with map-side merges. Pairs that very many documents hold would be hot
keys of a join: up to ``HOT`` of the most frequent ones travel to all tasks, a bounded table, and
only the others are joined. Both ways give the same counts.

Null and empty texts have no tokens, and neither have texts that a tokenizer does not give back
byte by byte: their numbers are 0 and their digest is ''. Rows with equal or null keys are
documents of their own, each counted. Ties for an id's highest count all count as highest. An
empty table gives an empty result. Only key, text and ``keep`` are read, so other columns can't
clash.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assayframe.session import settle

from .text import ranges, slices

#: Id pairs sent to all tasks at most, bytes worked on at once, pieces a task remembers.
HOT, SLICE, REMEMBERED = 1 << 18, 2_000_000, 300_000
_SPACE = "▁"
#: A group of more pairs than this is reduced to distinct ids first.
_WIDE = 4096


class Vocabulary:
    """Bytes of each id, back to back, and how to encode a list of texts."""

    def __init__(self, pieces: list[bytes], encode: Callable[[list[str]], list[list[int]]],
                 separable: bool):
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)
        self.encode, self.separable = encode, separable

    def __len__(self) -> int:
        return len(self.size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.begin[ids], self.size[ids])]


def _byte_of() -> dict[str, int]:
    """The characters that stand for bytes: visible Latin-1 ones for themselves, the others in
    order from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def byte_level(content: bytes, pattern: str) -> Vocabulary:
    """A byte-level BPE vocabulary in JSON, whose pre-tokens match ``pattern``; texts are
    encoded with a space in front, special tokens' strings as plain text."""
    import tiktoken

    spec = json.loads(content)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer"):
        raise ValueError("not a byte-level BPE vocabulary without normaliser")
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()
             if all(c in byte for c in token)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    ordered = order == sorted(set(order)) and len(ranks) == len(order) + 256
    special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
    pieces = [b""] * (max([*ranks.values(), *special]) + 1)
    for token, i in [*ranks.items(), *((t, i) for i, t in special.items())]:
        pieces[i] = token
    if ordered and before.get("use_regex", True) and not before.get("add_prefix_space"):
        # Merges go by id: an encoder that takes ids as ranks gives the same.
        plain = {t: i for t, i in ranks.items() if i not in special}
        one = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=plain,
                                special_tokens={}).encode_ordinary
        return Vocabulary(pieces, lambda texts: [one(t) for t in texts], True)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_buffer(content)
    whole.encode_special_tokens = True
    return Vocabulary(pieces, lambda texts: [e.ids for e in whole.encode_batch(
        texts, add_special_tokens=False)], False)


@lru_cache(maxsize=4)
def piece_level(content: bytes) -> Vocabulary:
    """A sentencepiece model, which adds the space in front itself."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=content)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE, " ").encode()
              for i, p in enumerate(names)]
    crossing = any(_SPACE in p.lstrip(_SPACE) for p in names)
    one = model.encode("x")

    def encode(texts: list[str]) -> list[list[int]]:
        # A piece of spaces alone ends a text: the model drops it if nothing stands before it.
        bare = [not crossing and not t.strip(" ") for t in texts]
        found = model.encode([("x" + t) if b else t[1:] for t, b in
                              zip(texts, bare, strict=True)], num_threads=1)
        return [f[len(one):] if b else f for f, b in zip(found, bare, strict=True)]

    return Vocabulary(pieces, encode, not crossing)


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``short`` and ``long`` (both rising, without repeats) of their common values.

    Each value of ``short`` starts where its share of the way lies in ``long``, doubles its
    step towards the value until it is passed, and halves the bracket: some 2 log2(d) steps for
    a value that lies d places from the guess.
    """
    n = len(long)
    if not len(short) or not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    guess = np.arange(len(short)) * n // len(short)
    low, high = guess.copy(), guess.copy()
    step = 1
    up = np.flatnonzero(long[guess] < short)
    down = np.flatnonzero(long[guess] > short)
    while len(up) or len(down):
        low[up] = high[up]
        high[up] = np.minimum(high[up] + step, n)
        up = up[high[up] < n]
        up = up[long[high[up]] < short[up]]
        high[down] = low[down]
        low[down] = np.maximum(low[down] - step, 0)
        down = down[(low[down] > 0) & (long[low[down]] > short[down])]
        step *= 2
    # The first place that is not below the value lies in [low, high].
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        below = long[middle] < short[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    hit = np.flatnonzero(long[np.minimum(low, n - 1)] == short)
    return hit, low[hit]


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a`` and in ``b`` of the ends that both have; the shorter list drives."""
    if len(a) <= len(b):
        return gallop(a, b)
    in_b, in_a = gallop(b, a)
    return in_a, in_b


def _merged(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered distinct keys and the sums of their times."""
    order = np.argsort(key, kind="stable")
    key, times = key[order], times[order]
    head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
    return key[head], np.add.reduceat(times, head) if len(head) else times


class Pieces:
    """Aligned pieces of texts, each kept once: tokens, groups, links, id pairs and text."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.text: list[bytes] = []
        self.n = np.zeros((0, 4), np.int64)  # A tokens, B tokens, groups, links
        self.good = np.zeros(0, bool)
        self.pair = self.times = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The number of each piece; new ones are aligned."""
        if len(self.index) > REMEMBERED:
            self.forget()
        index, n = self.index, len(self.index)
        out = np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int64,
                          len(pieces))
        if len(index) > n:
            self._add(list(index)[n:])
        return out

    def _encoded(self, vocabulary: Vocabulary, texts: list[str], data: np.ndarray,
                 size: np.ndarray):
        """(ids, ids of each piece, whether its tokens are the piece's bytes)."""
        lists = vocabulary.encode(texts)
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int64, int(count.sum()))
        owner = np.repeat(np.arange(len(lists)), count)
        same = np.bincount(owner, vocabulary.size[ids], len(lists)).astype(np.int64) == size
        begin = np.cumsum(size) - size
        wanted = data[ranges(begin[same], size[same])]
        differ = np.flatnonzero(vocabulary.joined(ids[same[owner]]) != wanted)
        if len(differ):
            which = np.flatnonzero(same)
            same[which[np.searchsorted(np.cumsum(size[which]), differ, "right")]] = False
        return ids, count, same

    def _add(self, new: list[bytes]) -> None:
        size = np.fromiter(map(len, new), np.int64, len(new))
        data = np.frombuffer(b"".join(new), np.uint8)
        texts = [p.decode("utf-8", "replace") for p in new]
        (a, na, good_a), (b, nb, good_b) = (self._encoded(v, texts, data, size)
                                            for v in (self.a, self.b))
        good = good_a & good_b
        a, b = a[np.repeat(good, na)], b[np.repeat(good, nb)]
        na, nb = np.where(good, na, 0), np.where(good, nb, 0)
        in_a, in_b = common_ends(np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b]))
        from_a, from_b = (np.concatenate(([0], x[:-1] + 1)).astype(np.int64) if len(x) else x
                          for x in (in_a, in_b))
        da, db = in_a + 1 - from_a, in_b + 1 - from_b
        piece = np.repeat(np.arange(len(new)), na)[in_a]
        groups = np.bincount(piece, minlength=len(new))
        links = np.zeros(len(new), np.int64)
        np.add.at(links, piece, da * db)

        sa, sb = list(map(str, a.tolist())), list(map(str, b.tolist()))
        shown = [",".join(sa[i:i + m]) + "|" + ",".join(sb[j:j + n]) for i, m, j, n in
                 zip(from_a.tolist(), da.tolist(), from_b.tolist(), db.tolist(), strict=True)]
        at = np.concatenate(([0], np.cumsum(groups))).tolist()
        self.text += [";".join(shown[i:j]).encode() for i, j in zip(at[:-1], at[1:],
                                                                    strict=True)]

        small = da * db <= _WIDE
        many = (da * db)[small]
        inner = ranges(np.zeros(len(many), np.int64), many)
        row, column = np.divmod(inner, np.repeat(db[small], many))
        width = np.int64(len(self.a)) * len(self.b)
        keys = [np.repeat(piece[small], many) * width
                + a[np.repeat(from_a[small], many) + row] * len(self.b)
                + b[np.repeat(from_b[small], many) + column]]
        times = [np.ones(len(keys[0]), np.int64)]
        for g in np.flatnonzero(~small):
            ua, ca = np.unique(a[from_a[g]:in_a[g] + 1], return_counts=True)
            ub, cb = np.unique(b[from_b[g]:in_b[g] + 1], return_counts=True)
            keys.append((piece[g] * width + ua[:, None] * len(self.b) + ub).ravel())
            times.append((ca[:, None] * cb).ravel())
        key, times = _merged(np.concatenate(keys), np.concatenate(times))
        owner, pair = np.divmod(key, width)
        first = np.searchsorted(owner, np.arange(1, len(new) + 1)) + self.first[-1]

        self.n = np.concatenate((self.n, np.stack([na, nb, groups, links], 1)))
        self.good = np.append(self.good, good)
        self.pair, self.times = np.append(self.pair, pair), np.append(self.times, times)
        self.first = np.append(self.first, first)


#: Last bytes of white space beyond ASCII; a visible character may end with them as well.
_BLANK_END = np.zeros(256, bool)
_BLANK_END[:33] = True
_BLANK_END[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where texts start, and spaces that surely follow a visible character in a text."""
    start = data == 32
    start[1:] &= ~_BLANK_END[data[:-1]]
    # Two-byte characters with the lead C3 are all visible.
    start[2:] |= (data[2:] == 32) & (data[:-2] == 0xC3) & (data[1:-1] >= 0x80)
    start[at[:-1][at[1:] > at[:-1]]] = True
    return np.flatnonzero(start)


def spaced(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each that isn't empty."""
    full = at[1:] > at[:-1]
    moved = at + np.concatenate(([0], np.cumsum(full)))
    out = np.full(moved[-1], 32, np.uint8)
    out[np.repeat(np.cumsum(full), np.diff(at)) + np.arange(len(data))] = data
    return out, moved


def align_texts(pieces: Pieces, data: np.ndarray, at: np.ndarray):
    """(numbers, good, texts, pair, times, first) of texts with their space in front: per text
    A and B tokens, groups and links, whether both tokenizers give it back, the bytes of its
    groups, and its distinct id pairs from ``first`` on."""
    n = len(at) - 1
    if pieces.a.separable and pieces.b.separable:
        start = piece_starts(data, at)
    else:
        start = at[:-1][at[1:] > at[:-1]]
    end = np.append(start[1:], len(data)).astype(np.int64)[:len(start)]
    raw = data.tobytes()
    which = pieces.find([raw[i:j] for i, j in zip(start.tolist(), end.tolist(), strict=True)])
    owner = np.searchsorted(at, start, "right") - 1
    good = np.bincount(owner, ~pieces.good[which], n) == 0
    total = np.zeros((n, 4), np.int64)
    np.add.at(total, owner, pieces.n[which])
    total[~good] = 0
    border = np.searchsorted(owner, np.arange(n + 1))
    listed, text = which.tolist(), pieces.text
    texts = [b";".join([text[k] for k in listed[i:j]]) if g else b"" for i, j, g in
             zip(border[:-1].tolist(), border[1:].tolist(), good.tolist(), strict=True)]
    keep = good[owner]
    kinds = len(pieces.good)
    key, often = _merged(owner[keep] * kinds + which[keep], np.ones(int(keep.sum()), np.int64))
    owner, which = np.divmod(key, kinds) if kinds else (key, key)
    many = pieces.first[which + 1] - pieces.first[which]
    place = ranges(pieces.first[which], many)
    width = np.int64(len(pieces.a)) * len(pieces.b)
    key, times = _merged(np.repeat(owner, many) * width + pieces.pair[place],
                         pieces.times[place] * np.repeat(often, many))
    owner, pair = np.divmod(key, width)
    return total, good, texts, pair, times, np.searchsorted(owner, np.arange(n + 1))


def _long(pieces: Pieces, data: np.ndarray):
    """The same for one long text, in slices that end where a piece does."""
    starts = piece_starts(data, np.array([0, len(data)]))
    cuts = [0]
    while len(data) - cuts[-1] > SLICE:
        after = starts[np.searchsorted(starts, cuts[-1] + SLICE):]
        if not len(after):
            break
        cuts.append(int(after[0]))
    cuts.append(len(data))
    total, good, digest = np.zeros((1, 4), np.int64), True, hashlib.sha256()
    pair = times = np.zeros(0, np.int64)
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        part = align_texts(pieces, data[i:j], np.array([0, j - i]))
        total, good = total + part[0], good and bool(part[1][0])
        digest.update(b";" if i else b"")
        digest.update(part[2][0])
        pair, times = _merged(np.append(pair, part[3]), np.append(times, part[4]))
    if not good:
        return np.zeros((1, 4), np.int64), "", pair[:0], times[:0]
    return total, digest.hexdigest(), pair, times


def aligned(docs: DataFrame, a: Callable[[], Vocabulary], b: Callable[[], Vocabulary],
            text: str = "text") -> DataFrame:
    """The columns of ``docs`` but its text, with n_a, n_b, n_groups, n_links, groups_sha256 and
    the text's distinct id pairs (A id times the size of B, plus B id) with their links."""
    passed = [c for c in docs.columns if c != text]
    added = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long",
             "groups_sha256": "string", "pairs": "array<long>", "times": "array<long>"}
    base = docs.select(text, *passed)
    shape = base.drop(text)
    for name, kind in added.items():
        shape = shape.withColumn(name, F.lit(None).cast(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(a(), b())
        for batch in batches:
            for row, data, at in slices(batch.column(0), SLICE):
                data, at = spaced(data, at)
                if len(at) == 2 and len(data) > SLICE and pieces.a.separable \
                        and pieces.b.separable:
                    total, digest, pair, times = _long(pieces, data)
                    digests, first = [digest], np.array([0, len(pair)])
                else:
                    total, good, texts, pair, times, first = align_texts(pieces, data, at)
                    whole = good & (at[1:] > at[:-1])
                    digests = [hashlib.sha256(t).hexdigest() if w else ""
                               for t, w in zip(texts, whole.tolist(), strict=True)]
                offsets = pa.array(first, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(row, len(at) - 1) for c in batch.columns[1:]),
                     *(pa.array(total[:, i]) for i in range(4)), pa.array(digests, pa.string()),
                     *(pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (pair, times))],
                    names=[*passed, *added])

    return base.mapInArrow(run, shape.schema)


def _frequent(counts: DataFrame, hot: int) -> tuple[int, pa.Table]:
    """The least level (fourths of log2) whose pairs and all above number ``hot`` at most, and
    those pairs."""
    sizes = counts.groupBy("level").agg(F.count("*").alias("n")).toArrow()
    least, total = 1 << 30, 0
    for level, n in sorted(zip(sizes["level"].to_pylist(), sizes["n"].to_pylist(), strict=True),
                           reverse=True):
        total += n
        if total > hot:
            break
        least = level
    return least, counts.where(F.col("level") >= least).select("pair", "n").toArrow()


def align(docs: DataFrame, a: Callable[[], Vocabulary], b: Callable[[], Vocabulary],
          key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
          hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: key, ``keep`` columns, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    ``a`` and ``b`` give the vocabularies on a worker. An id pair's count is the number of
    documents that hold it linked; ``count_sum`` adds the counts of a text's links, ``n_best``
    counts the links whose count is the highest of their A id.
    """
    chosen = docs.select(docs[text].alias("text"), docs[key].alias("own_key"),
                         *[docs[c].alias(f"keep_{i}") for i, c in enumerate(keep)])
    rows = settle(aligned(chosen, a, b).withColumn("row", F.monotonically_increasing_id()),
                  "aligned")
    width = len(b())
    counts = settle(rows.select(F.explode("pairs").alias("pair")).groupBy("pair")
                    .agg(F.count("*").alias("n"))
                    .withColumn("level", F.floor(4 * F.log2("n")).cast("int")), "pair-counts")
    id_of = F.floor(F.col("pair") / width).cast("long")
    best = counts.groupBy(id_of.alias("id")).agg(F.max("n").alias("most"))
    known = best.toArrow()  # a row per id of A
    most = np.zeros(len(a()), np.int64)
    most[known["id"].to_numpy()] = known["most"].to_numpy()
    least, table = _frequent(counts, hot)
    order = np.argsort(table["pair"].to_numpy())
    pairs, number = (table[c].to_numpy()[order] for c in ("pair", "n"))

    passed = [c for c in rows.columns if c not in ("pairs", "times")]
    added = {"best_hot": "long", "sum_hot": "long", "pairs": "array<long>",
             "times": "array<long>"}
    shape = rows.select(*passed)
    for name, kind in added.items():
        shape = shape.withColumn(name, F.lit(None).cast(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            at = lists.offsets.to_numpy()
            pair, times = (batch.column(i).values.to_numpy()[at[0]:at[-1]] for i in (0, 1))
            owner = np.repeat(np.arange(len(lists)), np.diff(at))
            place = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            met = pairs[place] == pair if len(pairs) else np.zeros(len(pair), bool)
            n = number[place[met]]
            total = np.zeros((2, len(lists)), np.int64)
            np.add.at(total[0], owner[met], times[met] * (n == most[pair[met] // width]))
            np.add.at(total[1], owner[met], times[met] * n)
            left = np.concatenate(([0], np.cumsum(np.bincount(owner[~met],
                                                              minlength=len(lists)))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[2:], pa.array(total[0]), pa.array(total[1]),
                 *(pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(v[~met]))
                   for v in (pair, times))], names=[*passed, *added])

    looked = settle(rows.select("pairs", "times", *passed).mapInArrow(run, shape.schema),
                    "looked-up")
    rare = counts.where(F.col("level") < least) \
        .join(best, id_of == F.col("id")).select("pair", "n", (F.col("n") == F.col("most"))
                                                 .alias("top"))
    tail = looked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
        .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("t")) \
        .join(rare, "pair").groupBy(F.col("row").alias("tail")).agg(
            F.sum(F.when(F.col("top"), F.col("t")).otherwise(0)).alias("best_rare"),
            F.sum(F.col("t") * F.col("n")).alias("sum_rare"))
    out = looked.join(tail, F.col("row") == F.col("tail"), "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("own_key").alias(key), *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep)],
        "n_a", "n_b", "n_groups", "n_links",
        (F.col("best_hot") + F.coalesce("best_rare", zero)).alias("n_best"),
        (F.col("sum_hot") + F.coalesce("sum_rare", zero)).alias("count_sum"), "groups_sha256")
