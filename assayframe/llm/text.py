"""Vectorised reading of text columns inside Arrow tasks.

Texts of a batch lie back to back in one byte buffer; all helpers work on that buffer, so no
Python object is made per word. Words are ``[^\\x20\\x09-\\x0D]+`` and never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts are handled in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 2_000_000

_PRIME = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` where ``fn`` maps one record batch to record batches."""
    kinds = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn(batch):
                if not isinstance(out, pa.RecordBatch):
                    out = pa.RecordBatch.from_arrays(
                        [pa.array(v, type=f.type) for v, f in zip(out, kinds, strict=True)],
                        schema=kinds)
                yield out

    return df.mapInArrow(run, schema)


def pa_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
             "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    return pa.schema([pa.field(n, kinds[k]) for n, k in
                      (part.strip().split(" ", 1) for part in ddl.split(","))])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and each text's offset in them; a null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(at), np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    data, at = texts_of(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a slice: ``start`` and ``end`` (exclusive) bytes, ``doc`` (row in the slice),
    ``first`` (index of each text's first word; one more entry at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        """``inside``: 256 flags of the bytes that make words; any but white space if None."""
        self.data, self.offsets = data, offsets
        if len(data) == 0:
            self.start = self.end = np.zeros(0, np.int64)
        else:
            word = (~_SPACE if inside is None else inside)[data]
            begin = word.copy()
            begin[1:] &= ~word[:-1]
            finish = word.copy()
            finish[:-1] &= ~word[1:]
            full = offsets[:-1][offsets[1:] > offsets[:-1]]
            begin[full] = word[full]
            last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
            finish[last] = word[last]
            self.start, self.end = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, lower: bool = False, most: int | None = None) -> np.ndarray:
        """A 64-bit value per word that depends on its bytes alone (its first ``most``)."""
        return self.several_hashes(lower, (most,))[0]

    def several_hashes(self, lower: bool, sizes: tuple[int | None, ...]) -> list[np.ndarray]:
        """``hashes`` for several numbers of first bytes."""
        data = _LOWER[self.data] if lower else self.data
        ends = [self.end if m is None else np.minimum(self.end, self.start + m) for m in sizes]
        return [byte_hashes(data, self.start, e) for e in ends]


def word_units(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one long text, read in slices that end at white space."""
    out, begin = [], 0
    while begin < len(data):
        end = begin + SLICE_BYTES
        if end < len(data):
            # Ever further, so that a slice ends after a word of any length.
            step = 1 << 12
            while end < len(data) and not _SPACE[data[end:end + step]].any():
                end, step = end + step, 2 * step
            end += int(np.argmax(_SPACE[data[end:end + step]])) if end < len(data) else 0
        part = data[begin:end]
        out.append(Words(part, np.array([0, len(part)])).hashes())
        begin = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def byte_lanes(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each byte on as one number; zeros follow the last byte."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _lane(value: np.ndarray, k: np.ndarray | int) -> np.ndarray:
    return mix(value + np.uint64(_PRIME) * np.asarray(k + 1, np.uint64))


def byte_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit value of each range of bytes, by its content alone.

    Ranges are cut into lanes of eight bytes; each is mixed with its place before lanes are
    added, so no pattern of symbols cancels out, as in polynomials modulo 2^64."""
    size = end - start
    if len(size) == 0:
        return np.zeros(0, np.uint64)
    lanes = byte_lanes(data)

    def read(at: np.ndarray, left: np.ndarray) -> np.ndarray:
        keep = np.uint64(8) * (np.uint64(8) - np.minimum(left, 8).astype(np.uint64))
        return np.where(left > 0, lanes[at] << np.minimum(keep, np.uint64(63)) , np.uint64(0))

    total = _lane(read(start, size), 0)
    long = np.flatnonzero(size > 8)
    if len(long):
        many = (size[long] - 1) // 8
        step = ranges(np.ones(len(long), np.int64), many)
        owner = np.repeat(long, many)
        value = _lane(read(start[owner] + 8 * step, size[owner] - 8 * step), step)
        total[long] += np.add.reduceat(value, np.cumsum(many) - many)
    return mix(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def unit_hashes(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The same for ranges of 64-bit units."""
    size = end - start
    total = np.zeros(len(size), np.uint64)
    full = np.flatnonzero(size > 0)
    if len(full):
        step = ranges(np.zeros(len(full), np.int64), size[full])
        value = _lane(units[np.repeat(start[full], size[full]) + step], step)
        total[full] = np.add.reduceat(value, np.cumsum(size[full]) - size[full])
    return mix(total + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def byte_grams(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` consecutive bytes; two overlapping halves of a power of two bytes
    tell a gram."""
    m = len(data) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    if n < 8:
        return mix((byte_lanes(data)[:m] << np.uint64(64 - 8 * n)) + np.uint64(n))
    have, power = 8, mix(byte_lanes(data)[:len(data) - 7])
    while 2 * have <= n:
        k = len(power) - have
        power = mix(power[:k] * np.uint64(_PRIME + 2 * have) + power[have:])
        have *= 2
    if have < n:
        power = mix(power[:m] * np.uint64(_PRIME + 4 * n) + power[n - have:n - have + m])
    return power


def gram_hashes(values: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A hash of each ``n`` consecutive values, in O(log n) passes; pieces of a power of two
    are joined, so the result depends on the values alone."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out, size, have, power = None, 0, 1, values.astype(np.uint64, copy=True)
    rest = n
    while rest:
        if rest & 1:
            if out is None:
                out, size = power, have
            else:
                m = len(values) - size - have + 1
                out = mix(out[:m] * np.uint64(_PRIME + 2 * have + salt * 4)) + power[size:size + m]
                size += have
        rest >>= 1
        if rest:
            m = len(values) - 2 * have + 1
            power = mix(power[:m] * np.uint64(0xD6E8FEB86659FD93 + 2 * have)) + power[have:have + m]
            have *= 2
    return mix(out)


#: Places in a slice take so many low bits of a packed key.
_PLACE_BITS = np.uint64(28)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the index of its smallest one, the leftmost on ties.

    Value and place are packed into one key; running minima over blocks of ``width``, forwards
    and backwards, give each window's least key in a constant number of passes.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    if n >> int(_PLACE_BITS):
        raise ValueError("places beyond 2^28: cut the values into overlapping slices")
    blocks = -(-n // width)
    key = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    key[:n] = (values >> _PLACE_BITS << _PLACE_BITS) | np.arange(n, dtype=np.uint64)
    square = key.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(back[:n - width + 1], ahead[width - 1:n])
    return (low & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` (``count[i]`` numbers each), one after another."""
    ends = np.cumsum(count)
    if len(ends) == 0 or ends[-1] == 0:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(start - ends + count, count)
