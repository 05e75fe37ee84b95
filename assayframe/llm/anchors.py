"""Windows of a fixed length, gathered by anchors that depend on their content alone.

Each window of ``window`` units (bytes or words) has an anchor: the gram of ``gram`` units in it
with the smallest hash, the leftmost on ties. Where the anchor lies in the window (``offset``)
tells a part: windows of the upper part hold at least half of the other units on the anchor's
left, those of the lower part on its right. A window's key is a hash of its anchor with that
context, so equal windows, wherever they lie, meet under one key, and windows that merely share
a common gram don't. Consecutive windows of one anchor and part make a chunk; every window lies
in exactly one. Chunks are some 100 times fewer than bytes for 200-byte windows.

A part is a range of offsets, and all its windows share the units from ``low`` left of the anchor
to the end of the highest offset's window; parts can be halved down to one window (``halves``).
"""

from __future__ import annotations

import numpy as np

from .text import byte_grams, byte_hashes, gram_hashes, mix, unit_hashes, window_minima

#: Bits of a hash that anchors are chosen by (see ``window_minima``).
_CHOSEN = np.uint64(28)


def range_hashes(units: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each range of units, by its content alone; units are bytes or 64-bit values."""
    return (byte_hashes if units.dtype == np.uint8 else unit_hashes)(units, start, end)


def grams_of(units: np.ndarray, gram: int) -> np.ndarray:
    return (byte_grams if units.dtype == np.uint8 else gram_hashes)(units, gram)


def halves(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The first offset of the upper half of each part."""
    return (low + high + 1) // 2


def keys(units: np.ndarray, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, window: int,
         gram: int) -> np.ndarray:
    """Keys of parts low..high of the anchors at places ``anchor`` in ``units``."""
    shared = range_hashes(units, anchor - low, anchor - high + window)
    return mix(shared + mix((low.astype(np.uint64) << np.uint64(32)) + high.astype(np.uint64)))


def anchor_of(piece: np.ndarray, window: int, gram: int) -> int:
    """The offset of the anchor of a piece's first window."""
    return int(np.argmin(grams_of(piece[:window], gram) >> _CHOSEN))


class Chunks:
    """Of one slice: ``key`` and ``content`` (hashes), ``start`` (first unit of the first
    window, in the slice), ``count`` (windows), ``doc`` (row in the slice), ``local`` (start in
    its text), ``offset`` (of the anchor in the first window) and the part ``low``..``high``."""

    def __init__(self, units: np.ndarray, first: np.ndarray, window: int, gram: int):
        """``units``: bytes or 64-bit values; ``first``: each text's first unit, and the end."""
        size = np.diff(first)
        at = window_minima(grams_of(units, gram), window - gram + 1)
        many = np.maximum(size - window + 1, 0)
        owner = np.repeat(np.arange(len(size), dtype=np.int32), many)
        start = np.repeat(first[:-1] - np.cumsum(many) + many, many) + np.arange(many.sum())
        at = at[start]
        most = window - gram
        half = int(halves(np.int64(0), np.int64(most)))
        upper = at - start >= half
        cut = np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
                              | (upper[1:] != upper[:-1]))) if len(at) else np.zeros(0, bool)
        head = np.flatnonzero(cut)
        self.start, self.doc = start[head], owner[head].astype(np.int64)
        self.count = np.diff(np.append(head, len(at)))
        self.low = np.where(upper[head], half, 0)
        self.high = np.where(upper[head], most, half - 1) if most else self.low
        self.offset = at[head] - self.start
        self.key = keys(units, at[head], self.low, self.high, window, gram)
        self.content = range_hashes(units, self.start, self.start + self.count + window - 1)
        self.local = self.start - first[:-1][self.doc]
