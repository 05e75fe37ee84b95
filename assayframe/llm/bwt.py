"""Repeated strings of at least a given length, by interval expansion on a
Burrows-Wheeler transform.

The longest-common-prefix values of a suffix array are derived by increasing value, breadth
first: the interval of a string is extended backwards by each symbol in front of it, and the
right border of each new interval gets the string's length as its value, if it has none yet
(Beller, Gog, Ohlebusch and Schnattinger, 2013). Values from the wanted length on are never
computed: the search stops there, and the borders left open join suffixes that share at least
that much.
"""

from __future__ import annotations

import numpy as np

from .text import ranges

#: Symbols are bytes + 1; 0 ends a string.
END = 0
_PACKED = 7


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols, by prefix doubling. Only
    suffixes that still tie are ordered again."""
    n = len(text)
    key = np.zeros(n, np.uint64)
    wide = np.concatenate((text, np.zeros(_PACKED, text.dtype))).astype(np.uint64)
    for i in range(_PACKED):
        key = key << np.uint64(9) | wide[i:i + n]
    order = np.argsort(key, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head
    have = _PACKED
    while have < depth:
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if len(tied) == 0:
            break
        rows = order[tied]
        group = head[tied]
        follow = rank[np.minimum(rows + have, n)] + 1
        place = np.argsort(group * (n + 1) + follow, kind="stable")
        rows, group, follow = rows[place], group[place], follow[place]
        order[tied] = rows
        new[tied] = np.concatenate(([True], (group[1:] != group[:-1])
                                    | (follow[1:] != follow[:-1])))
        head[tied] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        rank[order[tied]] = head[tied]
        have *= 2
    return order


def open_borders(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each place of the suffix order whether it shares ``depth`` symbols with the place
    before it (also true where a string ends earlier; see ``repeats``)."""
    n = len(text)
    back = order - 1
    back[back < 0] = n - 1
    where = np.empty(n, np.int64)
    where[order] = np.arange(n)
    step, front = where[back], text[back]
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(depth):
        width = high - low
        rows = ranges(low, width)
        owner = np.repeat(np.arange(len(low)), width)
        keep = front[rows] != END
        rows, owner = rows[keep], owner[keep]
        if len(rows) == 0:
            break
        to = step[rows]
        place = np.argsort(to)
        to, owner, symbol = to[place], owner[place], front[rows][place]
        head = np.flatnonzero(np.concatenate(([True], (to[1:] != to[:-1] + 1)
                                              | (owner[1:] != owner[:-1])
                                              | (symbol[1:] != symbol[:-1]))))
        low = to[head]
        high = to[np.append(head[1:], len(to)) - 1] + 1
        fresh = unset[high]
        low, high = low[fresh], high[fresh]
        if len(low) == 0:
            break
        unset[high] = False
    return unset[:n]


def repeats(strings: list[bytes], depth: int) -> list[np.ndarray]:
    """For each string, whether the ``depth`` bytes from each place (as far as they lie in it)
    also start at another place of any of the strings."""
    size = np.array([len(s) for s in strings], np.int64)
    n = int(size.sum()) + len(strings)
    if n == 0:
        return []
    text = np.zeros(n, np.uint16)
    end = np.cumsum(size + 1) - 1
    inside = np.ones(n, bool)
    inside[end] = False
    text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    order = suffix_order(text, depth)
    shared = open_borders(text, order, depth)
    whole = np.repeat(end, size + 1) - np.arange(n) >= depth
    # A place whose string ends early may hang on the one after it, never between two whole
    # ones, since the end sorts first: counting whole places per group is exact.
    group = np.cumsum(~shared) - 1
    count = np.bincount(group, whole[order])
    found = np.zeros(n, bool)
    found[order] = count[group] > 1
    found &= whole
    begin = end - size
    return [found[b:b + max(0, s - depth + 1)] for b, s in zip(begin, size, strict=True)]
