"""Suffix arrays by induced sorting (linear time), and permuted common prefixes.

Suffixes are classified as smaller (S) or larger (L) than their successor. The substrings
between leftmost S positions are sorted by inducing, named, and sorted recursively as a shorter
string; from their order the whole array is induced in one pass up (L) and one pass down (S).
The first level runs over the buckets of its few symbols with whole arrays at a time; deeper
levels, whose symbols are the names, fill their buckets one by one.
"""

from __future__ import annotations

import numpy as np


def _by_symbol(found: np.ndarray, symbols: np.ndarray, queues: list[list[np.ndarray]]) -> None:
    """Append ``found``, split by symbol with its order kept, to the queues."""
    if not len(found):
        return
    s = symbols[found]
    order = np.argsort(s, kind="stable")
    found, s = found[order], s[order]
    cuts = np.flatnonzero(s[1:] != s[:-1]) + 1
    for part, c in zip(np.split(found, cuts), s[np.concatenate(([0], cuts))].tolist(), strict=True):
        queues[c].append(part)


def _induce(t: np.ndarray, larger: np.ndarray, leftmost: np.ndarray, n_symbols: int) -> np.ndarray:
    """All suffixes in the order that the order of the leftmost S positions induces."""
    n = len(t)
    starts: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    _by_symbol(leftmost, t, starts)
    up: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    l_part: list[np.ndarray] = [np.empty(0, np.int64)] * n_symbols
    for c in range(n_symbols):
        front = np.concatenate(up[c]) if up[c] else None
        done = []
        while front is not None and len(front):
            done.append(front)
            before = front[front > 0] - 1
            before = before[larger[before]]
            same = t[before] == c
            _by_symbol(before[~same], t, up)
            front = before[same]
        if done:
            l_part[c] = np.concatenate(done)
        for own in starts[c]:
            before = own[own > 0] - 1
            _by_symbol(before[larger[before]], t, up)
    down: list[list[np.ndarray]] = [[] for _ in range(n_symbols)]
    s_part: list[np.ndarray] = [np.empty(0, np.int64)] * n_symbols
    for c in range(n_symbols - 1, -1, -1):
        front = np.concatenate(down[c]) if down[c] else None
        done = []
        while front is not None and len(front):
            done.append(front)
            before = front[front > 0] - 1
            before = before[~larger[before]]
            same = t[before] == c
            _by_symbol(before[~same], t, down)
            front = before[same]
        if done:
            s_part[c] = np.concatenate(done)[::-1]
        own = l_part[c][::-1]
        before = own[own > 0] - 1
        _by_symbol(before[~larger[before]], t, down)
    s_part[0] = np.array([n - 1])  # the end mark, which nothing induces
    return np.concatenate([x for c in range(n_symbols) for x in (l_part[c], s_part[c])])


def _types(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L type of each position, leftmost S positions); ``t`` ends with a unique smallest symbol."""
    n = len(t)
    step = np.diff(t.astype(np.int64))
    # an equal neighbour takes the type of the next position that differs
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    place = np.minimum.accumulate(place[::-1])[::-1]
    larger = np.zeros(n, dtype=bool)
    larger[:-1] = step[np.minimum(place, n - 2)] < 0
    return larger, np.flatnonzero(~larger[1:] & larger[:-1]) + 1


def _names(t: np.ndarray, order: np.ndarray, leftmost: np.ndarray) -> np.ndarray:
    """Rank of each leftmost-S substring in ``order``; equal substrings share a rank."""
    following = np.empty(len(t), dtype=np.int64)
    following[leftmost] = np.append(leftmost[1:], len(t) - 1)
    size = following[order] - order + 1
    a, b = order[:-1], order[1:]
    alive = np.flatnonzero(size[:-1] == size[1:])
    equal = np.zeros(len(order) - 1, dtype=bool)
    at = 0
    while len(alive):
        alive = alive[t[a[alive] + at] == t[b[alive] + at]]
        at += 1
        ended = size[alive] <= at
        equal[alive[ended]] = True
        alive = alive[~ended]
    return np.concatenate(([0], np.cumsum(~equal)))


def suffix_array(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Suffix array of an array of symbols 1 .. n_symbols - 1 (an end mark 0 is put behind it)."""
    t = np.concatenate((symbols, [0])).astype(np.uint16)
    if len(t) == 1:
        return np.empty(0, np.int64)
    larger, leftmost = _types(t)
    order = _ordered(t, leftmost, _induce(t, larger, leftmost, n_symbols))
    return _induce(t, larger, order, n_symbols)[1:]


def _sorted_names(t: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of names 0 .. k - 1, of which the last is the only 0.

    As the first level, but its many buckets are filled one suffix at a time.
    """
    n = len(t)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    larger, leftmost = _types(t)
    small = (~larger).astype(np.uint8).tobytes()
    symbols = t.tolist()
    after = np.cumsum(np.bincount(t, minlength=k))
    tails, heads = after.tolist(), np.concatenate(([0], after[:-1])).tolist()

    def induced(seed: list[int]) -> np.ndarray:
        sa = [-1] * n
        end = tails[:]
        for i in reversed(seed):
            c = symbols[i]
            p = end[c] - 1
            sa[p] = i
            end[c] = p
        start = heads[:]
        for j in sa:  # reads what the loop itself has placed further on
            if j > 0 and not small[j - 1]:
                c = symbols[j - 1]
                p = start[c]
                sa[p] = j - 1
                start[c] = p + 1
        end = tails[:]
        for j in reversed(sa):
            if j > 0 and small[j - 1]:
                c = symbols[j - 1]
                p = end[c] - 1
                sa[p] = j - 1
                end[c] = p
        return np.array(sa)

    return induced(_ordered(t, leftmost, induced(leftmost.tolist())).tolist())


def _ordered(t: np.ndarray, leftmost: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The leftmost S positions in the order of their suffixes, from the order of their substrings."""
    is_leftmost = np.zeros(len(t), dtype=bool)
    is_leftmost[leftmost] = True
    order = first[is_leftmost[first]]
    names = _names(t, order, leftmost)
    if names[-1] + 1 == len(leftmost):
        return order
    name_of = np.empty(len(t), dtype=np.int64)
    name_of[order] = names
    return leftmost[_sorted_names(name_of[leftmost], int(names[-1]) + 1)]


def repeated_starts(text: np.ndarray, valid: np.ndarray, length: int) -> np.ndarray:
    """Of the ``valid`` positions, those whose next ``length`` bytes also start at another one.

    ``text`` holds symbols 2 .. 257 for bytes and 1 between strings; a valid position has
    ``length`` bytes before the next 1. The common prefix of each suffix with the one before it
    in the array is taken in text order (permuted), eight bytes at a time up to ``length``.
    """
    out = np.zeros(len(text), dtype=bool)
    order = suffix_array(text, 258)
    before = np.full(len(text), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(valid & (before >= 0))
    at = at[valid[before[at]]]
    raw = np.concatenate(((text - 2).astype(np.uint8), np.zeros(8, np.uint8)))
    if length >= 8:
        words = np.zeros(len(text) + 1, dtype=np.uint64)
        for j in range(8):
            words |= raw[j : j + len(words)].astype(np.uint64) << np.uint64(8 * j)
        steps = [*range(0, length - 7, 8), length - 8]
    else:
        words, steps = raw, list(range(length))
    for step in steps:
        at = at[words[at + step] == words[before[at] + step]]
    out[at] = True
    out[before[at]] = True
    return out
