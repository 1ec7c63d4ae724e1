"""Suffix array of one shard by induced sorting, and its permuted common prefixes.

The symbols of a shard are bytes plus two; one parts its texts and zero ends it.
The first level induces the order a bucket of equal first symbols at a time,
on numpy arrays. Its string of named substrings is about a third as long and has
a large alphabet, where buckets hold few suffixes: there, all suffixes are
sorted at once by what they hold up to the next leftmost-smaller suffix, and
then by the order of that one.
"""

from __future__ import annotations

import numpy as np

Chunks = list[list[np.ndarray]]


def packed(t: np.ndarray) -> np.ndarray:
    """For each place the seven symbols from there on, nine bits each, the first one
    highest; zeros after the end. Symbols are below 512."""
    one = np.concatenate([t.astype(np.uint64), np.zeros(6, np.uint64)])
    two = one[:-1] << np.uint64(9) | one[1:]
    four = two[:-2] << np.uint64(18) | two[2:]
    return four[:-3] << np.uint64(27) | two[4:-1] << np.uint64(9) | one[6:]


def smaller_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; true for the last."""
    n = len(t)
    differs = np.append(t[:-1] != t[1:], True)
    after = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]  # the next place that differs
    return np.append(t[:-1] < t[1:], True)[after]


def _deal(found: np.ndarray, t: np.ndarray, own: int, to: Chunks) -> np.ndarray:
    """Append suffixes to the buckets of their first symbols, in order; those of ``own`` come back."""
    same = found[:0]
    if not len(found):
        return same
    first = t[found]
    order = np.argsort(first, kind="stable")
    found, first = found[order], first[order]
    cuts = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    for a, b in zip(cuts, [*cuts[1:], len(found)], strict=True):
        if first[a] == own:
            same = found[a:b]
        else:
            to[first[a]].append(found[a:b])
    return same


def _bucket(c: int, into: Chunks, t: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The suffixes of a bucket in the order of the scan, whose predecessors go on to their buckets."""
    front = np.concatenate(into[c]) if into[c] else np.zeros(0, np.int64)
    parts = [front]
    while len(front):
        before = front[front > 0] - 1
        front = _deal(before[wanted[before]], t, c, into)
        parts.append(front)
    return np.concatenate(parts)


def induced(t: np.ndarray, s: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """All suffixes, induced from the leftmost-smaller ones in the given order."""
    larger = ~s
    order = np.argsort(t[lms], kind="stable")
    lms = lms[order]
    cut = np.searchsorted(t[lms], np.arange(k + 1))
    late: Chunks = [[] for _ in range(k)]
    early: Chunks = [[] for _ in range(k)]
    held = []
    for c in range(k):
        held.append(_bucket(c, late, t, larger))
        before = lms[cut[c] : cut[c + 1]]
        before = before[before > 0] - 1
        _deal(before[larger[before]], t, c, late)
    out: list[np.ndarray] = []
    early[0].append(np.array([len(t) - 1]))  # the end, smaller than all
    for c in reversed(range(k)):
        small = _bucket(c, early, t, s)
        before = held[c][::-1]
        before = before[before > 0] - 1
        _deal(before[s[before]], t, c, early)
        out += [small[::-1], held[c]]
    return np.concatenate(out[::-1])


def _classes(x: np.ndarray, s: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """For each place the order of its symbols up to the next leftmost-smaller one,
    ``reach`` places on; equal sequences share the number of the first of them.

    With the types none of these sequences begins another one, so those that
    agree so far end together.
    """
    key = 2 * x + s
    order = np.argsort(key)  # equal ones share a number, so their own order does not matter
    new = np.append(True, key[order][1:] != key[order][:-1])
    out = np.empty(len(x), dtype=np.int64)
    out[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    tied = np.append(new, True)
    left = order[~(tied[:-1] & tied[1:])]
    step, width = 1, int(key.max()) + 1
    at_once = max(1, (62 - len(x).bit_length()) // width.bit_length())  # symbols that fit in a number beside the order
    while len(left := left[reach[left] >= step]):
        both, end = out[left], reach[left]
        for k in range(step, step + at_once):
            both = both * width + np.where(end >= k, key[left + np.minimum(k, end)], 0)
        order = np.argsort(both)
        left, both = left[order], both[order]
        own = out[left]
        group = np.append(True, own[1:] != own[:-1])
        new = np.append(True, both[1:] != both[:-1])
        place = np.arange(len(left))
        first = np.maximum.accumulate(np.where(group, place, 0))
        out[left] = own + np.maximum.accumulate(np.where(new, place, 0)) - first
        tied = np.append(new, True)
        left = left[~(tied[:-1] & tied[1:])]
        step += at_once
    return out


def _ordered(x: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of the reduced string in order; its last symbol, zero,
    is the only one of its kind. The order of its own leftmost-smaller suffixes
    comes by recursion; every suffix follows from its class and the next of them."""
    n = len(x)
    if int(x.max()) + 1 == n:  # every symbol once
        return np.argsort(x)
    s = smaller_types(x)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    after = np.minimum(np.searchsorted(lms, np.arange(n), "right"), len(lms) - 1)
    classes = _classes(x, s, lms[after] - np.arange(n))
    rank = np.empty(len(lms), dtype=np.int64)
    rank[_ordered(np.unique(classes[lms], return_inverse=True)[1])] = np.arange(len(lms))
    return np.argsort(classes * len(lms) + rank[after])


def suffix_array(t: np.ndarray, k: int = 258) -> np.ndarray:
    """Starts of the suffixes of ``t`` in order; ``t`` ends in its only least symbol."""
    s = smaller_types(t)
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) < 2:
        return induced(t, s, lms, k)
    order = induced(t, s, lms, k)
    marked = np.zeros(len(t), bool)
    marked[lms] = True
    order = order[marked[order]]  # leftmost-smaller substrings in order; equal ones have any order
    size = np.zeros(len(t), np.int64)
    size[lms] = np.append(np.diff(lms), 0) + 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    left, step = np.flatnonzero(same), 0
    seven = packed(t)
    i, j, rest = a[left], b[left], size[a[left]]
    while len(left):
        beyond = 9 * np.maximum(7 - rest, 0).astype(np.uint64)
        hit = (seven[i] ^ seven[j]) >> beyond == 0
        same[left[~hit]] = False
        go = hit & (rest > 7)
        left, i, j, rest = left[go], i[go] + 7, j[go] + 7, rest[go] - 7
    name = np.zeros(len(t), np.int64)
    name[order] = np.cumsum(np.append(False, ~same))
    names = int(name[order[-1]]) + 1
    if names < len(lms):
        order = lms[_ordered(name[lms])]
    return induced(t, s, order, k)


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start: the start before it in order (-1: none), and how many symbols they share.

    A start whose left neighbour shares the symbol before has one symbol less
    in common than that neighbour; only the others are compared, seven
    symbols at a time.
    """
    n = len(t)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    led = (before > 0) & (place > 0)
    led[led] = t[place[led] - 1] == t[before[led] - 1]
    ends = np.flatnonzero(~led & (before >= 0))
    seven = packed(t)
    shared = np.zeros(n, dtype=np.int64)
    i, j, done = ends, before[ends], 0
    while len(i):
        x = seven[i] ^ seven[j]
        go = x == 0  # the last symbol is the only one of its kind, so no two suffixes run out together
        x = x[~go]
        shared[ends[~go]] = done + sum((x < np.uint64(1 << bits)).astype(np.int64) for bits in range(9, 63, 9))
        done += 7
        ends, i, j = ends[go], i[go] + 7, j[go] + 7
    last = np.maximum.accumulate(np.where(led, 0, place))
    return before, np.maximum(shared[last] - (place - last), 0)
