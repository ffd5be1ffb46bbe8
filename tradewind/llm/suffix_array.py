"""Suffix arrays of byte strings in numpy: Larsson-Sadakane refinement and Kasai common prefixes."""

from __future__ import annotations

import numpy as np

U = np.uint64


def words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on as one big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), U)
    for k in range(8):
        out = out << U(8) | padded[k:k + len(data)]
    return out


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in lexical order, a suffix before its extensions.

    Suffixes are sorted by their first 8 bytes; then, while a group has several members, each is sorted by the rank of the
    suffix that starts as many bytes later as the group already agrees in, which doubles that number.
    Only members of such groups are touched again.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    # from the end on, so that of suffixes that zeros have made equal the shorter comes first
    key, left = words8(data)[::-1], np.minimum(np.arange(1, n + 1), 8)
    order = np.argsort(key, kind="stable")
    key, left = key[order], left[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (left[1:] != left[:-1])])
    order = n - 1 - order
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group is named by its first place
    rank = np.empty(n + 1, np.int64)
    rank[order] = group
    rank[n] = -1
    agreed = 8
    while True:
        size = np.bincount(group, minlength=n)
        open_places = np.flatnonzero(size[group] > 1)
        if not len(open_places):
            return order
        suffixes = order[open_places]
        later = rank[np.minimum(suffixes + agreed, n)]
        by = np.lexsort((later, group[open_places]))
        suffixes, later, owner = suffixes[by], later[by], group[open_places]
        order[open_places] = suffixes
        fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (later[1:] != later[:-1])])
        group[open_places] = np.maximum.accumulate(np.where(fresh, open_places, 0))
        rank[suffixes] = group[open_places]
        agreed *= 2


STRIP = 64


def common_prefixes(data: np.ndarray, order: np.ndarray, cap: int) -> np.ndarray:
    """Bytes that each place's suffix shares with the place before it, at most ``cap``.

    Kasai's rule: going one byte on in the text, the shared length falls by one at most. Strips of the text
    are walked side by side, so each step is one vector operation.
    """
    n = len(order)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, n, np.int64)  # of each suffix, the one before it in order; n: none
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(1, np.uint8)])
    shared = np.zeros(n, np.int64)
    firsts = np.arange(0, n, STRIP)
    carried = np.zeros(len(firsts), np.int64)
    for k in range(min(STRIP, n)):
        at = firsts + k
        at = at[at < n]
        other, length = before[at], np.maximum(carried[:len(at)] - 1, 0)
        length[other == n] = 0
        active = np.flatnonzero(other < n)
        while len(active):
            a, b = at[active] + length[active], other[active] + length[active]
            go = (length[active] < cap) & (a < n) & (b < n)
            go &= padded[np.minimum(a, n)] == padded[np.minimum(b, n)]
            active = active[go]
            length[active] += 1
        shared[at], carried[:len(at)] = length, length
    return shared[order]


def repeated_groups(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, number of the run of suffixes that share ``depth`` bytes) for all suffixes."""
    order = suffix_array(data)
    return order, np.cumsum(common_prefixes(data, order, depth) < depth)
