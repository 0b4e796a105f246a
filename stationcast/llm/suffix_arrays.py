"""Suffix arrays and common prefixes in numpy."""

from __future__ import annotations

import numpy as np


def words8(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every position as one big-endian number; zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), ">u8", padded.data, strides=(1,)).astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions of all suffixes of ``data`` (uint8) in order, by Larsson-Sadakane
    refinement: groups of suffixes equal in their first h bytes are sorted by the
    group of the suffix h bytes on, and only groups of several are touched again."""
    n = len(data)
    if n < 2:
        return np.arange(n)
    first = words8(data)
    sa = np.argsort(first)  # equal ones are told apart below, whatever their order here
    ordered = first[sa]
    at = np.arange(n)
    head = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], at, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = head
    open_ = _in_groups(head, at)
    h = 8
    while len(open_):
        pos = sa[open_]
        after = pos + h
        key = rank[pos] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key)
        key, pos = key[order], pos[order]
        sa[open_] = pos
        head = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], open_, 0))
        rank[pos] = head
        open_ = _in_groups(head, open_)
        h *= 2
    return sa


def _in_groups(head: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of ``at`` whose group has several members."""
    same = head[1:] == head[:-1]
    return at[np.r_[same, False] | np.r_[False, same]]


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int, starts: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``sa``
    (first: 0).  Comparison ends after ``most`` bytes; it begins anew at ``starts``,
    so a length is right up to ``most`` less the distance from the last start.

    Kasai's rule in its position-ordered form: a suffix whose left byte equals its
    predecessor's left byte loses one byte of its left neighbour's prefix.  Only the
    others, and the pieces' first positions, are compared; a running maximum of
    position plus length hands the rest on."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = (at == 0) | (before <= 0) | (data[at - 1] != data[before - 1])
    known[starts] = True
    pos = at[known]
    other = before[known]
    length = np.zeros(len(pos), np.int64)
    run = np.flatnonzero(other >= 0)
    eight = words8(data)
    for step in range(0, most + 8, 8):
        a, b = pos[run] + step, other[run] + step
        inside = (a < n) & (b < n)
        run, a, b = run[inside], a[inside], b[inside]
        differ = eight[a] ^ eight[b]
        equal = np.where(differ == 0, 8, 0)
        some = np.flatnonzero(differ)
        equal[some] = _leading(differ[some])
        length[run] = step + np.minimum(equal, n - np.maximum(a, b))
        run = run[(equal == 8) & (np.maximum(a, b) + 8 <= n)]
        if not len(run):
            break
    plcp = np.full(n, -1, np.int64)
    plcp[pos] = pos + length
    plcp = np.maximum(np.maximum.accumulate(plcp) - at, 0)
    return plcp[sa]


def _leading(differ: np.ndarray) -> np.ndarray:
    """Leading zero bytes of numbers that are not 0."""
    out = np.zeros(len(differ), np.int64)
    for byte in range(1, 8):
        out[differ < np.uint64(1) << np.uint64(64 - 8 * byte)] = byte
    return out
