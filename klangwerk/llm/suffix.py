"""Suffix arrays by Larsson-Sadakane refinement, common prefixes after Kasai, and merging, in numpy."""

from __future__ import annotations

import numpy as np


def heads(text: np.ndarray) -> np.ndarray:
    """The first eight bytes of every suffix as one big-endian number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | padded[i : i + len(text)]
    return out


def suffix_array(text: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Positions of the suffixes in order. Only groups that are still tied are sorted again, by the rank
    that their members' suffixes have h bytes on; h doubles."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    key = heads(text) if first is None else first
    sa = np.argsort(key)
    k = key[sa]
    lead = np.concatenate([[True], k[1:] != k[:-1]])
    at = np.maximum.accumulate(np.where(lead, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = at
    slots = np.flatnonzero(~(lead & np.concatenate([lead[1:], [True]])))
    h = 8
    # rank, rank ahead and position of up to 2^21 suffixes in one number, which sorts faster than an order of others is found
    width = n.bit_length()
    low = np.uint64((1 << width) - 1)
    while len(slots) and h < 2 * n + 16:
        i = sa[slots]
        ahead = i + h
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0).astype(np.uint64)
        both = rank[i].astype(np.uint64)
        if 3 * width <= 64:
            both <<= np.uint64(width)
            both |= second
            both <<= np.uint64(width)
            both |= i.astype(np.uint64)
            both.sort()
            i = (both & low).astype(np.int64)
            both >>= np.uint64(width)
        else:
            both = (both << np.uint64(32)) | second
            order = np.argsort(both)
            both, i = both[order], i[order]
        sa[slots] = i
        lead = np.concatenate([[True], both[1:] != both[:-1]])
        rank[i] = slots[np.maximum.accumulate(np.where(lead, np.arange(len(slots)), 0))]
        slots = slots[~(lead & np.concatenate([lead[1:], [True]]))]
        h *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """lcp[r]: the common prefix of suffixes sa[r-1] and sa[r]; lcp[0] is 0.

    Kasai's lemma in text order: the value falls by one at most from one position to the next, so only
    positions where the preceding bytes differ are compared, the others follow by a running maximum.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    key = heads(text) if first is None else first
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    p = np.arange(n)
    same = (p > 0) & (before > 0)
    same[same] = text[p[same] - 1] == text[before[same] - 1]
    i = p[(before >= 0) & ~same]
    value = np.full(n, -1, np.int64)
    j, done = before[i], np.zeros(len(i), np.int64)
    active = np.arange(len(i))
    while len(active):
        a, b = i[active] + done[active], j[active] + done[active]
        room = n - np.maximum(a, b)
        diff = np.where(room > 0, key[np.minimum(a, n - 1)] ^ key[np.minimum(b, n - 1)], np.uint64(1 << 63))
        equal = np.zeros(len(active), np.int64)
        for byte in range(8):
            equal += diff < np.uint64(1 << 8 * byte)
        equal = np.minimum(equal, np.maximum(room, 0))
        done[active] += equal
        active = active[equal == 8]
    value[i] = done + i
    plcp = np.maximum(np.maximum.accumulate(np.where(value < 0, 0, value)) - p, 0)
    plcp[before < 0] = 0
    return plcp[sa]


def lower_bounds(text: np.ndarray, sa: np.ndarray, other: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each `length`-byte string of `other` at starts: whether a suffix of text begins with it.

    One binary search in the suffix array for all strings at once.
    """
    a, b = heads(text), heads(other)
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(sa), np.int64)

    def compare(slot: np.ndarray, s: np.ndarray) -> np.ndarray:
        """-1, 0, 1 as the suffix in slot is below, begins with, or is above the string."""
        out = np.zeros(len(slot), np.int64)
        active, done, pos = np.arange(len(slot)), 0, sa[slot]
        while len(active) and done < length:
            width = min(8, length - done)
            shift = np.uint64(8 * (8 - width))
            at = pos[active] + done
            x = np.where(at < len(text), a[np.minimum(at, len(text) - 1)], np.uint64(0)) >> shift
            y = b[s[active] + done] >> shift
            short = at + width > len(text)
            out[active] = np.where(x == y, np.where(short, -1, 0), np.where(x < y, -1, 1))
            active = active[(x == y) & ~short]
            done += 8
        return out

    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            break
        mid = (lo[open_] + hi[open_]) // 2
        below = compare(mid, starts[open_]) < 0
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    found = np.zeros(len(starts), bool)
    inside = np.flatnonzero(lo < len(sa))
    found[inside] = compare(lo[inside], starts[inside]) == 0
    return found


def repeated(text: np.ndarray, valid: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, suffix array): valid positions whose next `length` bytes also begin at another valid one."""
    first = heads(text)
    sa = suffix_array(text, first)
    lcp = common_prefixes(text, sa, first)
    dup = np.zeros(len(text), bool)
    v = np.flatnonzero(valid[sa])
    if len(v) > 1:
        least = np.minimum.reduceat(lcp[: v[-1] + 1], v[:-1] + 1)
        twin = np.flatnonzero(least >= length)
        dup[sa[v[twin]]] = True
        dup[sa[v[twin + 1]]] = True
    return dup, sa
