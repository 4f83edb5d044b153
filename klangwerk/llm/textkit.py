"""Vectorised text primitives over Arrow string buffers: words, word hashes and shingles.

Hashes are functions of bytes alone, so the same text hashes alike on every executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text handled at once; a longer single text is a block of its own.
BLOCK = 1 << 20
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_P, _PINV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_tables: dict[int, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: True for bytes of a word: anything but space, \t, \n, \v, \f, \r.
WORDISH = np.ones(256, dtype=bool)
WORDISH[[32, 9, 10, 11, 12, 13]] = False
#: True for ASCII letters and digits and every byte of a multi-byte character.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Scripts without spaces, by the first two bytes of their characters: Thai and Lao, Myanmar, Khmer, kana, ideographs.
SPACELESS = ((0xE0B8, 0xE0BB), (0xE180, 0xE181), (0xE19E, 0xE19F), (0xE381, 0xE383), (0xE390, 0xE9BF), (0xEFA4, 0xEFAB), (0xF0A0, 0xF0B3))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _tables.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = U(base)
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:
            _tables[base] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(31))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(27))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(batch: pa.RecordBatch, column: str, block: int = BLOCK) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with their text bytes and offsets, about `block` bytes each."""
    data, offsets = buffers(batch.column(column))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, "right")) - 1)
        j = min(j, n)
        yield batch.slice(i, j - i), data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def _spaceless(data: np.ndarray) -> np.ndarray:
    """Where the characters of scripts without spaces begin."""
    at = np.flatnonzero(data >= 0xE0)
    lead = data[at].astype(np.int32) << 8 | data[np.minimum(at + 1, len(data) - 1)]
    found = np.zeros(len(at), bool)
    for a, b in SPACELESS:
        found |= (lead >= a) & (lead <= b)
    return at[found]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORDISH, characters: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of `kind` bytes; runs never cross rows.

    With `characters`, each character of a script without spaces is a word.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = kind[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = offsets[:-1], offsets[1:]
    full = end > begin
    first[begin[full]] |= inside[begin[full]]
    last[end[full] - 1] |= inside[end[full] - 1]
    if characters and len(at := _spaceless(data)):
        for cut in (at, at + np.where(data[at] >= 0xF0, 4, 3)):
            cut = cut[(cut > 0) & (cut < n)]
            first[cut] |= inside[cut]
            last[cut - 1] |= inside[cut - 1]
    s = np.flatnonzero(first)
    return s, np.flatnonzero(last) + 1, np.searchsorted(offsets, s, "right") - 1


def _range_hash(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    h = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_P, len(data)), out=h[1:])
    return mix((h[e] - h[s]) * powers(_PINV, len(data) + 1)[s] + (e - s).astype(np.uint64))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of each run of so many bytes."""
    h = np.zeros(len(data) + 1, dtype=np.uint64)
    x = _BYTE[data]
    x *= powers(_P, len(data))
    np.cumsum(x, out=h[1:])
    x = h[gram:] - h[:-gram]
    x *= powers(_PINV, len(x))
    x += U(gram)
    return mix(x)


def word_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each byte range; ranges are ascending and disjoint."""
    if lower:
        data = LOWER[data]
    if len(data) <= 2 * BLOCK or not len(s):
        return _range_hash(data, s, e)
    out, i = np.empty(len(s), np.uint64), 0
    while i < len(s):  # a very long text: by pieces, cut between ranges
        j = max(i + 1, int(np.searchsorted(s, s[i] + BLOCK)))
        base = s[i]
        out[i:j] = _range_hash(data[base : e[j - 1]], s[i:j] - base, e[i:j] - base)
        i = j
    return out


def shingles(h: np.ndarray, row: np.ndarray, k: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of k words of a row; a row of fewer words gives its whole sequence once."""
    c = U(0xD6E8FEB86659FD93)
    out, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(h) >= k:
        ok = row[: len(h) - k + 1] == row[k - 1 :]
        acc = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            acc = acc * c + h[i : len(h) - k + 1 + i]
        out, at = mix(acc[ok]), row[: len(acc)][ok]
    counts = np.bincount(row, minlength=rows)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(counts)])
        extra = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = counts[short] > i
            extra[has] = extra[has] * c + h[begin[short[has]] + i]
        out = np.concatenate([out, mix(extra + counts[short].astype(np.uint64) * U(0x9FB21C651E98DF25))])
        at = np.concatenate([at, short])
        order = np.argsort(at, kind="stable")
        out, at = out[order], at[order]
    return out, at


def split_rows(values: np.ndarray, row: np.ndarray, rows: int) -> list[np.ndarray]:
    """The values of each row; row is ascending."""
    cut = np.searchsorted(row, np.arange(1, rows))
    return np.split(values, cut) if rows else []


def binaries(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, type=pa.binary())
