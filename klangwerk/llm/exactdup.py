"""Operator 2: remove every byte covered by a long string that also starts elsewhere, by suffix arrays.

Texts are cut into overlapping pieces such that equal strings of `length` bytes lie in pieces with the
same key: a string's key is its least 32-byte hash, a function of its content alone. Pieces whose key
occurs once hold no repeat and go no further. The others are dealt by key to shards; a shard has a
suffix array of its distinct pieces and their common prefixes. Keys with more bytes than a shard holds
have several, merged by binary search of each one's strings in the others' suffix arrays.

Cases: null text is empty; equal rows repeat each other; a row is known by its id and text together, so
repeated and null ids keep their rows apart or alike as their texts are; texts are taken as UTF-8 bytes
whole, in pieces where they are long.

Beside that, passages of over 50 words that documents share are counted, many of which are shorter than
such strings: strings of PASSAGE words (white space aside) are dealt by their least hash of RUN words in
the same way, and those that meet are compared by 64-bit hashes. They tell, and remove nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm import suffix
from klangwerk.llm import textkit as tk
from klangwerk.llm.store import bloom, in_bloom, materialise, table

LENGTH = 400
GRAM = 32
SHARD = 1 << 18
#: Bytes of text handled at once: what is made of them fits in a cache.
BLOCK = 1 << 17
_PIECE = 4 << 20
#: Words of a passage, and of the runs by whose hashes passages are dealt.
PASSAGE = 51
RUN = 8
#: Passages compared at once.
HELD = 1 << 20
_POS = np.uint64(24)
_LOW = np.uint64((1 << 24) - 1)


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum over each run of w values."""
    n = len(h)
    padded = np.full(-(-n // w) * w, np.uint64(2**64 - 1))
    padded[:n] = h
    grid = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def _windows(data: np.ndarray, offsets: np.ndarray, length: int, together: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """(first starts, ends of the starts, rows, keys, places of the first key) of runs of strings of `length` bytes inside
    rows that have their keys at the same places: of two orders' keys together, or of one order after the other."""
    gram = min(GRAM, length)
    fits = np.flatnonzero(offsets[1:] - offsets[:-1] >= length)
    if not len(fits):
        return
    h = tk.gram_hashes(data, gram)
    grams = np.arange(len(h), dtype=np.uint64)
    orders = []
    for salt in (1, 0x5851F42D4C957F2D):
        x = h * np.uint64(salt)
        marked = x & ~_LOW
        marked |= grams
        least = _least(marked, length - gram + 1)
        orders.append((x, least, np.flatnonzero(least[1:] != least[:-1]) + 1))
    edges = np.concatenate([offsets[fits], offsets[fits + 1] - length + 1])
    for some in [orders] if together else [orders[:1], orders[1:]]:
        cut = np.unique(np.concatenate([edges, *[c for _, _, c in some]]))
        b, e = cut[:-1], cut[1:]
        row = np.searchsorted(offsets, b, "right") - 1
        inside = b + length <= offsets[row + 1]
        b, e, row = b[inside], e[inside], row[inside]
        places = [(least[b] & _LOW).astype(np.int64) for _, least, _ in some]
        yield b, e, row, [x[p] for (x, _, _), p in zip(some, places)], places[0]


def _blocks(batch: pa.RecordBatch, length: int):
    """(rows of the batch, bytes, offsets, offset of each piece in its text): long texts in overlapping pieces."""
    base = 0
    for part, data, offsets in tk.blocks(batch, "text", BLOCK):
        if len(data) <= _PIECE:
            yield base + np.arange(part.num_rows), data, offsets, np.zeros(part.num_rows, np.int64)
        else:
            for r in range(part.num_rows):
                for b in range(0, max(1, int(offsets[r + 1] - offsets[r])), _PIECE):
                    e = min(int(offsets[r + 1]), int(offsets[r]) + b + _PIECE + length - 1)
                    piece = data[offsets[r] + b : e]
                    yield np.array([base + r]), piece, np.array([0, len(piece)], np.int64), np.array([b])
        base += part.num_rows


def _digests(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(sha256, bytes, row key) of each text; the key joins the id and the text."""
    data, offsets = tk.buffers(batch.column("text"))
    raw = memoryview(np.ascontiguousarray(data))
    sums = [hashlib.sha256(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    ids = batch.column("doc_id").cast(pa.int64()).fill_null(-(1 << 62)).to_numpy().view(np.uint64)
    tops = np.array([int.from_bytes(s.digest()[:8], "big") for s in sums], np.uint64)
    return [s.hexdigest() for s in sums], np.diff(offsets), tk.mix(tops ^ tk.mix(ids)).view(np.int64)


def _running(h: np.ndarray, w: int) -> np.ndarray:
    """A hash of each run of w of the hashes."""
    n = len(h)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * tk.powers(tk._P, n), out=total[1:])
    return tk.mix((total[w:] - total[: n - w + 1]) * tk.powers(tk._PINV, n)[: n - w + 1])


def _passages(batch: pa.RecordBatch, words: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of the batch, first words in their rows, hashes, keys, their places) of all strings of so many words inside rows."""
    base, run = 0, min(RUN, words)
    for part, data, offsets in tk.blocks(batch, "text", BLOCK):
        s, e, row = tk.words(data, offsets)
        all_h = tk.word_hashes(data, s, e, lower=False)
        first = np.searchsorted(row, np.arange(part.num_rows))
        for b in range(0, len(s) - words + 1, _PIECE):
            h, r = all_h[b : b + _PIECE + words - 1], row[b : b + _PIECE + words - 1]
            at = np.flatnonzero(r[: len(h) - words + 1] == r[words - 1 :])
            if len(at):
                x = _running(h, run)
                place = (_least((x & ~_LOW) | np.arange(len(x)).astype(np.uint64), words - run + 1) & _LOW).astype(np.int64)[at]
                yield base + r[at], b + at - first[r[at]], _running(h, words)[at], x[place], place
        base += part.num_rows


def _first_pass(docs: DataFrame, length: int, words: int) -> DataFrame:
    """Rows (doc_id, rid, n_bytes, sha, passages) of documents, and (key, run, c) of keys of strings and of runs of words, and how many pieces have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "rid", "n_bytes", "sha", "passages", "key", "run", "c"]

        def counted(keys: np.ndarray, of_words: bool) -> pa.RecordBatch:
            keys, counts = np.unique(keys, return_counts=True)
            none = pa.nulls(len(keys), pa.int64())
            return pa.RecordBatch.from_arrays(
                [none, none, none, pa.nulls(len(keys), pa.string()), none, pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), of_words)), pa.array(counts)], names
            )

        for batch in batches:
            passages = np.zeros(batch.num_rows, np.int64)
            for row, _, _, key, place in _passages(batch, words):
                passages += np.bincount(row, minlength=batch.num_rows)
                yield counted(key[np.concatenate([[True], (place[1:] != place[:-1]) | (row[1:] != row[:-1])])], True)
            sha, size, rid = _digests(batch)
            none = pa.nulls(len(sha), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(rid), pa.array(size), pa.array(sha, pa.string()), pa.array(passages), none, pa.nulls(len(sha), pa.bool_()), none], names
            )
            for _, data, offsets, _ in _blocks(batch, length):
                # a key counts once a place, however many strings share it
                once = [keys[0] for _, _, _, keys, _ in _windows(data, offsets, length, together=False)]
                if once:
                    yield counted(np.concatenate(once), False)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, rid long, n_bytes long, sha string, passages long, key long, run boolean, c long")


def _pieces(docs: DataFrame, length: int, words: np.ndarray) -> DataFrame:
    """(key, print, rids, starts, piece) of the runs of strings whose keys may occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = _digests(batch)[2]
            for rows, data, offsets, base in _blocks(batch, length):
                for b, e, row, (key, other), place in _windows(data, offsets, length, together=True):
                    alive = in_bloom(words, key)
                    alive[alive] = in_bloom(words, other[alive])
                    if not alive.any():
                        continue
                    b, e, row, key, place = b[alive], e[alive], row[alive], key[alive], place[alive]
                    lead = np.concatenate([[True], (place[1:] != place[:-1]) | (b[1:] != e[:-1]) | (row[1:] != row[:-1])])
                    b, e, r, k = b[lead], e[np.concatenate([lead[1:], [True]])], row[lead], key[lead].view(np.int64)
                    raw = memoryview(np.ascontiguousarray(data))
                    parts = [bytes(raw[x:y]) for x, y in zip(b.tolist(), (e + (length - 1)).tolist())]
                    prints = np.frombuffer(b"".join([hashlib.blake2b(p, digest_size=8).digest() for p in parts]), ">u8").astype(np.uint64)
                    who, at = rid[rows[r]], b - offsets[r] + base[r]
                    # equal pieces of a block go once, with all their places
                    order = np.lexsort((prints, k))
                    lead = np.ones(len(order), bool)
                    lead[1:] = (k[order][1:] != k[order][:-1]) | (prints[order][1:] != prints[order][:-1])
                    first = order[lead]
                    places = pa.array(np.append(np.flatnonzero(lead), len(order)).astype(np.int32))
                    lists = [pa.ListArray.from_arrays(places, pa.array(x[order])) for x in (who, at)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(k[first]), pa.array(prints[first].view(np.int64)), *lists, tk.binaries([parts[i] for i in first])],
                        ["key", "print", "rids", "starts", "piece"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, "key long, print long, rids array<long>, starts array<long>, piece binary")


class _Shards:
    """The distinct pieces of some keys, those of a key one after the other; `take` gives the spans to remove of those
    that occur once.

    Strings of one piece have one key at one place, and equal strings have it at one distance, so no string is twice in
    a piece, and a key that has a single piece needs no suffix array. Strings of different keys differ, so only the
    shards of a key of several are merged.
    """

    def __init__(self, length: int, shard: int):
        self.length, self.shard, self.size = length, shard, 0
        self.pieces: list[bytes] = []
        self.at: list[tuple[int, int] | None] = []
        self.begins: list[int] = []

    def key(self) -> None:
        """The pieces to come have another key."""
        if self.begins and len(self.pieces) - self.begins[-1] == 1:
            self.begins.pop()
            self.at.pop()
            self.size -= len(self.pieces.pop())
        self.begins.append(len(self.pieces))

    def add(self, piece: bytes, at: tuple[int, int] | None) -> None:
        self.pieces.append(piece)
        self.at.append(at)
        self.size += len(piece)

    def take(self) -> list[np.ndarray]:
        """[rids, begins, ends]; keys are ended by `key` first."""
        small, size, shards = [], 0, []
        for a, b in zip(self.begins, self.begins[1:]):
            total = sum(map(len, self.pieces[a:b]))
            if total > self.shard:
                shards.append(self._split(range(a, b)))
                continue
            if small and size + total > self.shard:
                shards.append([small])
                small, size = [], 0
            small.extend(range(a, b))
            size += total
        if small:
            shards.append([small])
        out = [self._repeats(groups) for groups in shards]
        self.pieces, self.at, self.begins, self.size = [], [], [0], 0
        return [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*out)] if out else []

    def _split(self, key: range) -> list[list[int]]:
        groups, size = [[]], 0
        for i in key:
            if size and size + len(self.pieces[i]) > self.shard:
                groups.append([])
                size = 0
            groups[-1].append(i)
            size += len(self.pieces[i])
        return groups

    def _repeats(self, groups: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        built = [self._build(g) for g in groups]
        for x, (_, text, _, starts, dup, _) in enumerate(built):
            for y, (_, other, sa, _, _, _) in enumerate(built):
                if x != y:
                    rest = starts[~dup[starts]]
                    dup[rest[suffix.lower_bounds(other, sa, text, rest, self.length)]] = True
        out = [(np.zeros(0, np.int64),) * 3]
        for group, _, _, _, dup, begin in built:
            hit = np.flatnonzero(dup)
            if not len(hit):
                continue
            of = np.searchsorted(begin, hit, "right") - 1
            lead = np.concatenate([[True], (np.diff(hit) > self.length) | (of[1:] != of[:-1])])
            first, last, of = hit[lead], hit[np.concatenate([lead[1:], [True]])], of[lead]
            at = [self.at[group[i]] for i in of.tolist()]
            one = np.array([x is not None for x in at])
            if one.any():
                rid, start = np.array([x for x in at if x is not None], np.int64).T
                begins = begin[of[one]]
                out.append((rid, start + first[one] - begins, start + last[one] - begins + self.length))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _build(self, group: list[int]):
        text = np.frombuffer(b"".join([self.pieces[i] for i in group]), np.uint8)
        size = np.array([len(self.pieces[i]) for i in group])
        begin = np.cumsum(size) - size
        valid = np.zeros(len(text), bool)
        for b, n in zip(begin.tolist(), size.tolist()):
            valid[b : b + n - self.length + 1] = True
        dup, sa = suffix.repeated(text, valid, self.length)
        return group, text, sa[valid[sa]], np.flatnonzero(valid), dup, begin


def _spans(pieces: DataFrame, length: int, shard: int = SHARD) -> DataFrame:
    """(rid, a, b): spans that repeats cover. Pieces come by key, equal ones together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, last_key, last_print = _Shards(length, shard), None, None

        def batches_of(spans: list) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(spans[0]) if spans else 0, 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 100_000], pa.int64()) for x in spans], ["rid", "a", "b"])

        for batch in batches:
            rids, begins, ends = whole = [], [], []
            ids, marks = (batch.column(c).to_numpy().tolist() for c in ("key", "print"))
            at = batch.column("rids").offsets.to_numpy()
            at = (at - at[0]).tolist()
            who, starts = (batch.column(c).flatten().to_numpy().tolist() for c in ("rids", "starts"))
            for key, mark, i, j, piece in zip(ids, marks, at[:-1], at[1:], batch.column("piece").to_pylist()):
                n = len(piece)
                same = key == last_key and mark == last_print and n == len(shards.pieces[-1])
                if same and shards.at[-1] is not None:
                    r, s = shards.at[-1]
                    rids.append(r)
                    begins.append(s)
                    ends.append(s + n)
                    shards.at[-1] = None
                if same or j - i > 1:
                    rids += who[i:j]
                    begins += starts[i:j]
                    ends += [s + n for s in starts[i:j]]
                if same:
                    continue
                if key != last_key:
                    shards.key()
                    if shards.size + n > shard:
                        yield from batches_of(shards.take())
                shards.add(piece, (who[i], starts[i]) if j - i == 1 else None)
                last_key, last_print = key, mark
            yield from batches_of(whole)
        shards.key()
        yield from batches_of(shards.take())

    near = pieces.repartition("key").sortWithinPartitions("key", "print")
    return near.mapInArrow(run, "rid long, a long, b long")


def _shared(docs: DataFrame, words: int, known: np.ndarray, held: int = HELD) -> DataFrame:
    """(rid, n): how many strings of so many words of a document another one holds, too; a repeated row has them repeatedly."""

    kinds = {"key": pa.int64(), "done": pa.bool_()} | {c: pa.list_(pa.int64()) for c in ("hashes", "rids", "places", "counts")}

    def shared(hashes: np.ndarray, rids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Which of the passages, in the order of their hashes and places, two documents or two equal rows hold."""
        same = hashes[1:] == hashes[:-1]
        pair = same & ((rids[1:] != rids[:-1]) | (places[1:] == places[:-1]))
        group = np.concatenate([[0], np.cumsum(~same)])
        two = np.zeros(group[-1] + 1, bool)
        two[group[1:][pair]] = True
        return two[group]

    def rows(key: np.ndarray, done: bool, *lists: np.ndarray) -> pa.RecordBatch:
        """One row a run of equal keys."""
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        at = pa.array(np.append(cut, len(key)).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(key[cut]), pa.array(np.full(len(cut), done)), *[pa.ListArray.from_arrays(at, pa.array(x)) for x in lists]], list(kinds))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row's equal passages once, with their first place and their count. Of those that two rows have at once,
        the counts are done and only one goes on, for the documents of other batches."""
        for batch in batches:
            rid, found, size = _digests(batch)[2], [], 0
            for row, at, h, key, _ in _passages(batch, words):
                alive = in_bloom(known, key)
                found.append(np.stack([key[alive].view(np.int64), h[alive].view(np.int64), row[alive], at[alive]]))
                size += found[-1].shape[1]
                if size >= held:
                    yield from combined(rid, np.concatenate(found, axis=1))
                    found, size = [], 0
            if size:
                yield from combined(rid, np.concatenate(found, axis=1))

    def combined(rid: np.ndarray, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, h, row, at = found[:, np.lexsort((found[3], found[2], found[1]))]
        lead = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])]))
        n = np.diff(np.append(lead, len(h)))
        key, h, row, at = key[lead], h[lead], row[lead], at[lead]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(first) - 1
        two = np.bincount(group)[group] > 1
        if two.any():
            rids, back = np.unique(rid[row[two]], return_inverse=True)
            sums = np.zeros(len(rids), np.int64)
            np.add.at(sums, back, n[two])
            zero = np.zeros(len(rids), np.int64)
            yield rows(rids, True, zero, rids, zero, sums)
        n[two] = 0
        order = np.flatnonzero(first)[np.argsort(key[first], kind="stable")]
        yield rows(key[order], False, h[order], rid[row[order]], at[order], n[order])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = []  # (key, hash, rid, place, count) of passages that are not compared yet
        size, met, met_key = 0, np.zeros(0, np.int64), None  # met: hashes of the key that may go on that documents share

        def settle(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(the passages, which of them documents share), in another order."""
            places = tk.mix(x[2].view(np.uint64) ^ tk.mix(x[3].view(np.uint64)))
            order = np.lexsort((places, x[1]))
            x = x[:, order]
            return x, shared(x[1], x[2], places[order]) | np.isin(x[1], met)

        def told(x: np.ndarray) -> pa.RecordBatch:
            rids, back = np.unique(x[2], return_inverse=True)
            sums = np.zeros(len(rids), np.int64)
            np.add.at(sums, back, x[4])
            return pa.RecordBatch.from_arrays([pa.array(rids), pa.array(sums)], ["rid", "n"])

        for batch in batches:
            n = np.diff(batch.column("hashes").offsets.to_numpy())
            if not len(n):
                continue
            x = np.stack([np.repeat(batch.column("key").to_numpy(), n), *[batch.column(c).flatten().to_numpy() for c in ("hashes", "rids", "places", "counts")]])
            done = np.repeat(batch.column("done").to_numpy(zero_copy_only=False), n)
            if done.any():
                yield told(x[:, done])
            x = x[:, ~done]
            if not x.shape[1]:
                continue
            rest.append(x)
            size += x.shape[1]
            if size >= held:
                end = x[0, -1]
                x, two = settle(np.concatenate(rest, axis=1))
                yield told(x[:, two])
                # what the last key has may go on
                last = x[0] == end
                met, met_key = np.union1d(met if end == met_key else met[:0], x[1][two & last]), end
                rest = [x[:, ~two & last]]
                size = 0
        if rest and sum(x.shape[1] for x in rest):
            x, two = settle(np.concatenate(rest, axis=1))
            yield told(x[:, two])

    near = docs.select("doc_id", "text").mapInArrow(candidates, "key long, done boolean, hashes array<long>, rids array<long>, places array<long>, counts array<long>")
    return near.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", shard: int = SHARD, words: int = PASSAGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages, n_shared, spans) of every document.

    n_passages: its strings of so many words; n_shared: those of them that another document holds, too.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), "text")
    told = materialise(_first_pass(docs, length, words), "repeat-keys")
    keys = told.where("key is not null").groupBy("run", "key").agg(F.sum("c").alias("c")).where("c > 1").select("run", "key")
    keys = materialise(keys, "repeat-common")
    runs, keys = keys.where("run"), keys.where("not run")
    shared = materialise(_shared(docs, words, bloom(runs, "key", runs.count())), "repeat-passages")
    words = bloom(keys, "key", keys.count())
    spans = materialise(_spans(_pieces(docs, length, words), length, shard), "repeat-spans")
    by_row = spans.groupBy("rid").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("spans"))
    by_row = materialise(by_row, "repeat-rows")
    known = bloom(by_row, "rid", by_row.count())

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = _digests(batch)[2]
            keep = pa.array(in_bloom(known, rid.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(rid).filter(keep), batch.column("text").filter(keep)], ["rid", "text"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for rid, text, spans in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw, kept, end, merged = (text or "").encode(), [], 0, []
                for s in spans:
                    if merged and s["a"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["b"])
                    else:
                        merged.append([s["a"], s["b"]])
                for a, b in merged:
                    kept.append(raw[end:a])
                    end = b
                kept.append(raw[end:])
                rows.append((rid, sum(b - a for a, b in merged), len(merged), hashlib.sha256(b"".join(kept)).hexdigest(), merged))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["rid", "n_removed", "n_spans", "kept_sha256", "spans"])

    texts = docs.mapInArrow(wanted, "rid long, text string").dropDuplicates(["rid"])
    done = texts.join(by_row, "rid").mapInArrow(cut, "rid long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>")
    rows = told.where("rid is not null").select("doc_id", "rid", "n_bytes", "sha", "passages")
    return rows.join(done, "rid", "left").join(shared, "rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.col("passages").alias("n_passages"), F.least("passages", F.coalesce("n", F.lit(0).cast("long"))).alias("n_shared"), "spans",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")
