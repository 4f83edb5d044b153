"""Operator 4: benchmark decontamination by shared runs of words and exact edit checks.

Texts are words: runs of letters and digits in lower case, and single characters of scripts without
spaces. An edit breaks at most q of the n - q + 1 runs of q words that an item of n words has, so a part
of a text within k edits of it holds n - q + 1 - q * k of them or more, and they start at most k places
apart from where the item's start would be. Places with so many are checked exactly by edit distance in
words, with free ends. That loses no match, whatever the length of the item and the kind of the edits;
runs have GRAM words, or fewer where that leaves none.

This takes the place of a CGK embedding with sampled LSH keys, which missed long passages with many edits.

Cases: null and empty texts match nothing; items of fewer than MIN_WORDS words are too short to tell a
leak and match nothing; a repeated document is found each time; an item block of any number is handled,
as the benchmark is read in blocks of bounded size, a pass over the documents each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm import textkit as tk
from klangwerk.llm.store import table

SIMILARITY = 0.8
GRAM = 3
MIN_WORDS = 5
#: Bytes of item texts that go to executors at once.
ITEM_BYTES = 16 << 20


def allowed(n: int, similarity: float) -> int:
    """How many edits an item of n words may have."""
    return int(n * (1 - similarity) + 1e-9)


def needed(n: int, most: int) -> tuple[int, int]:
    """(length of runs, how many of an item's runs any match within `most` edits holds, at least one)."""
    for q in range(GRAM, 0, -1):
        if (runs := n - q + 1 - q * most) > 0:
            return q, runs
    return 1, 1


def edits(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Least edits, in words, from item to any part of each row of text; rows are padded with 0."""
    n, m = text.shape
    before = np.zeros((n, m + 1), np.int32)
    j = np.arange(m + 1, dtype=np.int32)
    for i, w in enumerate(item):
        now = np.empty_like(before)
        now[:, 0] = i + 1
        np.minimum(before[:, :-1] + (text != w), before[:, 1:] + 1, out=now[:, 1:])
        before = np.minimum.accumulate(now - j, axis=1) + j  # insertions: one more a place to the right
    return before.min(axis=1)


class Items:
    """A block of items: their words, the edits each may have and the places of their runs of words."""

    def __init__(self, rows: list[tuple[int, str]], similarity: float = SIMILARITY):
        self.ids, self.words = [], []
        for item_id, text in rows:
            data = np.frombuffer((text or "").encode(), np.uint8)
            s, e, _ = tk.words(data, np.array([0, len(data)]), tk.ALNUM, characters=True)
            if len(s) >= MIN_WORDS:
                self.ids.append(item_id)
                self.words.append(tk.word_hashes(data, s, e))
        self.most = np.array([allowed(len(w), similarity) for w in self.words], np.int64)
        told = [needed(len(w), m) for w, m in zip(self.words, self.most.tolist())]
        self.runs = np.array([n for _, n in told], np.int64)
        self.tables = {}
        for q in {q for q, _ in told}:
            own = [i for i, t in enumerate(told) if t[0] == q]
            grams = [tk.shingles(self.words[i], np.zeros(len(self.words[i]), np.int64), q, 1)[0] for i in own]
            g = np.concatenate(grams)
            order = np.argsort(g, kind="stable")
            item, offset = np.repeat(own, [len(x) for x in grams]), np.concatenate([np.arange(len(x)) for x in grams])
            self.tables[q] = g[order], item[order], offset[order]

    def _candidates(self, words: np.ndarray, row: np.ndarray, begin: np.ndarray, q: int) -> np.ndarray:
        """(item, first word, row, runs that lie just there) of the places where an item of runs of q has as many runs as a match needs."""
        none = np.zeros((0, 4), np.int64)
        grams, items, offsets = self.tables[q]
        g, at = tk.shingles(words, row, q, int(row[-1]) + 1)
        counts = np.diff(begin)
        # shingles of a row come in order of their words, q - 1 fewer than words
        full = counts[at] >= q
        g, at = g[full], at[full]
        runs = np.maximum(counts - q + 1, 0)
        pos = np.arange(len(g)) - (np.cumsum(runs) - runs)[at] + begin[:-1][at]
        lo, hi = np.searchsorted(grams, g), np.searchsorted(grams, g, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return none
        n = (hi - lo)[hit]
        which = np.repeat(lo[hit], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item, r, start = items[which], np.repeat(at[hit], n), np.repeat(pos[hit], n) - offsets[which]
        # one number a (row, item, start), in order; starts of a match differ by its edits at most
        reach = len(words) + 2 * max(len(w) for w in self.words)
        _, pair = np.unique(r * len(self.words) + item, return_inverse=True)
        key = pair * (2 * reach) + start + reach // 2
        order = np.argsort(key, kind="stable")
        key, item, r, start = key[order], item[order], r[order], start[order]
        first = np.searchsorted(key, key)
        near = np.searchsorted(key, key + self.most[item], "right") - first
        pick = np.flatnonzero((near >= self.runs[item]) & (first == np.arange(len(key))))
        if not len(pick):
            return none
        return np.stack([item[pick], start[pick], r[pick], np.searchsorted(key, key[pick], "right") - pick], 1)

    def matches(self, words: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, edits, runs missing just there, first word) of verified windows."""
        if not len(words) or not self.tables:
            return
        begin = np.searchsorted(row, np.arange(int(row[-1]) + 2))
        cand = np.concatenate([self._candidates(words, row, begin, q) for q in self.tables])
        for i in np.unique(cand[:, 0]):
            mine, w, most = cand[cand[:, 0] == i], self.words[i], int(self.most[i])
            a, z = np.maximum(begin[mine[:, 2]], mine[:, 1] - most), np.minimum(begin[mine[:, 2] + 1], mine[:, 1] + len(w) + most)
            span = np.arange(len(w) + 3 * most)
            for b in range(0, len(mine), 4096):
                at_ = a[b : b + 4096, None] + span
                text = np.where(at_ < z[b : b + 4096, None], words[np.minimum(at_, len(words) - 1)], np.uint64(0))
                d = edits(w, text)
                for j in np.flatnonzero(d <= most):
                    r = mine[b + j, 2]
                    yield int(r), int(i), int(d[j]), -int(mine[b + j, 3]), max(0, int(mine[b + j, 1] - begin[r]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, start_word, edits, n_words): each document's best window for each item it holds."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // ITEM_BYTES))
    out = None
    for b in range(blocks):
        rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        if blocks > 1:
            rows = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found = _find(docs, Items([(r["item_id"], r["text"]) for r in rows.select("item_id", "text").toLocalIterator()], similarity), id_col)
        out = found if out is None else out.union(found)
    return out


def _find(docs: DataFrame, items: Items, id_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in tk.blocks(batch, "text"):
                s, e, row = tk.words(data, offsets, tk.ALNUM, characters=True)
                best: dict[tuple[int, int], tuple[int, int, int]] = {}
                for r, i, *found in items.matches(tk.word_hashes(data, s, e), row):
                    best[r, i] = min(best.get((r, i), tuple(found)), tuple(found))
                if best:
                    ids = part.column("doc_id").to_pylist()
                    got = [(ids[r], items.ids[i], start, d, len(items.words[i])) for (r, i), (d, _, start) in sorted(best.items())]
                    yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], pa.int64()) for c in range(5)], ["doc_id", "item_id", "start_word", "edits", "n_words"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, item_id long, start_word long, edits long, n_words long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
