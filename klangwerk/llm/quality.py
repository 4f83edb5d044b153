"""Operator 3: quality by positive-unlabelled learning.

Trusted positives and unlabelled texts train a small network to least non-negative unbiased risk (Kiryo
et al., 2017), under a class prior estimated from the density ratio of the two. Negative labels are
never used. Features are counts over whole texts: shares of kinds of bytes, of shapes of words, of
repeated words, lines and word runs, and lengths.

Cases: null and empty texts have the features of an empty text and are scored like any other; without a
positive in the sample all scores are the prior; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm import textkit as tk
from klangwerk.llm.store import table

#: Bounds of the training sample, rows.
POSITIVES, UNLABELLED = 8_000, 16_000
HIDDEN, EPOCHS = 24, 60
_KINDS = np.zeros((256, 9), bool)  # upper, lower, digit, space, newline, sentence mark, other mark, bar, high
_KINDS[65:91, 0] = _KINDS[97:123, 1] = _KINDS[48:58, 2] = True
_KINDS[[32, 9], 3] = _KINDS[10, 4] = True
_KINDS[[ord(c) for c in ".,;:'\"-()?"], 5] = True
_KINDS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{}~"], 6] = True
_KINDS[ord("|"), 7] = _KINDS[128:, 8] = True


def _sums(x: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=x, minlength=rows)


def _repeats(h: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(things, distinct things, the most frequent one's count) of each row."""
    order = np.lexsort((h, row))
    a, r = h[order], row[order]
    lead = np.ones(len(a), bool)
    lead[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(lead)
    most = np.zeros(rows)
    np.maximum.at(most, r[at], np.diff(np.append(at, len(a))))
    return np.bincount(row, minlength=rows).astype(float), np.bincount(r[at], minlength=rows).astype(float), most


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    one = np.maximum(size, 1)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    share = [_sums(_KINDS[data, k], owner, rows) / one for k in range(9)]
    twin = np.zeros(len(data), bool)
    if len(data) > 1:
        twin[1:] = (data[1:] == data[:-1]) & (_KINDS[data[1:], 6] | _KINDS[data[1:], 5]) & (owner[1:] == owner[:-1])
    s, e, row = tk.words(data, offsets)
    h = tk.word_hashes(data, s, e)
    n, distinct, most = _repeats(h, row, rows)
    word = np.maximum(n, 1)
    last, first = data[e - 1], data[s]
    two, d2, _ = _repeats(*tk.shingles(h, row, 2, rows), rows)
    four, d4, _ = _repeats(*tk.shingles(h, row, 4, rows), rows)
    breaks = np.ones(256, bool)
    breaks[10] = False
    ls, le, lrow = tk.words(data, offsets, breaks)
    lines, dl, lmost = _repeats(tk.word_hashes(data, ls, le, lower=False), lrow, rows)
    long_ = (e - s).astype(float)
    return np.stack(
        [
            *share, _sums(twin, owner, rows) / one, np.log1p(size), np.log1p(n), distinct / word, most / word,
            _sums(_KINDS[last, 6], row, rows) / word, _sums(_KINDS[last, 5], row, rows) / word, _sums(_KINDS[first, 0], row, rows) / word,
            _sums(long_, row, rows) / word, _sums(long_ * long_, row, rows) / word / 100, _sums(long_ == 1, row, rows) / word,
            d2 / np.maximum(two, 1), d4 / np.maximum(four, 1), np.log1p(lines), dl / np.maximum(lines, 1), lmost / np.maximum(lines, 1), np.log1p(n / np.maximum(lines, 1)),
        ],
        axis=1,
    )


def _featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """keep and the features, as packed doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in tk.blocks(batch, "text"):
                x = features(data, offsets)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), tk.binaries([r.tobytes() for r in x])], [*keep, "x"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, x binary")


class Model:
    """A network of one hidden layer, as plain arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: list[np.ndarray] | None, prior: float):
        self.mean, self.scale, self.weights, self.prior = mean, scale, weights, prior

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        a, b, c, d = self.weights
        return 1 / (1 + np.exp(-np.clip(np.tanh(z @ a + b) @ c + d, -30, 30)))


def _train(x: np.ndarray, gradient, rng: np.random.Generator, epochs: int, split: int) -> list[np.ndarray]:
    """Adam on batches of the rows before and from split; gradient(scores, n) is that of the loss by score."""
    w = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), np.zeros(())]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    batches = max(1, len(x) // 512)
    for _ in range(epochs):
        p, u = rng.permutation(split), split + rng.permutation(len(x) - split)
        for own, other in zip(np.array_split(p, batches), np.array_split(u, batches)):
            if not len(own) or not len(other):
                continue
            z = x[np.concatenate([own, other])]
            hidden = np.tanh(z @ w[0] + w[1])
            g = gradient(hidden @ w[2] + w[3], len(own))
            back = np.outer(g, w[2]) * (1 - hidden**2)
            grads = [z.T @ back + 1e-4 * w[0], back.sum(axis=0), hidden.T @ g + 1e-4 * w[2], g.sum()]
            step += 1
            for i, d in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(s: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    if not len(positive) or not len(unlabelled):
        return Model(mean, scale, None, 0.5)
    z, rng, k = np.clip((both - mean) / scale, -8, 8), np.random.default_rng(3), len(positive)

    if prior is None:
        # how much denser positives are than all texts where they are densest: 1 / prior
        def ratio(s: np.ndarray, n: int) -> np.ndarray:
            p = _sigmoid(s)
            return np.concatenate([(p[:n] - 1) / n, p[n:] / (len(s) - n)]) / 2

        a, b, c, d = _train(z, ratio, rng, 15, k)
        f = _sigmoid(np.tanh(z @ a + b) @ c + d)
        ratio_p = f[:k] / (1 - f[:k])
        prior = float(np.clip(1 / np.quantile(ratio_p, 0.75), 0.05, 0.95))

    def risk(s: np.ndarray, n: int) -> np.ndarray:
        """Gradient of prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) for the logistic loss."""
        p = _sigmoid(s)
        loss_minus = np.logaddexp(0, np.clip(s, -30, 30))
        rest = loss_minus[n:].mean() - prior * loss_minus[:n].mean()
        g = np.concatenate([-prior * p[:n] / n, p[n:] / (len(s) - n)])
        if rest < 0:
            return -g  # the risk of negatives can't be below zero: step back from what overfits it
        g[:n] += prior * (p[:n] - 1) / n
        return g

    return Model(mean, scale, _train(z, risk, rng, EPOCHS, k), prior)


def _share(name: str, most: int, count: int, *columns: str):
    spot = F.pmod(F.xxhash64(F.lit(name), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return spot < min(1.0, most / max(1, count))


def _sample(docs: DataFrame) -> list[np.ndarray]:
    """The features of a bounded sample, equal rows once, in an order that reruns keep."""
    rows = _featured(docs.select("doc_id", "text"), ["doc_id"]).distinct().orderBy("doc_id", "x")
    return [np.frombuffer(r["x"], np.float64) for r in rows.select("x").collect()]


def learn(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """docs (doc_id, text) are the unlabelled texts; of labels, rows of quality 1 name the positives."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    n_good, n_docs = good.count(), docs.count()
    picked = F.broadcast(good.where(_share("p", positives, n_good, "doc_id")))
    # ids may repeat: of the documents that have them, again no more than the bound
    theirs = docs.join(picked, "doc_id", "left_semi")
    n_theirs = docs.select("doc_id").join(picked, "doc_id", "left_semi").count()
    x = _sample(theirs.where(_share("q", positives, n_theirs, "doc_id", "text")))
    y = _sample(docs.where(_share("u", unlabelled, n_docs, "doc_id", "text")))
    width = len(features(np.zeros(0, np.uint8), np.zeros(2, np.int64))[0])
    return fit(np.array(x).reshape(-1, width), np.array(y).reshape(-1, width))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """keep, score and predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in tk.blocks(batch, "text"):
                p = model(features(data, offsets))
                cols = [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *cols], [*keep, "score", "predicted"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    model = learn(docs.where(~out).select("doc_id", "text"), labels.where(~out))
    return score(docs.select("doc_id", out.alias("held_out"), "text"), model, ["doc_id", "held_out"])
