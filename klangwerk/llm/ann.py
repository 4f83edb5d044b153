"""Operator 5: nearest neighbours by inner product from randomly rotated one-bit codes.

Vectors are dealt to lists by the nearest of a bounded set of centroids. What is left after the centroid
is rotated at random and kept as a bit a dimension with correction scalars; from packed bits the inner
product with a query is estimated together with an error bound, and only vectors whose upper bound
reaches the 20th best lower bound are reranked exactly, in double precision.

Lists are searched in two rounds. The first takes the PROBES most promising lists; the 20th best score
found there is a floor under the true one. The second takes every other list that could reach the floor:
by the list's centroid and farthest vector, so no list that holds a neighbour is left out.

Lists are laid on shelves of equal size and queries cut into blocks, so no task holds much more than
PART vectors and QUERIES queries whatever one list or one repeated vector weighs.

Cases: vectors that are null, zero or hold null or non-finite components take no part, nor do those
whose length is not the most common one; repeated vectors tie and the smaller id wins; fewer candidates
than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from klangwerk.llm.store import materialise, table

K = 20
#: The centroids are fitted on this many vectors at most; every vector is indexed.
SAMPLE = 20_000
#: Lists of the first round; the second takes all that can still matter.
PROBES = 24
PART = 16_384
QUERIES = 2_048
NONE = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
#: Width of the error bound in standard errors of the estimate.
EPS = 3.0


def clean(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, ok) & F.exists(v, lambda x: x != 0)
    return vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(5).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit(vectors: DataFrame, n: int) -> np.ndarray:
    """Centroids by k-means on a bounded sample, about a list for each sqrt(n) vectors."""
    spot = F.pmod(F.xxhash64(F.lit(5), "vec_id", "v"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = vectors.where(spot < min(1.0, SAMPLE / max(1, n))).select("vec_id", "v").distinct().orderBy("vec_id", "v").select("v").toPandas()
    x = np.array(rows["v"].tolist())
    if not len(x):
        x = np.array(vectors.limit(1).toPandas()["v"].tolist())
    rng = np.random.default_rng(5)
    k = int(np.clip(round(np.sqrt(n) / 2), 1, min(4096, len(x))))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(12):
        own = nearest(x, c, 1)[:, 0]
        sums, counts = np.zeros_like(c), np.bincount(own, minlength=k)
        np.add.at(sums, own, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def nearest(x: np.ndarray, c: np.ndarray, m: int) -> np.ndarray:
    d = (c * c).sum(axis=1)[None, :] - 2 * x @ c.T
    return np.argpartition(d, m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(len(c)), (len(x), 1))


def encode(x: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, length of the rest, inner product of the code with the unit rest)."""
    rest = (x - centroid) @ turn
    size = np.linalg.norm(rest, axis=1)
    bits = rest >= 0
    fit_ = np.abs(rest).sum(axis=1) / (np.sqrt(x.shape[1]) * np.where(size > 0, size, 1))
    return np.packbits(bits, axis=1), size, np.where(size > 0, fit_, 1.0)


def estimate(codes: np.ndarray, size: np.ndarray, fit_: np.ndarray, q: np.ndarray, centroid: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(estimated inner products, error bounds): a row a query, a column a code."""
    dim = q.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = q @ turn
    along = (turned.astype(np.float32) @ signs.T) / np.sqrt(dim) / fit_[None, :]
    norm = np.linalg.norm(turned, axis=1)[:, None]
    error = norm * size[None, :] * np.sqrt(np.maximum(0.0, 1 - fit_**2)) / fit_ * EPS / np.sqrt(max(1, dim - 1))
    return (q @ centroid)[:, None] + size[None, :] * along, error + 1e-4 * (norm * size[None, :] + 1)


def _search(ids: np.ndarray, x: np.ndarray, codes: np.ndarray, size: np.ndarray, fit_: np.ndarray, centroid: np.ndarray, turn: np.ndarray, qid: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> pd.DataFrame:
    """The best k of one list for each query; scores under a query's floor are of no use to it."""
    out = []
    for b in range(0, len(q), 64):
        est, err = estimate(codes, size, fit_, q[b : b + 64], centroid, turn)
        for r in range(len(est)):
            low, high = est[r] - err[r], est[r] + err[r]
            own = ids == qid[b + r]
            low[own] = high[own] = -np.inf
            m = len(ids) - int(own.sum())
            least = np.partition(low, len(low) - k)[len(low) - k] if m > k else -np.inf
            pick = np.flatnonzero((high >= max(least, floor[b + r])) & ~own)
            score = (x[pick] * q[b + r]).sum(axis=1)
            best = np.lexsort((ids[pick], -score))[:k]
            out.append(pd.DataFrame({"query_id": qid[b + r], "vec_id": ids[pick][best], "score": score[best]}))
    return pd.concat(out) if out else NONE


def search(vectors: DataFrame, queries: DataFrame, k: int = K, probes: int = PROBES) -> DataFrame:
    """(query_id, rank, vec_id, score): both inputs are (vec_id, v); a query is no candidate of its own."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim, n = sizes["d"], sizes["count"]
    vectors, queries = vectors.where(F.size("v") == dim), queries.where(F.size("v") == dim)
    c, turn = fit(vectors, n), rotation(dim)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            if not len(t):
                continue
            x = np.array(t["v"].tolist())
            own = nearest(x, c, 1)[:, 0]
            codes, size, fit_ = encode(x, c[own], turn)
            yield pd.DataFrame({"list": own, "vec_id": t["vec_id"].to_numpy(), "v": list(x), "code": [r.tobytes() for r in codes], "size": size, "fit": fit_})

    indexed = materialise(vectors.mapInPandas(index, "list int, vec_id long, v array<double>, code binary, size double, fit double"), "ann-index")
    held = {r["list"]: r for r in indexed.groupBy("list").agg(F.count("*").alias("n"), F.avg("size").alias("s"), F.max("size").alias("far")).collect()}  # a row a centroid
    of = lambda name, none: np.array([held[i][name] if i in held else none for i in range(len(c))])
    count, spread, far = of("n", 0), of("s", -np.inf) * 0.25, of("far", -np.inf)
    # lists lie one behind the other on shelves of equal numbers of vectors, whatever one list holds
    shelf = int(np.clip(-(-n // (2 * spark.sparkContext.defaultParallelism)), 1024, PART))
    begin = np.cumsum(count) - count
    first, last = begin // shelf, (begin + np.maximum(count, 1) - 1) // shelf
    number = queries.count()
    blocks = max(1, -(-number // QUERIES))

    def reach(x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """What a list's vectors can reach at most, were all as far out as radius and in the query's direction."""
        return x @ c.T + np.linalg.norm(x, axis=1)[:, None] * radius[None, :]

    def nearby(x: np.ndarray) -> np.ndarray:
        m = min(probes, len(c))
        asked = np.zeros((len(x), len(c)), bool)
        np.put_along_axis(asked, np.argpartition(-reach(x, spread), m - 1, axis=1)[:, :m] if m < len(c) else np.tile(np.arange(len(c)), (len(x), 1)), True, axis=1)
        return asked & (count > 0)

    def probe(rest: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for t in batches:
                if not len(t):
                    continue
                x, floor = np.array(t["v"].tolist()), t["floor"].to_numpy()
                asked = nearby(x)
                if rest:
                    # no vector of another list gets to the floor: the inner product with what is left after the centroid is at most that of the lengths
                    most = reach(x, far)
                    asked = ~asked & (count > 0) & (most + 1e-9 * (np.abs(most) + 1) >= floor[:, None])
                shelves = [sorted({s for i in np.flatnonzero(a) for s in range(first[i], last[i] + 1)}) for a in asked]
                row = np.repeat(np.arange(len(x)), [len(s) for s in shelves])
                if not len(row):
                    continue
                packed = [r.tobytes() for r in np.packbits(asked, axis=1)]
                yield pd.DataFrame({"shelf": [i for s in shelves for i in s], "query_id": t["vec_id"].to_numpy()[row], "q": [x[i] for i in row], "floor": floor[row], "asked": [packed[i] for i in row]})

        return run

    def group(v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(v) or not len(q):
            return NONE
        v = v.sort_values("list", kind="stable")
        ids, x, lists = v["vec_id"].to_numpy(), np.array(v["v"].tolist()), v["list"].to_numpy()
        codes, size, fit_ = np.frombuffer(b"".join(v["code"]), np.uint8).reshape(len(v), -1), v["size"].to_numpy(), v["fit"].to_numpy()
        qid, y, floor = q["query_id"].to_numpy(), np.array(q["q"].tolist()), q["floor"].to_numpy()
        asked = np.unpackbits(np.frombuffer(b"".join(q["asked"]), np.uint8).reshape(len(q), -1), axis=1, count=len(c)).astype(bool)
        out = []
        for i in np.unique(lists):
            a, z = np.searchsorted(lists, i), np.searchsorted(lists, i, "right")
            of = np.flatnonzero(asked[:, i])
            if len(of):
                out.append(_search(ids[a:z], x[a:z], codes[a:z], size[a:z], fit_[a:z], c[i], turn, qid[of], y[of], floor[of], k))
        return pd.concat(out) if out else NONE

    deal = lambda i, m: F.pmod(F.xxhash64(i), m)
    at = lambda xs: F.element_at(F.array(*[F.lit(int(i)) for i in xs]), F.col("list") + 1)
    placed = indexed.withColumn("shelf", F.floor((at(begin) + deal("vec_id", at(np.maximum(count, 1)))) / shelf).cast("int"))
    left = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    keys = ["shelf", "block"]

    def round_(asking: DataFrame, rest: bool) -> DataFrame:
        probed = asking.mapInPandas(probe(rest), "shelf int, query_id long, q array<double>, floor double, asked binary")
        right = probed.withColumn("block", deal("query_id", F.lit(blocks)).cast("int"))
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(group, "query_id long, vec_id long, score double")

    best = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    near = materialise(best(round_(queries.withColumn("floor", F.lit(float("-inf"))), False)), "ann-near")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor")).distinct()
    asking = queries.join(floors, "vec_id", "left").select("vec_id", "v", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))
    return best(near.select("query_id", "vec_id", "score").union(round_(asking, True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = clean(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where(F.col("vec_id") % 20 == 0))
