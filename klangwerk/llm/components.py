"""Connected components of a link table by alternating large-star and small-star rounds.

Links never leave the executors. A round is two aggregations by vertex, each with map-side minima, and
its result is written to the shared folder, so lineage stays short. Up to WHOLE links, one task joins
them all: rounds of so few rows take longer to start than to run.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klangwerk.llm.store import materialise

#: The most links that one task takes whole, some 2 MB; more go in rounds. The result is the same.
WHOLE = 1 << 14


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All links (u, v) in one task -> (u, root), by union of trees whose root is the smallest vertex."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            if u != v:
                a, b = top(u), top(v)
                up[max(a, b)] = min(a, b)
    rows = [(x, r) for x in list(up) if (r := top(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(2)], ["u", "root"])


def _both(e: DataFrame) -> DataFrame:
    return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """links (u, v) -> (u, root): the smallest vertex reachable from each vertex with a link, but for roots themselves."""
    if links.limit(WHOLE + 1).count() <= WHOLE:
        return materialise(links.select("u", "v").coalesce(1).mapInArrow(_whole, "u long, root long"), "cc")
    e = materialise(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "cc")
    last = None
    while True:  # the number of rounds grows as the logarithm of the links
        # large star: a vertex's larger neighbours go to its smallest neighbour
        near = _both(e)
        # written, so that the rows of a vertex with very many links may be dealt to many tasks
        least = materialise(near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "cc-least")
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a vertex and its smaller neighbours go to the smallest of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = large.join(small, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        e = materialise(e, "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == last:
            return e.select("u", F.col("v").alias("root"))
        last = tuple(now)
