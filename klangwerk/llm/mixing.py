"""Operator 8: mix sources to target weights with hash-threshold histograms.

Sizes are summed by source and hash bucket; the bucket in which a source's budget runs out is the
only one refined by the next hash bits, level by level. A document is then taken by comparing its
hash with its source's threshold: one filter, no sort, and smaller budgets take subsets of larger.

Cases: null text has size 0; a null source is a source, last in order; equal rows share their hash
and are taken together; an empty table gives an empty result; kept columns named like those of the result
give way to them, others are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from klangwerk.llm.store import materialise, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
#: Hash bits used by each refinement; together 48 of 64.
LEVEL_BITS = (12, 12, 12, 12)
RESULT = ("doc_id", "size", "source_size", "target", "taken", "source")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """rows plus, for each of sums, what all rows before a row in the order sum to.

    Rows are dealt out by ranges of the order; the driver adds up one row a range, so no task holds all.
    """
    parts = materialise(rows.repartitionByRange(*order).withColumn("part__", F.spark_partition_id()), "mix-order")
    so_far, offsets = {c: 0 for c in sums}, {c: [] for c in sums}
    for r in parts.groupBy("part__").agg(*[F.sum(x).alias(c) for c, x in sums.items()]).orderBy("part__").collect():
        for c in sums:
            offsets[c] += [F.lit(r["part__"]), F.lit(so_far[c])]
            so_far[c] += r[c] or 0
    inside = Window.partitionBy("part__").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for c, x in sums.items():
        offset = F.create_map(*offsets[c])[F.col("part__")] if offsets[c] else F.lit(0)
        parts = parts.withColumn(c, F.coalesce(F.sum(x).over(inside), F.lit(0)) + offset)
    return parts.drop("part__")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> plus weight and target. Works on a row a source, never on documents.

    Sharing the excess anew until no target is above its cap is filling to one level L:
    target = least(cap * size, L * weight). In order of cap * size / weight, the capped sources are
    a leading run, so L follows from running sums.
    """
    by_source = F.col("source").asc_nulls_last()
    placed = _before(sizes, [by_source], {"place": F.lit(1)})
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = placed.withColumn("weight", w).drop("place").withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    ranked = ranked.withColumn("ratio", F.col("limit") / F.col("weight"))
    ranked = materialise(_before(ranked, [F.col("ratio").asc(), by_source], {"limits": F.col("limit"), "weights": F.col("weight")}), "mix-ranked")
    total = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    level = (F.lit((total["size"] or 0) * float(share)) - F.col("limits")) / (F.lit(total["weight"] or 0.0) - F.col("weights"))
    free = ranked.withColumn("level", level).where(F.col("limit") > F.col("level") * F.col("weight"))
    fill = free.agg(F.min(F.struct("ratio", "level"))["level"].alias("fill")).first()["fill"]
    target = F.col("limit") if fill is None else F.least("limit", F.lit(fill) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _thresholds(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds to plan each source's `cut`: documents whose hash prefix is below it are taken once more.

    One aggregation and one join on the source a level; what is refined is a single bucket a source.
    """
    prefix, state = 0, plan.withColumn("base", F.lit(0).cast("long")).withColumn("left", F.col("extra"))
    for bits in LEVEL_BITS:
        prefix += bits
        at = F.shiftrightunsigned("hash", 64 - prefix)
        inside = docs.select("source", "size", "hash")
        if prefix > bits:
            edge = state.select(F.col("source").alias("s"), F.col("base").alias("b"))
            inside = inside.join(edge, F.col("source").eqNullSafe(F.col("s"))).where(
                F.shiftrightunsigned("hash", 64 - prefix + bits) == F.col("b")
            )
        sums = inside.groupBy(F.col("source").alias("s"), at.alias("bucket")).agg(F.sum("size").alias("n"))
        run = Window.partitionBy("s").orderBy("bucket")
        met = sums.join(state.select(F.col("source").alias("s2"), F.col("left").alias("l")), F.col("s").eqNullSafe(F.col("s2")))
        met = met.withColumn("upto", F.sum("n").over(run)).where(F.col("upto") - F.col("n") <= F.col("l"))
        # the last bucket that begins within what is left holds the boundary
        edge = met.groupBy("s").agg(F.max(F.struct("bucket", (F.col("upto") - F.col("n")).alias("passed"), "n")).alias("e"))
        state = state.drop("b", "s").join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "source_size", "weight", "target", "full", "extra",
            F.coalesce(F.col("e.bucket"), F.shiftleft("base", bits)).alias("base"),
            (F.col("left") - F.coalesce(F.col("e.passed"), F.lit(0))).alias("left"),
            F.coalesce(F.col("e.n"), F.lit(0)).alias("edge_size"),
        )
        state = materialise(state, "mix-level").drop("edge_size") if prefix < sum(LEVEL_BITS) else state
    # the last bucket, as good as always a single document, goes in where that comes nearer the budget
    return state.withColumn("cut", F.col("base") + F.when(F.col("left") * 2 >= F.col("edge_size"), 1).otherwise(0))


def _hash(id_col: str) -> Column:
    return F.xxhash64(F.lit(8), F.col(id_col), F.col("text"))


def cuts(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, id_col: str = "doc_id") -> DataFrame:
    """A row a source: s (the source), source_size, target, full copies, what is left, and the hash threshold for it."""
    sized = docs.select("source", word_count(F.col("text")).alias("size"), _hash(id_col).alias("hash"))
    sized = materialise(sized, "mix-sizes")
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = materialise(
        plan.withColumn("full", ratio.cast("long")).withColumn("extra", F.col("target") - F.col("full") * F.col("source_size")),
        "mix-plan",
    )
    return materialise(_thresholds(sized, plan).select(F.col("source").alias("s"), "source_size", "target", "full", "extra", "cut"), "mix-cuts")


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, id_col: str = "doc_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of every document, and the columns in keep.

    Documents are read again and filtered in place: what is joined to them is a row a source.
    """
    of = cuts(docs, weights, share, cap, id_col).select("source_size", "target", *[F.col(c).alias(f"{c}__") for c in ("s", "full", "extra", "cut")])
    keep = tuple(c for c in keep if c not in (id_col, *RESULT))
    once_more = (F.col("extra__") > 0) & (F.shiftrightunsigned("hash__", 64 - sum(LEVEL_BITS)) < F.col("cut__"))
    base = docs.select(F.col(id_col).alias("doc_id"), "source", word_count(F.col("text")).alias("size"), _hash(id_col).alias("hash__"), *keep)
    return base.join(of, F.col("source").eqNullSafe(F.col("s__"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("full__") + once_more.cast("long"))).alias("taken"), "source", *keep,
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
