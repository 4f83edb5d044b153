"""The corpus pipeline: five stages over documents, each written as Parquet and read by the next.

Rows whose doc_id is null can't be named by a later stage's decisions: stages that decide by id keep
them. n_chars follows the text where a stage changes it. Columns beside those of documents pass through
the stages under names that no operator uses; only those named like a column of the mix give way to it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm import decontam, jaccard, langid, linededup, mixing
from klangwerk.llm.store import materialise, table
from klangwerk.session import ship


#: What near_duplicates takes for a copy. op6_jaccard_join has limits of its own.
WORDS, PERCENT = 5, 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, with other columns than those of documents renamed while it runs."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: c if c in COLUMNS else f"aside{i}__" for i, c in enumerate(docs.columns)}
        back = {new: c for c, new in names.items()}
        out = stage(spark, docs.select(*[F.col(f"`{c}`").alias(new) for c, new in names.items()]), sf_dir)
        kept = [c for c in out.columns if c in COLUMNS or c not in back or back[c] not in out.columns]
        return out.select(*[F.col(c).alias(back.get(c, c)) for c in kept])

    return run_stage


@_aside
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those rejected go."""
    ship(spark)
    found = langid.identify(docs, langid.learn(docs))
    return found.where(~F.col("rejected")).select(*docs.columns)


@_aside
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that spread over many sites; those of such lines only are whole copies and stay for the next stage."""
    out = linededup.line_dedup(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


@_aside
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingles alike to 80 %: the one with the smallest id. Repeated rows count once; rows without an id and words all stay."""
    ship(spark)
    groups = jaccard.near_duplicates(docs, k=WORDS, percent=PERCENT).where("component_id <> doc_id").select("doc_id").distinct()
    left = docs.join(groups, "doc_id", "left_anti").withColumn("text__", F.xxhash64("text"))
    # a row without an id and words is a copy of none, unless all its columns are the same
    wordless = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    left = left.withColumn("row__", F.when(wordless, F.xxhash64(*docs.columns)))
    return left.dropDuplicates(["doc_id", "text__", "row__"]).select(*docs.columns)


@_aside
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    leaks = decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(materialise(leaks.select("doc_id").distinct(), "leaks"), "doc_id", "left_anti").select(*docs.columns)


@_aside
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many words of each: `taken` over `size` is the number of copies."""
    keep = tuple(c for c in docs.columns if c not in mixing.RESULT)
    return mixing.mix(docs, keep=keep).where("taken > 0")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
