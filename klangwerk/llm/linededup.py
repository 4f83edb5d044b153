"""Operator 10: drop lines that spread over many sites.

A HyperLogLog sketch of the sites of each line hash is merged by aggregation, so a line that holds a
third of all rows still sends one small sketch a task. Estimates that are near the threshold are
replaced by exact distinct counts. A line that reaches the threshold is cut from every document but
those of which every line does: they are copies of a whole, which are left to the near-duplicate operator.

Cases: null text has no lines and stays null; blank lines never count and stay; a null site counts
for no line; repeated rows and ties change nothing, as a line's fate depends on its content alone;
columns named lines_total or lines_removed give way to those of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm.store import materialise, table

MIN_SITES = 10
#: 2**8 registers: a standard error of 6.5 %; the exact band is over three of them wide.
LG_K = 8
BAND = 0.25


def _line(x: Column) -> Column:
    return F.trim(x)


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, site_col: str = "source") -> DataFrame:
    """The hashes of the lines with at least min_sites distinct sites."""
    lines = docs.select(F.col(site_col).alias("site"), F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.where(F.col("site").isNotNull() & (_line(F.col("line")) != "")).select("site", F.xxhash64(_line(F.col("line"))).alias("h"))
    spread = lines.groupBy("h").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    spread = materialise(spread.where(F.col("sites") >= min_sites * (1 - BAND)), "line-spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + BAND)).select("h")
    exact = lines.join(near, "h").groupBy("h").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    sure = spread.where(F.col("sites") > min_sites * (1 + BAND))
    return materialise(sure.select("h").union(exact.select("h")), "line-boilerplate")


def line_dedup(
    docs: DataFrame, min_sites: int = MIN_SITES, id_col: str = "doc_id", site_col: str = "source"
) -> DataFrame:
    """docs with `text` cut, plus lines_total and lines_removed."""
    docs = docs.drop("lines_total", "lines_removed")
    common = boilerplate(docs, min_sites, site_col)
    own = docs.select(F.col(id_col).alias("id__"), F.explode(F.split("text", "\n")).alias("line"))
    own = own.select("id__", F.xxhash64(_line(F.col("line"))).alias("h"))
    hits = own.join(common, "h", "left_semi").groupBy("id__").agg(F.collect_set("h").alias("hits__"))
    met = docs.join(hits, F.col(id_col).eqNullSafe(F.col("id__")), "left")
    lines = F.split("text", "\n")
    out = lambda x: (_line(x) != "") & F.array_contains("hits__", F.xxhash64(_line(x)))
    touched = F.col("hits__").isNotNull()
    cut = met.withColumn("gone__", F.when(touched, F.filter(lines, out)))
    own_line = F.exists(lines, lambda x: (_line(x) != "") & ~out(x))
    cut = cut.withColumn("cut__", F.coalesce(touched & own_line, F.lit(False)))
    kept = F.array_join(F.filter(lines, lambda x: ~out(x)), "\n")
    return cut.select(
        *[(F.when(F.col("cut__"), kept).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c)) for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("lines_total"),
        F.when(F.col("cut__"), F.size("gone__")).otherwise(0).cast("long").alias("lines_removed"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "lines_total", "lines_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = f"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t, text IS NULL AS gone FROM documents),
lines AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM docs WHERE NOT gone),
wide AS (SELECT trim(line, ' ') AS line FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (SELECT l.*, w.line IS NOT NULL AS hit FROM lines l LEFT JOIN wide w ON trim(l.line, ' ') = w.line),
sums AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (hit) AS cut, count(*) FILTER (NOT hit AND trim(line, ' ') <> '') AS own,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS kept
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS lines_total,
  CAST(CASE WHEN own > 0 THEN cut ELSE 0 END AS BIGINT) AS lines_removed,
  sha256(CASE WHEN own > 0 THEN kept ELSE t END) AS kept_sha256
FROM docs d LEFT JOIN sums s USING (doc_id)
"""
