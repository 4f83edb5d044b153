"""Shared-folder helpers: every intermediate table goes where all executors can read it."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest Bloom filter sent to executors, in bits (16 MiB). A fuller filter only lets more rows through.
BLOOM_BITS = 1 << 27


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where a local session names none."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="klangwerk-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, tag: str) -> None:
    """Delete the tables materialised under tag/: for those that nothing still to be run reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{tag}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A key with more than one in HOT of the rows is joined by broadcast: there are HOT such keys at most.
HOT = 64


def hot_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left left-joined with right, which has a key once: rows of a key that holds much of left stay where they are."""
    counts = left.groupBy(key).agg(F.count("*").alias("c"))
    total = left.count()
    hot = [r[0] for r in counts.where(F.col("c") * HOT > total).select(key).collect() if r[0] is not None]
    if not hot:
        return left.join(right, key, "left")
    of = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(of).join(F.broadcast(right.where(of)), key, "left").unionByName(left.where(~of).join(right.where(~of), key, "left"))


def bloom(keys: DataFrame, column: str, expected: int) -> np.ndarray:
    """A two-probe Bloom filter over the long column: 12 bits a key, BLOOM_BITS at most.

    The words are or-ed on executors; the driver gets the filter alone, which the bound holds.
    """
    bits = 1 << int(np.clip(np.ceil(np.log2(max(1, expected) * 12)), 16, np.log2(BLOOM_BITS)))
    k = F.col(column)
    spots = F.explode(F.array(k.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(k, 32).bitwiseAND(F.lit(bits - 1))))
    words = (
        keys.select(spots.alias("p"))
        .groupBy(F.shiftrightunsigned("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    )
    out = np.zeros(bits // 64, dtype=np.int64)
    got = words.toArrow()
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint64)


def in_bloom(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the uint64 keys may be in the filter."""
    mask = np.uint64(len(words) * 64 - 1)
    hit = np.ones(len(keys), dtype=bool)
    for p in (keys & mask, (keys >> np.uint64(32)) & mask):
        hit &= (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return hit
