"""New dump files as they arrive: the batch projection over a file stream that ends when all is read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from klangwerk.sources.dumps import parse, raw_entries


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of a split count from its place in the file: each has a byte at least, so none gets another's number."""
    seen: dict[tuple[int, int], int] = {}
    for t in batches:
        lines = []
        for at in zip(t["archive"], t["start"]):
            seen[at] = seen.get(at, -1) + 1
            lines.append(at[1] + seen[at])
        yield t.assign(line=lines)[["archive", "line", "value", "valid"]]


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str):
    """A file is an archive of its own, named by a number made from its path; later lines have larger numbers."""
    archive = F.crc32(F.col("_metadata.file_path")).bitwiseAND(0x7FFFFFFF).cast("int")
    valid = F.is_valid_utf8("value")
    lines = spark.readStream.text(folder).select(archive.alias("archive"), F.col("_metadata.file_block_start").alias("start"), F.when(valid, F.col("value")).alias("value"), valid.alias("valid"))
    numbered = lines.mapInPandas(_numbered, "archive int, line long, value string, valid boolean")
    writer = raw_entries(parse(numbered)).writeStream.partitionBy("lang", "has_ipa").format("parquet")
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
