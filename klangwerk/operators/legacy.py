"""The older extraction: canonical lists without the release's headword policy."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klangwerk.functions import pronunciations as pr
from klangwerk.functions.headwords import legacy_word


@F.pandas_udf(T.BooleanType())
def non_latin_letter(text: pd.Series) -> pd.Series:
    """Whether a text has a letter whose name is neither that of a Latin nor of a modifier letter."""
    foreign = lambda c: c.isalpha() and "LATIN" not in (name := unicodedata.name(c, "")) and not name.startswith("MODIFIER LETTER")
    return text.map(lambda t: t is not None and any(map(foreign, t)))


def counts(parsed: DataFrame) -> DataFrame:
    """(lang, matched, invalid_entries, script_rejected, junk_ipa_dropped) of selected records, as extract takes them."""
    word, fields = F.col("word"), F.col("fields")
    bad = word.isNull() | (word == "") | word.rlike("[\t\r\n]")
    junk = F.size(F.filter(fields, lambda f: ~F.coalesce(f["is_text"] & pr.usable(f["value"]), F.lit(False))))
    own = parsed.where("status = 'selected'").select("lang", bad.alias("bad"), F.when(bad, 0).otherwise(junk).alias("junk"), (~bad & non_latin_letter(F.coalesce(word, F.lit("")))).alias("foreign"))
    return own.groupBy("lang").agg(
        F.count("*").alias("matched"), F.count_if("bad").alias("invalid_entries"), F.count_if("foreign").alias("script_rejected"),
        F.sum(F.when(F.col("foreign"), 0).otherwise(F.col("junk"))).alias("junk_ipa_dropped"),
    )


def extract(entries: DataFrame, normalised: bool = False, latin_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """((lang, word, ipas in order of first sight), (lang, word) without IPA)."""
    good = entries.where(F.col("word").isNotNull() & (F.col("word") != "") & ~F.col("word").rlike("[\t\r\n]"))
    good = good.where(~non_latin_letter("word")) if latin_only else good
    words = good.withColumn("w", legacy_word(F.col("word"), normalised))
    ipas = words.select("lang", "w", "archive", "line", F.posexplode("fields").alias("at", "f")).where(F.col("f.is_text") & pr.usable(F.col("f.value")))
    first = ipas.groupBy("lang", "w", F.col("f.value").alias("ipa")).agg(F.min(F.struct("archive", "line", "at")).alias("p"))
    listed = first.groupBy("lang", "w").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "ipa"))), lambda x: x["ipa"]).alias("ipas"))
    listed = listed.withColumnRenamed("w", "word")
    every = words.select("lang", F.col("w").alias("word")).distinct()
    return listed, every.join(listed, ["lang", "word"], "left_anti")
