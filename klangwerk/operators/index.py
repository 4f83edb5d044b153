"""The rhyme index and its searches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klangwerk.functions import codec
from klangwerk.functions import inventory as inv
from klangwerk.functions import tokens as tk


def build_index(pronunciations: DataFrame, strict: bool = True) -> DataFrame:
    """(lang, source, word, ipa[, reference]) -> the dictionary with both keys and the fields of the first.

    strict: unknown symbols, no segment, or a key that does not restore its spelling are errors.
    """
    ref = F.col("reference") if "reference" in pronunciations.columns else F.lit(None).cast("string")
    # few bytes, much work: without a number of partitions these rows would be coalesced into a task
    parts = int(pronunciations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = pronunciations.repartition(parts, "lang", "word").withColumn("a", codec.analysis("ipa", "lang", "source", ref))
    told = told.withColumn("ipa_reversed", F.col("a.key"))
    told = told.withColumn("n__", tk.nfc("ipa"))
    engine = F.col("source").startswith("espeak")
    sounds = lambda lang: F.when(engine, tk.tokens(F.col("n__"), lang, espeak=True, normalised=True)).otherwise(tk.tokens(F.col("n__"), lang, normalised=True))
    told = told.withColumn("t__", F.coalesce(*[F.when(F.col("lang") == lang, sounds(lang)) for lang in inv.LANGUAGES]))
    told = told.withColumn("assonance_reversed", F.coalesce(*[F.when(F.col("lang") == lang, tk.assonance_key(F.col("t__"), lang)) for lang in inv.LANGUAGES]))
    if strict:
        bad = F.exists("a.issues", lambda i: i["reason"].isin("unknown", "no_segment")) | ~F.col("a.restores")
        told = told.withColumn("ok", F.assert_true(~bad, F.concat_ws(" ", F.lit("not indexable:"), "lang", "word", "ipa"))).where("ok is null")
    return told.select("lang", "source", "word", "ipa", "ipa_reversed", "assonance_reversed", F.col("a.tokens").alias("tokens"), F.col("a.segments").alias("segments"), F.col("a.issues").alias("issues"), F.col("a.evidence").alias("evidence"))


def admit(dictionary: DataFrame) -> DataFrame:
    """The dictionary, if no row repeats another's word and spelling."""
    twice = duplicates(dictionary).first()
    if twice:
        raise ValueError(f"{twice.lang}, {twice.source}: {twice.word!r} {twice.ipa!r} is there {twice['count']} times")
    return dictionary


def duplicates(pronunciations: DataFrame) -> DataFrame:
    """Repeated (word, ipa) rows: an error in an index input."""
    return pronunciations.groupBy("lang", "source", "word", "ipa").count().where("count > 1")


def prefix(key: Column, tokens: str) -> Column:
    """Rows whose key begins with whole fields; both parts are pushed to Parquet."""
    return (key == tokens) | key.startswith(f"{tokens} ")


def rhymes(index: DataFrame, tokens: str, wrapped: bool = True) -> DataFrame:
    """Plain, phonemic and phonetic entries that end in the given sounds (fields in reversed order)."""
    key, cond = F.col("ipa_reversed"), None
    for lead in ("", "/ ", "[ ") if wrapped else ("",):
        one = prefix(key, lead + tokens)
        cond = one if cond is None else cond | one
    return index.where(cond)


def assonant(index: DataFrame, vowels: str, whole: bool = True) -> DataFrame:
    """Entries with just these vowels (in reversed order), or with these last ones."""
    key = F.col("assonance_reversed")
    return index.where(key == vowels if whole else prefix(key, vowels))


def tail(key: Column, fields: int) -> Column:
    """The last sounds of a key without its wrapper, for equi-joins instead of prefix self joins."""
    parts = F.filter(F.split(key, " "), lambda x: ~x.isin("/", "[", "]"))
    return F.when(F.size(parts) >= fields, F.array_join(F.slice(parts, 1, fields), " "))


def rhyme_groups(index: DataFrame, fields: int) -> DataFrame:
    """How many words share their last sounds."""
    return index.select("lang", "word", tail(F.col("ipa_reversed"), fields).alias("tail")).where("tail is not null").groupBy("lang", "tail").agg(F.count_distinct("word").alias("words"))


def lookup(index: DataFrame, word: str) -> DataFrame:
    return index.where(F.col("word") == word)
