"""Repair, comparison and transfer between source and generated pronunciations."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klangwerk.functions import inventory as inv
from klangwerk.functions import pronunciations as pr
from klangwerk.functions import tokens as tk


class Validated(NamedTuple):
    source: DataFrame  # (lang, word, ipa, position) eligible from the source
    machine: DataFrame  # (lang, word, ipa, position) eligible from the engine
    rejected: DataFrame  # (lang, origin, word, ipa, reason, position)
    comparisons: DataFrame  # a row a source variant with its closest generated one
    failed: DataFrame  # (lang, word) of repairs without any pronunciation: a build must stop on them
    counters: DataFrame  # (lang, counter, n): only counters that counted something


_PLACE = ("phase", "a", "b")
_ORDER = "struct<phase: int, a: bigint, b: bigint, c: bigint>"


def _place(rows: DataFrame, phase: int) -> Column:
    """Where a row comes in the order of the stage: by the place it has, if it has one."""
    a = F.col("position") if "position" in rows.columns else F.lit(0)
    b = F.col("at") if "at" in rows.columns else F.lit(0)
    return F.struct(F.lit(phase).alias("phase"), a.cast("long").alias("a"), b.cast("long").alias("b"), F.lit(0).cast("long").alias("c"))


class _Judged(NamedTuple):
    rows: DataFrame
    valid: DataFrame
    bad: DataFrame


def _judged(rows: DataFrame, origin: str, phase: int) -> _Judged:
    """Each pronunciation's valid variants and rejects, once for equal rows."""
    first = rows.select("lang", "word", "ipa", _place(rows, phase).alias("p")).groupBy("lang", "word", "ipa").agg(F.min("p").alias("p"), F.count("*").alias("times"))
    first = first.select("lang", "word", "ipa", *[F.col(f"p.{x}").alias(x) for x in _PLACE], "times")
    c = pr.with_cleaned(first, origin)
    at = lambda n: F.struct(*_PLACE, F.col(n).cast("long").alias("c")).cast(_ORDER)
    valid = c.select("lang", "word", F.posexplode("valid").alias("n", "v"), *_PLACE, F.col("ipa").alias("written"))
    bad = c.select("lang", "word", "ipa", *_PLACE, F.posexplode("rejects.reason").alias("n", "reason")).select("lang", F.lit(origin).alias("origin"), "word", "ipa", "reason", at("n").alias("position"))
    if origin == "wiktionary":
        bare = valid.where(~pr.stressed(F.col("v")))
        bad = bad.unionByName(bare.select("lang", F.lit(origin).alias("origin"), "word", F.col("written").alias("ipa"), F.lit("missing_stress_mark").alias("reason"), at("n").alias("position")))
        valid = valid.where(pr.stressed(F.col("v")))
    return _Judged(c, valid.groupBy("lang", "word", F.col("v").alias("ipa")).agg(F.min(at("n")).alias("position")), bad)


def compare(source: DataFrame, generated: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Each source variant with the generated one that is closest: least ratio, then edits, then the first
    by `position`, where generated has it, then spelling. Unknown sounds are an error."""
    pairs = source.select("lang", "word", F.col("ipa").alias("wiktionary_ipa")).join(generated.withColumnRenamed("ipa", "espeak_ipa"), ["lang", "word"])
    # composed once, before the expressions on tokens, which then stay inside the JVM
    pairs = pairs.withColumn("x", tk.nfc("wiktionary_ipa")).withColumn("y", tk.nfc("espeak_ipa"))
    pairs = pairs.withColumn("x", _by_lang(lambda lang: tk.known(tk.tokens(F.col("x"), lang, normalised=True), lang)))
    pairs = pairs.withColumn("y", _by_lang(lambda lang: tk.known(tk.tokens(F.col("y"), lang, espeak=True, normalised=True), lang)))
    pairs = pairs.withColumn("c", _by_lang(lambda lang: tk.compare(F.col("x"), F.col("y"), lang)))
    first = ["position"] if "position" in generated.columns else []
    rank = F.struct("c.phoneme_distance_ratio", "c.phoneme_edits", *first, "espeak_ipa")
    best = pairs.groupBy("lang", "word", "wiktionary_ipa").agg(F.min_by(F.struct("espeak_ipa", "c"), rank).alias("b"))
    out = best.select("lang", "word", "wiktionary_ipa", "b.espeak_ipa", "b.c.*")
    return out.withColumn("extreme_mismatch", tk.extreme({c: F.col(c) for c in out.columns}, threshold))


def _by_lang(f) -> Column:
    return reduce(lambda c, lang: (F.when if c is None else c.when)(F.col("lang") == lang, f(lang)), inv.LANGUAGES, None)


def requests(clean: DataFrame, repairs: DataFrame) -> DataFrame:
    """(lang, word, position) of the words to ask the pronouncer for: repairs count from 0, list rows from 1; the first place holds."""
    place = lambda df, plus: df.select("lang", "word", (_place(df, 0)["a"] + plus).alias("position"))
    return place(repairs, 0).unionByName(place(clean, 1)).groupBy("lang", "word").agg(F.min("position").alias("position"))


def validate(clean: DataFrame, machine: DataFrame, repairs: DataFrame, generated: DataFrame, replace_extreme: bool = False, threshold: float = 0.8) -> Validated:
    """clean, machine: (lang, word, ipa[, position, at]); repairs: (lang, word, reason, ipa); generated: what the pronouncer
    gives for the words asked for, read from a written table."""
    own, engine, fresh = _judged(clean, "wiktionary", 1), _judged(machine, "espeak", 2), _judged(generated, "espeak", 3)
    repaired = repairs.select("lang", F.lit("wiktionary").alias("origin"), "word", "ipa", "reason", _place(repairs, 0).cast(_ORDER).alias("position"))
    lost = repaired.unionByName(own.bad)
    asked = lost.select("lang", "word").distinct()
    comparisons = compare(own.valid, fresh.valid, threshold)
    given = engine.valid.unionByName(fresh.valid.join(asked, ["lang", "word"], "left_semi"))
    source = own.valid
    if replace_extreme:
        out = comparisons.where("extreme_mismatch")
        source = source.join(out.select("lang", "word", F.col("wiktionary_ipa").alias("ipa")), ["lang", "word", "ipa"], "left_anti")
        moved = out.select("lang", "word", F.col("espeak_ipa").alias("ipa")).distinct()
        given = given.unionByName(fresh.valid.join(moved, ["lang", "word", "ipa"], "left_semi"))
    given = given.groupBy("lang", "word", "ipa").agg(F.min("position").alias("position"))
    # a repair that the engine can't say either is rejected on its own account
    unsaid = fresh.rows.join(asked, ["lang", "word"], "left_semi").join(fresh.valid.select("lang", "word").distinct(), ["lang", "word"], "left_anti")
    unsaid = unsaid.select("lang", F.lit("espeak").alias("origin"), "word", "ipa", F.lit("espeak_generation_invalid").alias("reason"), F.struct(*_PLACE, F.lit(0).cast("long").alias("c")).cast(_ORDER).alias("position"))
    rejected = lost.unionByName(engine.bad).unionByName(unsaid)
    has = own.valid.select("lang", "word").union(engine.valid.select("lang", "word")).union(fresh.valid.select("lang", "word")).distinct()
    failed = asked.join(has, ["lang", "word"], "left_anti")
    return Validated(source, given, rejected, comparisons, failed, _counters(clean, machine, repairs, own, engine, fresh, asked, rejected, comparisons, source, given, replace_extreme))


def _counters(clean, machine, repairs, own, engine, fresh, asked, rejected, comparisons, source, given, replace_extreme) -> DataFrame:
    def count(df: DataFrame, name: str, n: Column | None = None) -> DataFrame:
        return df.groupBy("lang").agg((F.count("*") if n is None else n).cast("long").alias("n")).select("lang", F.lit(name).alias("counter"), "n")

    words = F.count_distinct("word")
    changed = (F.size("changes") > 0) | ((F.size("valid") > 0) & (F.col("valid") != F.array("ipa")))
    moved = own.rows.unionByName(engine.rows).where(changed)
    spoken = fresh.valid.select("lang", "word").distinct()
    far = F.col("extreme_mismatch")
    parts = [
        count(clean, "wiktionary_input_words", words), count(clean, "wiktionary_input_pronunciations"), count(machine, "espeak_input_words", words), count(machine, "espeak_input_pronunciations"),
        count(source, "wiktionary_output_words", words), count(source, "wiktionary_output_pronunciations"), count(given, "espeak_output_words", words), count(given, "espeak_output_pronunciations"),
        count(moved, "transformed_pronunciations", F.sum("times")), count(rejected, "rejected_candidates"), count(asked, "regeneration_requested_words"), count(requests(clean, repairs), "comparison_requested_words"),
        count(asked.join(spoken, ["lang", "word"], "left_semi"), "regenerated_words"), count(asked.join(spoken, ["lang", "word"], "left_anti"), "regeneration_failed_words"),
        count(own.valid.join(spoken, ["lang", "word"], "left_anti"), "comparison_unavailable_variants"), count(comparisons, "compared_variants"),
        count(comparisons.where(far), "extreme_replaced_variants" if replace_extreme else "extreme_review_variants"), count(reported(comparisons), "reported_comparison_variants"),
    ]
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def reported(comparisons: DataFrame) -> DataFrame:
    return comparisons.where(F.col("extreme_mismatch") | (F.col("phoneme_distance_ratio") > 0.5))


def reasons(rejected: DataFrame) -> DataFrame:
    """(lang, reason, count)."""
    return rejected.groupBy("lang", "reason").agg(F.count("*").alias("count"))


def transformations(judged: DataFrame) -> DataFrame:
    """(lang, label, count) of rows with `changes`."""
    return judged.select("lang", F.explode("changes").alias("label")).groupBy("lang", "label").agg(F.count("*").alias("count"))


def grouped(rejected: DataFrame) -> DataFrame:
    """(lang, reason, ipas, entries) in order of position, reasons sorted by whoever writes them."""
    each = F.sort_array(F.collect_list(F.struct("position", F.struct("origin", "word", "ipa", "reason").alias("e"))))
    return rejected.groupBy("lang", "reason").agg(each.alias("x")).select("lang", "reason", F.transform("x", lambda x: x["e"]["ipa"]).alias("ipas"), F.transform("x", lambda x: x["e"]).alias("entries"))


def lookup_reasons(rejected: DataFrame) -> DataFrame:
    """(lang, word, reasons, ipas): why a word's source pronunciations were rejected, and which, in order."""
    own = rejected.where("origin = 'wiktionary'")
    ipas = own.groupBy("lang", "word", "ipa").agg(F.min("position").alias("p")).groupBy("lang", "word").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "ipa"))), lambda x: x["ipa"]).alias("ipas"))
    return own.groupBy("lang", "word").agg(F.sort_array(F.collect_set("reason")).alias("reasons")).join(ipas, ["lang", "word"])


def stop_on(failed: DataFrame) -> None:
    """An error that names a word without any pronunciation."""
    if one := failed.orderBy("lang", "word").first():
        raise ValueError(f"{one.lang}: no valid source or repair for {one.word!r}")
