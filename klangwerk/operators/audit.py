"""Frequencies, evidence and diagnostics of pronunciations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from klangwerk.functions import inventory as inv
from klangwerk.functions import tokens as tk
from klangwerk.functions.headwords import code_point_name


def totals(index: DataFrame) -> DataFrame:
    return index.groupBy("lang", "source").agg(
        F.count("*").alias("pronunciations"), F.count_distinct("ipa").alias("unique_ipa"),
        F.sum(F.size("tokens")).alias("tokens"), F.count_if((F.size("issues") > 0) | (F.col("evidence") == "engine_spelling_differs")).alias("records_with_diagnostics"),
    )


def token_frequencies(index: DataFrame) -> DataFrame:
    return index.select("lang", F.explode("tokens").alias("token")).groupBy("lang", "token").count()


def segment_frequencies(index: DataFrame) -> DataFrame:
    return index.select("lang", F.explode("segments").alias("segment")).groupBy("lang", "segment").count()


def multicodepoint_frequencies(index: DataFrame) -> DataFrame:
    return token_frequencies(index).where(F.length("token") > 1)


def report(index: DataFrame, lang: str, source: str, counts: dict) -> dict:
    """A report of one language and source; what it lists is a row a kind of token, sign or issue, never one a word."""
    table = lambda df, key: {r[key]: r["count"] for r in df.collect()}
    tokens, segments, issues = table(token_frequencies(index), "token"), table(segment_frequencies(index), "segment"), {}
    for r in diagnostics(index).collect():
        issues.setdefault(r.reason, {})[r.spelling] = {"count": r["count"], "codepoints": [f"U+{ord(c):04X}" for c in r.spelling], "example": [r.example.word, r.example.ipa]}
    proof = evidence(index).collect()
    return {
        "key_format": 2, "language": lang, "source": source, "pronunciations": counts.get("pronunciations", 0), "unique_ipa": counts.get("unique_ipa", 0),
        "records_with_diagnostics": counts.get("records_with_diagnostics", 0), "serialized_tokens": sum(tokens.values()), "unique_tokens": len(tokens),
        "phonetic_segments": sum(segments.values()), "unique_segments": len(segments), "boundary_evidence": {r.evidence: r["count"] for r in proof},
        "boundary_examples": {r.evidence: {"word": r.example.word, "ipa": r.example.ipa} for r in proof}, "token_frequencies": tokens, "segment_frequencies": segments,
        "multicodepoint_token_frequencies": {t: n for t, n in tokens.items() if len(t) > 1}, "notation_frequencies": table(notation_frequencies(index), "character"), "diagnostics": issues,
    }


#: Fixed value: the signs of notation that are counted, besides white space.
NOTATION = "/[]()ˈˌ.‿\u035c\u0361\u200d_"


def notation_frequencies(index: DataFrame) -> DataFrame:
    """(lang, character, codepoint, count) of the signs of notation in spellings."""
    signs = F.regexp_extract_all("ipa", F.lit(f"({inv.char_class(NOTATION)}|{tk.WHITESPACE})"), F.lit(1))
    return index.select("lang", F.explode(signs).alias("character")).groupBy("lang", "character", code_point_name(F.col("character")).alias("codepoint")).count()


def nontext_fields(entries: DataFrame) -> DataFrame:
    """(lang, nontext_fields) of raw entries: fields that are no text, or hold half a surrogate pair."""
    return entries.select("lang", F.explode("fields").alias("f")).groupBy("lang").agg(F.count_if(~F.col("f.is_text") | F.col("f.value").isNull()).alias("nontext_fields"))


def evidence(index: DataFrame) -> DataFrame:
    return index.groupBy("lang", "source", "evidence").agg(F.count("*").alias("count"), F.min(F.struct("word", "ipa")).alias("example"))


def diagnostics(index: DataFrame) -> DataFrame:
    """(reason, spelling) with counts and the first example."""
    found = index.select("lang", "word", "ipa", F.explode("issues").alias("i"))
    return found.groupBy("lang", "i.reason", "i.spelling").agg(F.count("*").alias("count"), F.min(F.struct("word", "ipa")).alias("example"))
