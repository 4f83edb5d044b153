"""Dictionary dumps, wordlists and requests: one record a line, plain or gzipped."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klangwerk.functions import inventory as inv

ENTRY = "archive int, line long, status string, lang string, word string, word_json string, fields array<struct<is_text boolean, value string, json string>>"
# The archives that a release reads, by language.
ARCHIVES = {
    "de": "https://kaikki.org/dictionary/downloads/de/de-extract.jsonl.gz",
    "tr": "https://kaikki.org/dictionary/downloads/tr/tr-extract.jsonl.gz",
    "en": "https://kaikki.org/dictionary/raw-wiktextract-data.jsonl.gz",
}


def languages(asked: list[str]) -> list[str]:
    """The languages asked for, each once and in order; others than those of a release are an error."""
    if bad := [x for x in asked if x not in inv.LANGUAGES]:
        raise ValueError(f"no such language: {', '.join(bad)}")
    return list(dict.fromkeys(asked))


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(archive, line, value, valid): archives in the order given, lines numbered in each.

    A line's place in its split is counted where it is read; the driver adds up how many lines the splits
    before it have, a row a split.
    """
    out = None
    for i, path in enumerate(paths):
        rows = spark.read.text(path).select("value", F.is_valid_utf8("value").alias("valid"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"))
        rows = rows.withColumn("id", F.monotonically_increasing_id())
        splits = rows.groupBy("f", "s").agg(F.count("*").alias("n"), F.min("id").alias("least")).orderBy("f", "s").collect()
        begin, offsets = 0, []
        for r in splits:
            offsets.append((r.f, r.s, begin - r.least))
            begin += r.n
        known = spark.createDataFrame(offsets, "f string, s long, offset long")
        lines = rows.join(F.broadcast(known), ["f", "s"]).select(F.lit(i).alias("archive"), (F.col("id") + F.col("offset")).alias("line"), F.when(F.col("valid"), F.col("value")).alias("value"), "valid")
        out = lines if out is None else out.union(lines)
    return out


def _text(value: object) -> tuple[bool, str | None, str]:
    """(is text, the text, its JSON): lone surrogates stay in the JSON only."""
    coded = json.dumps(value)
    if isinstance(value, str):
        try:
            value.encode()
            return True, value, coded
        except UnicodeEncodeError:
            return True, None, coded
    return False, None, coded


def _field(value: object) -> dict:
    is_text, text, coded = _text(value)
    return {"is_text": is_text, "value": text, "json": coded}


def _fields(sounds: object) -> list[dict]:
    spoken = [s for s in sounds if isinstance(s, dict)] if isinstance(sounds, list) else []
    return [_field(s[key]) for s in spoken for key in ("ipa", "audio-ipa") if key in s]


def parse(lines: DataFrame, languages: tuple[str, ...] = inv.LANGUAGES) -> DataFrame:
    """Every line's status (bad_json, invalid, other_language, selected) and, where selected, its projection."""

    def told(value: str, valid: bool) -> tuple:
        if not valid:
            return "bad_json", None, None, None, None
        try:
            record = json.loads(value)
        except (ValueError, RecursionError):
            return "bad_json", None, None, None, None
        if not isinstance(record, dict):
            return "invalid", None, None, None, None
        lang = record.get("lang_code")
        if not isinstance(lang, str) or lang not in languages:
            return "other_language", lang if isinstance(lang, str) else None, None, None, None
        return "selected", lang, *_text(record.get("word"))[1:], _fields(record.get("sounds"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(a, n, *told(v, ok)) for a, n, v, ok in zip(batch.archive, batch.line, batch.value, batch.valid)]
            yield pd.DataFrame(rows, columns=["archive", "line", "status", "lang", "word", "word_json", "fields"])

    return lines.select("archive", "line", "value", "valid").mapInPandas(run, ENTRY)


def raw_entries(parsed: DataFrame) -> DataFrame:
    return parsed.where("status = 'selected'").select("lang", (F.size("fields") > 0).alias("has_ipa"), "archive", "line", "word", "word_json", "fields")


def ingest_counts(parsed: DataFrame) -> DataFrame:
    return parsed.agg(
        F.count("*").alias("records_read"), F.count_if(F.col("status") == "bad_json").alias("bad_json_records"),
        F.count_if(F.col("status") == "invalid").alias("invalid_records"), F.count_if(F.col("status") == "selected").alias("selected_records"),
    )


def language_counts(parsed: DataFrame) -> DataFrame:
    """(lang, records, with_fields) of the selected records."""
    return raw_entries(parsed).groupBy("lang").agg(F.count("*").alias("records"), F.count_if("has_ipa").alias("with_fields"))


def _read(spark: SparkSession, path: str, row: Callable[[str], tuple], schema: str) -> DataFrame:
    """What row makes of each line, after its number `pos`; a line that it can't read is an error that names path and line."""
    names = [f.name for f in T.StructType.fromDDL(f"pos long, {schema}")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for line, value, valid in zip(batch.line, batch.value, batch.valid):
                try:
                    if not valid:
                        raise ValueError("not UTF-8")
                    rows.append((line, *row(value)))
                except (ValueError, RecursionError) as e:
                    raise ValueError(f"{path}:{line + 1}: {e}") from None
            yield pd.DataFrame(rows, columns=names)

    return numbered_lines(spark, [path]).select("line", "value", "valid").mapInPandas(run, f"pos long, {schema}")


def word_row(line: str) -> tuple[str, list[str]]:
    """word<TAB>JSON array of one string or more, none of them blank."""
    word, tab, coded = line.partition("\t")
    ipas = json.loads(coded) if tab and "\t" not in coded else None
    if not word or not isinstance(ipas, list) or not ipas or not all(isinstance(x, str) and x.strip() for x in ipas):
        raise ValueError("malformed wordlist row")
    return word, ipas


def index_row(line: str) -> tuple[str, list[str]]:
    """The same for an index: the word composed, spellings as they are, without control characters."""
    if not line.strip():
        raise ValueError("empty wordlist row")
    word, ipas = word_row(line)
    if any(unicodedata.category(c) == "Cc" for x in ipas for c in x):
        raise ValueError("control character in a pronunciation")
    return unicodedata.normalize("NFC", word), ipas


def read_wordlist(spark: SparkSession, path: str, lang: str, source: str, for_index: bool = False) -> DataFrame:
    """(lang, source, pos, word, ipas)."""
    rows = _read(spark, path, index_row if for_index else word_row, "word string, ipas array<string>")
    return rows.select(F.lit(lang).alias("lang"), F.lit(source).alias("source"), "pos", "word", "ipas")


def long_form(words: DataFrame) -> DataFrame:
    """(lang, source, word, ipa, position, at): a row a pronunciation."""
    return words.select("lang", "source", "word", F.col("pos").alias("position"), F.posexplode("ipas").alias("at", "ipa"))


def missing_row(line: str) -> tuple[str]:
    if not line or "\t" in line:
        raise ValueError("malformed word row")
    return (line,)


def read_missing(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """(lang, pos, word)."""
    return _read(spark, path, missing_row, "word string").select(F.lit(lang).alias("lang"), "pos", "word")


def read_raw(spark: SparkSession, ipa: str, noipa: str | None, lang: str) -> DataFrame:
    """Raw entries from their lines [word, [field, ...]]: those with fields come first."""

    def row(line: str) -> tuple:
        word, fields = json.loads(line)
        return *_text(word)[1:], [_field(f) for f in fields]

    out = None
    for has, path in ((True, ipa), (False, noipa)):
        if path is not None:
            rows = _read(spark, path, row, "word string, word_json string, fields array<struct<is_text: boolean, value: string, json: string>>")
            rows = rows.select(F.lit(lang).alias("lang"), F.lit(has).alias("has_ipa"), F.lit(0).alias("archive"), F.col("pos").alias("line"), "word", "word_json", "fields")
            out = rows if out is None else out.unionByName(rows)
    return out


def read_repairs(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """(lang, position, word, ipa, reason, details) from lines [word, ipa, {reason, details}]."""

    def row(line: str) -> tuple:
        word, ipa, rejection = json.loads(line)
        return word, ipa, rejection["reason"], json.dumps(rejection.get("details", {}), ensure_ascii=False, sort_keys=True)

    rows = _read(spark, path, row, "word string, ipa string, reason string, details string")
    return rows.select(F.lit(lang).alias("lang"), F.col("pos").alias("position"), "word", "ipa", "reason", "details")


def fingerprints(spark: SparkSession, paths: list[str], hashed: bool = True) -> DataFrame:
    """(path, size_bytes, modified, sha256) of files that Spark can read; their content passes in blocks, whatever their size."""
    hadoop, digests = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.commons.codec.digest.DigestUtils
    rows = []
    for path in paths:
        at = hadoop.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        status, sha = fs.getFileStatus(at), None
        if hashed:
            stream = fs.open(at)
            try:
                sha = digests.sha256Hex(stream)
            finally:
                stream.close()
        rows.append((path, status.getLen(), status.getModificationTime(), sha))
    return spark.createDataFrame(rows, "path string, size_bytes long, modified long, sha256 string")
