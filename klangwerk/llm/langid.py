"""Operator 1: language identification by compression.

For each language a raw-content zstandard dictionary is built from a bounded sample of its texts. A
text is encoded with each dictionary; the language whose dictionary gives the smallest output wins,
and a narrow margin between the two smallest is a rejection. A tie goes to the language with more
labelled documents.

Cases: null text and text without a letter are `und` with score 0; texts are encoded whole, whatever
their length; a text that only repeats a few words tells little and may be rejected; without any labelled text all are `und`; columns named like the three results give way
to them, other columns are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klangwerk.llm.store import table

#: Bounds of the sample: documents read a language, and bytes of its dictionary.
SAMPLE_DOCS = 300
DICT_BYTES = 64 << 10
#: Lower levels find too few of the short matches that tell languages apart.
LEVEL = 9
#: A text is rejected where the runner-up is not larger by more than this share of the bytes that a
#: dictionary can speak to, which are no more than it has itself. Outputs are whole bytes: half a byte of
#: a difference is noise, so what is less says nothing against a text.
MIN_MARGIN = 0.002
ROUNDING = 0.5
UND = "und"
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """The text's words in lower case, parted by one space; nothing where it has no letter."""
    if not any(map(str.isalpha, text or "")):
        return b""
    return _OTHER.sub(" ", text or "").strip().lower().encode("utf-8", "surrogatepass")


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """A dictionary a language, from documents with the smallest hashes of their ids and texts.

    The share of documents that is read follows from the count of each language, so the driver gets
    about sample_docs texts a language and no sort is needed.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().toLocalIterator()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample_docs / n))])
    spot = F.pmod(F.xxhash64(F.lit(1), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # of a text no more than a dictionary holds; equal rows count once
    picked = known.where(spot < share[F.col("lang")]).select("lang", F.left("text", F.lit(dict_bytes)).alias("text"), spot.alias("spot")).distinct()
    by: dict[str, list[tuple[float, bytes]]] = {}
    for r in picked.toLocalIterator():
        by.setdefault(r["lang"], []).append((r["spot"], letters(r["text"])))
    out = {}
    for lang in sorted(by, key=lambda k: (-counts[k], k)):
        texts = [t for _, t in sorted(by[lang]) if t]
        each = max(256, dict_bytes // max(1, len(texts)))
        # every text gives about the same share, so that no long text fills the dictionary
        short = b" ".join(t[:each] for t in texts)
        rest = b" ".join(t[each:] for t in texts)
        if whole := (rest[: max(0, dict_bytes - len(short))] + b" " + short)[-dict_bytes:]:
            out[lang] = whole
    return out


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = list(dictionaries)
        self.coders = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)"""
        data = letters(text)
        if not data or not self.coders:
            return UND, 0.0, True
        sizes = sorted((len(c.compress(data)), i) for i, c in enumerate(self.coders))
        reach = min(len(data), DICT_BYTES)
        ahead = sizes[1][0] - sizes[0][0] if len(sizes) > 1 else reach
        # two sizes as probabilities of the same text: the difference in bytes, at a bit of evidence each
        return self.langs[sizes[0][1]], 1 / (1 + math.exp(-min(50.0, ahead / reach * 40))), ahead + ROUNDING < MIN_MARGIN * reach


def identify(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """docs plus lang_pred, score and rejected; the dictionaries are bounded and travel with the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = Classifier(dictionaries)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column("text")]
            cols = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, "lang_pred", "score", "rejected"])

    docs = docs.drop("lang_pred", "score", "rejected")
    found = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *found.fields]))


def held_out(column: str = "doc_id", n: int = 4, rest: int = 2):
    return F.coalesce(F.crc32(F.col(column).cast("string")) % n == rest, F.lit(False))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = learn(docs.where(~held_out()))
    base = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(base, dictionaries).select("doc_id", "held_out", "lang_pred", "score", "rejected")
