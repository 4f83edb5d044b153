"""A release from dumps or from lists: extract, prepare, generate, validate, audit, index and package.

Each stage writes its tables to <out>/tables and is reused as long as what it reads, its options and its
code are the same. Tables are Parquet; what people read (lists, reports, databases) is exported from them.
"""

from __future__ import annotations

import hashlib
import os
import shutil
from collections.abc import Callable
from datetime import UTC
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from klangwerk.functions import codec, headwords, pronunciations, tokens
from klangwerk.functions import inventory as inv
from klangwerk.operators import audit, index, prepare, pronounce, validate
from klangwerk.plans import stages
from klangwerk.sources import dumps, sinks

_CODE = [m.__file__ for m in (codec, headwords, pronunciations, tokens, inv, audit, index, prepare, pronounce, validate, dumps, sinks, stages)] + [__file__]


def release_name(last_modified: str, prefix: str = "v") -> str:
    """The name of a release, from the date header of its archive."""
    return f"{prefix}{parsedate_to_datetime(last_modified).astimezone(UTC):%Y%m%d}"


class Build:
    def __init__(
        self, spark: SparkSession, out: str, release: str, pronouncer: pronounce.Pronouncer, engine: str = "", languages: tuple[str, ...] = inv.LANGUAGES,
        replace_extreme: bool = True, threshold: float = 0.8,
    ):
        """engine: what names the pronouncer's version, so that another one's results are not reused."""
        sinks.check_release(release)
        self.spark, self.out, self.release, self.pronouncer, self.engine = spark, os.path.abspath(out), release, pronouncer, engine
        self.languages, self.replace_extreme, self.threshold = dumps.languages(list(languages)), replace_extreme, threshold
        self.ran: list[str] = []

    def _at(self, name: str) -> str:
        return f"{self.out}/tables/{name}"

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._at(name))

    def _stage(self, name: str, inputs: dict[str, str], options: list, make: Callable[[], dict[str, DataFrame]]) -> dict[str, str]:
        """The digests of the stage's tables: an id that is new with each run of the stage."""
        own = stages.signature(inputs, options, _CODE)

        def run(signature: str) -> dict[str, str]:
            self.ran.append(name)
            for table, df in make().items():
                shutil.rmtree(self._at(table), ignore_errors=True)
                df.write.parquet(self._at(table))
                tables.append(table)
            return {t: signature for t in tables}

        tables: list[str] = []
        there = lambda known: all(os.path.exists(f"{self._at(t)}/_SUCCESS") for t in known)
        return stages.run_stage(f"{self.out}/tables/{name}.json", own, run, there)

    def from_dumps(self, archives: list[str]) -> list[str]:
        """Databases, lists and reports of the dumps; gives the databases' paths."""
        with sinks.build_lock(self.out):
            os.makedirs(f"{self.out}/tables", exist_ok=True)
            shutil.rmtree(self._at("machine"), ignore_errors=True)  # of a build from lists
            read = {r.path: r.sha256 for r in dumps.fingerprints(self.spark, archives).collect()}
            got = self._stage("extract", read, self.languages, lambda: self._extract(archives))
            got = self._stage("prepare", got, [inv.POLICY], self._prepare)
            made = self._stage("generate", got, [self.engine], self._generate)
            return self._finish({**got, **made})

    def from_lists(self, lists: dict[tuple[str, str], str]) -> list[str]:
        """The same from cleaned lists by (language, source), without repairs: extraction and generation are left out."""
        with sinks.build_lock(self.out):
            os.makedirs(f"{self.out}/tables", exist_ok=True)
            shutil.rmtree(self._at("entries"), ignore_errors=True)  # of a build from dumps
            read = {r.path: r.sha256 for r in dumps.fingerprints(self.spark, list(lists.values())).collect()}
            got = self._stage("lists", read, [inv.POLICY], lambda: self._lists(lists))
            return self._finish({**got, **self._stage("generate", got, [self.engine], self._generate)})

    def _extract(self, archives: list[str]) -> dict[str, DataFrame]:
        parsed = dumps.parse(dumps.numbered_lines(self.spark, archives), tuple(self.languages))
        return {"parsed": parsed.select("archive", "line", "status", "lang", "word", "word_json", "fields")}

    def _prepare(self) -> dict[str, DataFrame]:
        p = prepare.prepare(dumps.raw_entries(self._read("parsed")))
        return {"entries": p.entries, "source": p.source, "clean": p.clean, "missing": p.missing, "repairs": p.repairs, "events": p.events}

    def _lists(self, lists: dict[tuple[str, str], str]) -> dict[str, DataFrame]:
        own = {"wiktionary": None, "espeak": None}
        for (lang, source), path in lists.items():
            good, _, _ = prepare.clean_wordlist(dumps.read_wordlist(self.spark, path, lang, source))
            rows = dumps.long_form(good.withColumn("source", F.lit(source))).drop("source")
            own[source] = rows if own[source] is None else own[source].unionByName(rows)
        empty = self.spark.createDataFrame([], "lang string, word string, position long, at int, ipa string")
        none = empty.select("lang", "word", "ipa", F.lit("").alias("reason"), F.lit("").alias("details"))
        clean = empty if own["wiktionary"] is None else own["wiktionary"]
        return {"source": clean, "clean": clean, "machine": empty if own["espeak"] is None else own["espeak"], "repairs": none, "missing": empty.select("lang", "word")}

    def _generate(self) -> dict[str, DataFrame]:
        """The engine is asked once for every word: those without a pronunciation and those to compare or repair."""
        wanted = self._read("missing").select("lang", "word").union(validate.requests(self._read("clean"), self._read("repairs")).select("lang", "word")).distinct()
        return {"spoken": pronounce.pronounce(wanted, self.pronouncer)}

    def _finish(self, got: dict[str, str]) -> list[str]:
        options = [self.replace_extreme, self.threshold]
        got |= self._stage("validate", got, options, self._validate)
        self._stage("index", got, [], self._index)
        failed = self._read("failed")
        validate.stop_on(failed)
        return self._export()

    def _validate(self) -> dict[str, DataFrame]:
        told, empty = pronounce.generated(self._read("spoken"))
        missing = self._read("missing")
        machine = told.join(missing, ["lang", "word"], "left_semi").select("lang", "word", "ipa")
        if os.path.exists(self._at("machine")):
            machine = self._read("machine").unionByName(machine, allowMissingColumns=True)
        v = validate.validate(self._read("clean"), machine, self._read("repairs"), told.join(missing, ["lang", "word"], "left_anti"), self.replace_extreme, self.threshold)
        return {"valid_source": v.source, "valid_machine": v.machine, "rejected": v.rejected, "comparisons": v.comparisons, "failed": v.failed, "counters": v.counters, "empty": empty}

    def _index(self) -> dict[str, DataFrame]:
        rows = [self._read(t).select("lang", F.lit(s).alias("source"), "word", "ipa") for t, s in (("valid_source", "wiktionary"), ("valid_machine", "espeak"))]
        return {"index": index.admit(index.build_index(rows[0].unionByName(rows[1])))}

    def validated(self) -> validate.Validated:
        return validate.Validated(*[self._read(t) for t in ("valid_source", "valid_machine", "rejected", "comparisons", "failed", "counters")])

    def prepared(self) -> prepare.Prepared:
        return prepare.Prepared(*[self._read(t) for t in ("entries", "source", "clean", "missing", "repairs", "events")])

    def _export(self) -> list[str]:
        """Lists, reports and a database for each language and source, then the archives of all databases."""
        v, made, steps = self.validated(), [], {}
        full = os.path.exists(self._at("entries"))
        for lang in self.languages:
            at = f"{self.out}/{lang}"
            os.makedirs(f"{at}/reports", exist_ok=True)
            own = F.col("lang") == lang
            for rows, source in ((v.source, ""), (v.machine, "_espeak")):
                words = prepare.wordlist(rows.where(own)).orderBy("word")
                lines = words.select(F.concat_ws("\t", "word", F.to_json("ipas")).alias("value"))
                sinks.write_lines((r.value for r in lines.toLocalIterator()), f"{at}/wordlist_{lang}{source}_eligible.txt")
                path = f"{at}/{lang}{source}_{self.release}.db"
                table = self._read("index").where(own & (F.col("source") == (source[1:] or "wiktionary")))
                steps[f"{lang}{source}"] = sinks.export_sqlite(table, path, self.release)
                made.append(path)
                self._audit(table, f"{at}/reports/ipa_reversal{source}.json", lang, source[1:] or "wiktionary")
            sinks.write_lines((r.word for r in self._read("empty").where(own).orderBy("word").toLocalIterator()), f"{at}/empty_words.txt")
            sinks.write_rejections(v.rejected.where(own), f"{at}/reports/rejected.json")
            steps[f"{lang}_validation"] = sinks.validate_report(v, lang, self.replace_extreme, self.threshold)
            if full:
                steps[f"{lang}_entries"] = sinks.prepare_report(self.prepared(), lang)
                sinks.write_summary(self.prepared(), lang, f"{at}/reports/summary.md")
        mode = "replace_extreme" if self.replace_extreme else "report_only"
        sinks.write_report({"release_version": self.release, "comparison_mode": mode, "extreme_distance": self.threshold, "step_reports": steps}, f"{self.out}/report.json")
        sinks.package(made, self.out)
        return made

    def _audit(self, table: DataFrame, path: str, lang: str, source: str) -> None:
        total = audit.totals(table).first()
        sinks.write_report(audit.report(table, lang, source, total.asDict() if total else {}), path)


def sample(words: DataFrame, size: int = 250, without: DataFrame | None = None) -> DataFrame:
    """The `size` words of each language and source with the lowest digests, and none of `without` (lang, word)."""

    @F.pandas_udf("string")
    def score(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: hashlib.blake2b(k.encode()).hexdigest())

    own = words.select("lang", "source", "word").distinct()
    own = own if without is None else own.join(without.select("lang", "word"), ["lang", "word"], "left_anti")
    ranked = own.withColumn("score", score(F.concat_ws("\t", "lang", "source", "word")))
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy("score", "word"))).where(F.col("rank") <= size).drop("rank")
