"""Writers: routed tables, wordlists, the sorted index, reports, packages."""

from __future__ import annotations

import gzip
import hashlib
import html
import json
import os
import re
import shutil
import sqlite3
import tempfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klangwerk.functions import inventory as inv
from klangwerk.operators import prepare, validate

# The layout of released databases and the form of a release's name.
TABLE = "CREATE TABLE dictionary (word TEXT NOT NULL, ipa TEXT NOT NULL, ipa_reversed TEXT NOT NULL, assonance_reversed TEXT NOT NULL, PRIMARY KEY (word, ipa)) WITHOUT ROWID"
INDEXED = ("ipa_reversed", "assonance_reversed")
KEY_FORMAT = 2
RELEASE = r"[A-Za-z0-9][A-Za-z0-9._+-]*"
GZIP_LEVEL = 9
# End of fixed values.


def write_raw(entries: DataFrame, path: str) -> None:
    entries.write.partitionBy("lang", "has_ipa").parquet(path)


def raw_lines(entries: DataFrame) -> DataFrame:
    """(lang, has_ipa, archive, line, value): entries as [word, [field, ...]], in ASCII as they were read."""
    fields = F.array_join(F.transform("fields", lambda f: f["json"]), ", ")
    return entries.select("lang", "has_ipa", "archive", "line", F.concat(F.lit("["), "word_json", F.lit(", ["), fields, F.lit("]]")).alias("value"))


def wordlist_lines(words: DataFrame) -> DataFrame:
    """(pos, value): word<TAB>compact JSON array."""
    return words.select("pos", F.concat_ws("\t", "word", F.to_json("ipas")).alias("value"))


def json_line(rows: DataFrame, columns: list[str]) -> Column:
    """A row as compact JSON with its keys in order."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def write_lines(lines: Iterable[str], path: str) -> int:
    """One file, replaced in one step; its lines come from an iterator, so that none but the current part is held."""
    n, part = 0, f"{path}.part"
    try:
        with open(part, "w", encoding="utf-8", newline="\n") as out:
            for line in lines:
                out.write(f"{line}\n")
                n += 1
        os.replace(part, path)
    finally:
        Path(part).unlink(missing_ok=True)
    return n


def write_index(dictionary: DataFrame, path: str) -> None:
    """Two projections, each range-partitioned and sorted by its key, so prefix filters prune row groups, and one by word."""
    for key in (*INDEXED, "word"):
        parts = dictionary.repartitionByRange("lang", "source", key).sortWithinPartitions("lang", "source", key)
        parts.write.partitionBy("lang", "source").parquet(f"{path}/{key}")


def write_report(value: object, path: str, ensure_ascii: bool = False) -> None:
    """Sorted JSON, replaced in one step."""
    with tempfile.NamedTemporaryFile("w", dir=os.path.dirname(path) or ".", delete=False, encoding="utf-8") as out:
        json.dump(value, out, ensure_ascii=ensure_ascii, indent=2, sort_keys=True)
        out.write("\n")
    os.replace(out.name, path)


def write_rejections(rejected: DataFrame, path: str) -> None:
    """Rejected pronunciations by reason, a reason at a time."""
    reasons = sorted(r.reason for r in rejected.select("reason").distinct().collect())  # a row a reason
    head = json.dumps({"policy_version": inv.POLICY}, indent=2)[:-2] + ',\n  "groups": ['

    def lines() -> Iterator[str]:
        yield head
        for k, reason in enumerate(reasons):
            for r in validate.grouped(rejected.where(F.col("reason") == reason)).toLocalIterator():
                entries = [{"source": e.origin, "word": e.word, "ipa": e.ipa, "reason": e.reason, "policy_version": inv.POLICY} for e in r.entries]
                group = json.dumps({"reason": reason, "ipas": r.ipas, "entries": entries}, ensure_ascii=False, indent=2)
                yield "    " + group.replace("\n", "\n    ") + ("," if k + 1 < len(reasons) else "")
        yield "  ]\n}"

    write_lines(lines(), path)


def quoted(word_json: str) -> str:
    """A JSON string for HTML text, half surrogate pairs as escapes."""
    text = json.dumps(json.loads(word_json), ensure_ascii=False)
    return html.escape(text.encode("utf-8", "backslashreplace").decode(), quote=False)


def write_summary(prepared: prepare.Prepared, lang: str, path: str) -> None:
    """What cleaning did to a language, as Markdown, with the removed headwords of each reason."""
    own = F.col("lang") == lang
    counts = prepare.counts(prepared.entries).where(own).first()
    rules = prepare.rule_counts(prepared.events).where(own).orderBy("rule").collect()  # a row a rule
    removed = prepare.excluded(prepared.entries).where(own).orderBy("reason")

    def lines() -> Iterator[str]:
        yield f"# {lang} cleaning summary\n\nPolicy `{inv.POLICY}`\n"
        yield from (f"- {c}: {counts[c] if counts else 0}" for c in ("input", "removed", "retained", "merged"))
        yield "\n## Input entries affected by each rule\n"
        yield from (f"- {r.rule}: {r.affected_entries}" for r in rules)
        for r in removed.toLocalIterator():
            yield f"\n## {r.reason}\n\n<p>{', '.join(map(quoted, r.originals))}</p>"

    write_lines(lines(), path)


def prepare_report(prepared: prepare.Prepared, lang: str) -> dict:
    own = F.col("lang") == lang
    counts = prepare.counts(prepared.entries).where(own).drop("lang").first()
    rules = prepare.rule_counts(prepared.events).where(own).collect()
    return {
        "policy_version": inv.POLICY, "counts": counts.asDict() if counts else dict.fromkeys(("input", "removed", "retained", "merged"), 0),
        "rule_counts": {r.rule: r.occurrences for r in rules if r.occurrences}, "affected_entries": {r.rule: r.affected_entries for r in rules},
    }


def validate_report(v: validate.Validated, lang: str, replace_extreme: bool, threshold: float) -> dict:
    own = F.col("lang") == lang
    return {
        "policy_version": inv.POLICY, "language": lang, "comparison_mode": "replace_extreme" if replace_extreme else "report_only", "extreme_distance": threshold,
        "counts": {r.counter: r.n for r in v.counters.where(own).collect()}, "rejection_reasons": {r.reason: r["count"] for r in validate.reasons(v.rejected).where(own).collect()},
    }


def check_paths(inputs: list[str], outputs: list[str]) -> None:
    real = [os.path.realpath(p) for p in [*inputs, *outputs]]
    if len(set(real)) != len(real):
        raise ValueError("an output is also an input or another output")


def check_release(release: str, path: str | None = None) -> None:
    """A release's name, and that a file's name ends with it."""
    if not re.fullmatch(RELEASE, release):
        raise ValueError(f"no name of a release: {release!r}")
    if path is not None and Path(path).stem != release and not Path(path).stem.endswith(f"_{release}"):
        raise ValueError(f"{path!r} does not name the release {release!r} at its end")


def publish(files: dict[str, str]) -> None:
    """Move finished parts to their places, all or none: what was there comes back if a move fails."""
    kept: dict[str, str] = {}
    done: list[str] = []
    try:
        for place in files.values():
            if os.path.exists(place):
                kept[place] = f"{place}.before"
                Path(kept[place]).unlink(missing_ok=True)
                try:
                    os.link(place, kept[place])
                except OSError:
                    shutil.copy2(place, kept[place])
        for part, place in files.items():
            os.replace(part, place)
            done.append(place)
    except BaseException:
        for place in done:
            if place in kept:
                os.replace(kept.pop(place), place)
            else:
                Path(place).unlink(missing_ok=True)
        raise
    finally:
        for copy in kept.values():
            Path(copy).unlink(missing_ok=True)


@contextmanager
def build_lock(folder: str) -> Iterator[None]:
    """One build a folder: another one waits."""
    import fcntl

    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, ".lock"), "w") as held:
        fcntl.flock(held, fcntl.LOCK_EX)
        yield


def export_sqlite(dictionary: DataFrame, path: str, release: str | None = None) -> dict[str, int]:
    """A SQLite file of one language and source, row by row from the executors; left as it was on failure.

    Gives its rows and words.
    """
    if release is not None:
        check_release(release, path)
    part = f"{path}.part"
    Path(part).unlink(missing_ok=True)
    db = sqlite3.connect(part)
    try:
        db.execute(TABLE)
        rows = dictionary.select("word", "ipa", *INDEXED).toLocalIterator()
        db.executemany("INSERT INTO dictionary VALUES (?, ?, ?, ?)", (tuple(r) for r in rows))
        for key in INDEXED:
            db.execute(f"CREATE INDEX idx_{key} ON dictionary ({key})")
        db.execute(f"PRAGMA user_version = {KEY_FORMAT}")
        db.commit()
        if db.execute("PRAGMA integrity_check").fetchone()[0] != "ok":
            raise ValueError("the database is damaged")
        n, words = db.execute("SELECT count(*), count(DISTINCT word) FROM dictionary").fetchone()
    except BaseException:
        db.close()
        Path(part).unlink(missing_ok=True)
        raise
    db.close()
    os.replace(part, path)
    return {"rows": n, "words": words}


def compress(path: str, out: str) -> str:
    """A gzip file that depends on the content alone, a block at a time; gives its SHA-256."""
    with open(path, "rb") as source, open(out, "wb") as raw:
        with gzip.GzipFile(filename="", mode="wb", compresslevel=GZIP_LEVEL, fileobj=raw, mtime=0) as packed:
            shutil.copyfileobj(source, packed, 1 << 20)
    return digest(out)


def digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def package(paths: list[str], root: str) -> str:
    """A gzip file beside each path and root's SHA256SUMS with their places under root; all are replaced, or none."""
    if bad := [p for p in paths if not os.path.isfile(p) or not os.path.getsize(p)]:
        raise ValueError(f"missing or empty: {', '.join(sorted(bad))}")
    parts: dict[str, str] = {}
    try:
        sums = []
        for path in sorted(paths):
            parts[f"{path}.gz.part"] = f"{path}.gz"
            sums.append(f"{compress(path, f'{path}.gz.part')}  {os.path.relpath(f'{path}.gz', root)}\n")
        manifest = os.path.join(root, "SHA256SUMS")
        parts[f"{manifest}.part"] = manifest
        Path(f"{manifest}.part").write_text("".join(sums), encoding="ascii")
        publish(parts)
    finally:
        for part in parts:
            Path(part).unlink(missing_ok=True)
    return "".join(sums)
