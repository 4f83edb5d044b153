"""Readers, writers and the build, from small files to archives."""

import gzip
import hashlib
import json
import os
import sqlite3
import sys

import pytest
from pyspark.sql import functions as F

from klangwerk import __main__ as cli
from klangwerk.operators import index, legacy, pronounce
from klangwerk.plans import build, stages
from klangwerk.sources import dumps, sinks
from klangwerk.streaming import drops


def test_wordlists(spark, tmp_path):
    good = tmp_path / "good.txt"
    good.write_text('tea\t["/ˈti/","x"]\nox\t["y "]\n', encoding="utf-8")
    rows = dumps.read_wordlist(spark, str(good), "en", "wiktionary")
    assert [tuple(r) for r in rows.orderBy("pos").collect()] == [("en", "wiktionary", 0, "tea", ["/ˈti/", "x"]), ("en", "wiktionary", 1, "ox", ["y "])]
    assert dumps.long_form(rows).count() == 3
    for k, bad in enumerate(("a\t[1,2]", 'a\t["x"] more', 'a\t["x"]\t', "a", '\t["x"]', "a\t[]", 'a\t[" "]', 'a\t{"x":1}', "a\t[", "")):
        path = tmp_path / f"bad{k}.txt"
        path.write_text(f'tea\t["x"]\n{bad}\nox\t["y"]\n', encoding="utf-8")
        with pytest.raises(Exception, match=rf"bad{k}.txt:2: "):
            dumps.read_wordlist(spark, str(path), "en", "wiktionary").collect()
    control = tmp_path / "control.txt"
    control.write_text('te\u0301\t["a\\u0007"]\n', encoding="utf-8")
    assert dumps.read_wordlist(spark, str(control), "en", "x").first().word == "te\u0301"
    with pytest.raises(Exception, match="control character"):
        dumps.read_wordlist(spark, str(control), "en", "x", for_index=True).collect()
    with pytest.raises(Exception, match="malformed word row"):
        dumps.read_missing(spark, str(good), "en").collect()


def test_raw_round_trip(spark, tmp_path):
    lines = [{"lang_code": "en", "word": "tea", "sounds": [{"ipa": "/ˈti/"}, 3, {"audio-ipa": None, "ipa": 7}]}, {"lang_code": "en", "word": None}, {"lang_code": "xx", "word": "b"}, [1], {"lang_code": "de", "word": "\ud800"}]
    text = "\n".join(map(json.dumps, lines)) + "\n{}x\nNaN\n"
    a, b = tmp_path / "a.jsonl.gz", tmp_path / "b.jsonl"
    a.write_bytes(gzip.compress(text.encode()))
    b.write_bytes(b'{"lang_code":"tr","word":"\xff"}\r\n{"lang_code":"tr","word":"su"}\n')
    parsed = dumps.parse(dumps.numbered_lines(spark, [str(a), str(b)]))
    status = {(r.archive, r.line): r.status for r in parsed.collect()}
    assert [status[k] for k in sorted(status)] == ["selected", "selected", "other_language", "invalid", "selected", "bad_json", "invalid", "bad_json", "selected"]
    assert {r.lang: r.records for r in dumps.language_counts(parsed).collect()} == {"en": 2, "de": 1, "tr": 1}
    entries = dumps.raw_entries(parsed)
    told = {r.value for r in sinks.raw_lines(entries).collect()}
    assert told == {'["tea", ["/\\u02c8ti/", 7, null]]', "[null, []]", '["\\ud800", []]', '["su", []]'}
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join(sorted(told)) + "\n")
    again = dumps.read_raw(spark, str(path), None, "en")
    assert {r.value for r in sinks.raw_lines(again).collect()} == told
    assert legacy.counts(parsed).where("lang = 'en'").first().junk_ipa_dropped == 2 and legacy.counts(parsed).where("lang = 'en'").first().invalid_entries == 1


def test_many_splits(spark, tmp_path):
    path = tmp_path / "long.txt"
    path.write_text("".join(f"line {i} {'x' * (i % 90)}\n" for i in range(4000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = dumps.numbered_lines(spark, [str(path)])
        assert rows.select("value").rdd.getNumPartitions() > 3 and rows.where(~F.col("value").startswith(F.concat(F.lit("line "), F.col("line"), F.lit(" ")))).count() == 0 and rows.count() == 4000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_requests_and_fingerprints(spark, tmp_path):
    path = tmp_path / "repairs.jsonl"
    path.write_text('["ox", "/o/", {"reason": "missing_stress_mark", "details": {"candidate": "/o/"}}]\n["a", "b", {"reason": "r"}]\n')
    assert [(r.position, r.word, r.reason, r.details) for r in dumps.read_repairs(spark, str(path), "en").orderBy("position").collect()] == [(0, "ox", "missing_stress_mark", '{"candidate": "/o/"}'), (1, "a", "r", "{}")]
    told = dumps.fingerprints(spark, [str(path)]).first()
    assert told.sha256 == hashlib.sha256(path.read_bytes()).hexdigest() and told.size_bytes == path.stat().st_size
    assert dumps.languages(["en", "tr", "en"]) == ["en", "tr"]
    with pytest.raises(ValueError):
        dumps.languages(["xx"])


def test_latin_only(spark):
    rows = [("été",), ("чай",), ("ʻokina",), ("a1",), ("λ",)]
    got = spark.createDataFrame(rows, "w string").select("w", legacy.non_latin_letter("w").alias("x")).collect()
    assert {r.w for r in got if r.x} == {"чай", "λ"}


def test_publish_and_package(tmp_path, monkeypatch):
    for name in ("a", "b"):
        (tmp_path / f"{name}.new").write_text(f"new {name}")
        (tmp_path / name).write_text(f"old {name}")
    files = {str(tmp_path / f"{n}.new"): str(tmp_path / n) for n in ("a", "b")}
    move, calls = os.replace, []

    def fail(x, y):
        calls.append(y)
        if len(calls) == 2:
            raise OSError("disk full")
        move(x, y)

    with monkeypatch.context() as m:
        m.setattr(os, "replace", fail)
        with pytest.raises(OSError):
            sinks.publish(files)
    assert [(tmp_path / n).read_text() for n in ("a", "b")] == ["old a", "old b"] and not list(tmp_path.glob("*.before"))
    db = tmp_path / "en" / "en_v1.db"
    db.parent.mkdir()
    db.write_bytes(b"x" * 3_000_000)
    sums = sinks.package([str(db)], str(tmp_path))
    assert sums == f"{sinks.digest(str(db) + '.gz')}  en/en_v1.db.gz\n" == (tmp_path / "SHA256SUMS").read_text() and gzip.decompress((tmp_path / "en/en_v1.db.gz").read_bytes()) == db.read_bytes()
    assert sinks.package([str(db)], str(tmp_path)) == sums
    (tmp_path / "empty.db").touch()
    with pytest.raises(ValueError, match="empty.db"):
        sinks.package([str(db), str(tmp_path / "empty.db")], str(tmp_path))
    with pytest.raises(ValueError):
        sinks.check_paths(["a"], ["./a"])
    for bad in ("", "-x", "a b"):
        with pytest.raises(ValueError):
            sinks.check_release(bad)
    with pytest.raises(ValueError):
        sinks.check_release("v1", "en_v12.db")


def test_stages(tmp_path):
    state, ran = str(tmp_path / "s.json"), []

    def stage(own):
        ran.append(own)
        return {"t": own}

    for own in ("1", "1", "2"):
        assert stages.run_stage(state, own, stage) == {"t": own}
    (tmp_path / "s.json").write_text("{")  # damaged
    stages.run_stage(state, "2", stage)
    stages.run_stage(state, "2", stage, lambda known: False)
    assert ran == ["1", "2", "2", "2"]


def test_index(spark, tmp_path):
    rows = [("en", "wiktionary", w, i) for w, i in (("cat", "/ˈkæt/"), ("bat", "[ˈbæt]"), ("oats", "/ˈoʊts/"), ("cats", "/ˈkæts/"), ("at", "æt"), ("tea", "/ˈti/"))]
    table = index.admit(index.build_index(spark.createDataFrame(rows, "lang string, source string, word string, ipa string")))
    sinks.write_index(table, str(tmp_path / "i"))
    stored = spark.read.parquet(str(tmp_path / "i/ipa_reversed"))
    found = index.rhymes(stored, "t æ")
    assert {r.word for r in found.collect()} == {"cat", "bat", "at"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(ipa_reversed," in plan and "EqualTo(ipa_reversed," in plan
    vowels = spark.read.parquet(str(tmp_path / "i/assonance_reversed"))
    assert {r.word for r in index.assonant(vowels, "æ").collect()} == {"cat", "bat", "cats", "at"} and index.lookup(spark.read.parquet(str(tmp_path / "i/word")), "tea").count() == 1
    with pytest.raises(ValueError, match="2 times"):
        index.admit(table.union(table))
    strange = spark.createDataFrame([("en", "wiktionary", "x", "/☂/")], "lang string, source string, word string, ipa string")
    with pytest.raises(Exception, match="not indexable"):
        index.build_index(strange).collect()
    told = sinks.export_sqlite(table, str(tmp_path / "en_v1.db"), "v1")
    db = sqlite3.connect(tmp_path / "en_v1.db")
    assert told == {"rows": 6, "words": 6} and db.execute("SELECT count(*) FROM dictionary WHERE ipa_reversed LIKE '/ t %'").fetchone() == (1,)
    with pytest.raises(Exception):
        sinks.export_sqlite(index.build_index(strange), str(tmp_path / "en_v1.db"), "v1")
    assert db.execute("SELECT count(*) FROM dictionary").fetchone() == (6,)  # the old one is still there


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / "in" / f"{k}.jsonl").write_text("".join(json.dumps({"lang_code": "en", "word": f"w{i}"}) + "\n" for i in range(5)))
    for _ in range(2):
        drops.follow(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 10 and len({(r.archive, r.line) for r in rows}) == 10
    assert all([r.word for r in sorted((x for x in rows if x.archive == a), key=lambda r: r.line)] == [f"w{i}" for i in range(5)] for a in {r.archive for r in rows})


def test_build(spark, tmp_path):
    said = {"tea": "tˈiː", "ox": "ˈɒks", "lemon": "lˈɛmən", "mute": ""}
    words = [("tea", "/ˈti/"), ("Tea", "/'tiː/"), ("ox", "/Ox/"), ("lemon", None), ("mute", None), ("x", None), ("a+b", "/ˈa/")]
    dump = tmp_path / "dump.jsonl.gz"
    dump.write_bytes(gzip.compress("".join(json.dumps({"lang_code": "en", "word": w, "sounds": [{"ipa": i}] if i else []}) + "\n" for w, i in words).encode()))
    make = lambda engine="1": build.Build(spark, str(tmp_path / "out"), "v1", lambda lang, ws: [said[w] for w in ws], engine, ("en",))
    first = make()
    made = first.from_dumps([str(dump)])
    assert [os.path.basename(p) for p in made] == ["en_v1.db", "en_espeak_v1.db"] and first.ran == ["extract", "prepare", "generate", "validate", "index"]
    out = tmp_path / "out"
    assert (out / "en/wordlist_en_eligible.txt").read_text() == 'tea\t["/ˈti/","/ˈtiː/"]\n'
    assert (out / "en/wordlist_en_espeak_eligible.txt").read_text() == 'lemon\t["lˈɛmən"]\nox\t["ˈɒks"]\n' and (out / "en/empty_words.txt").read_text() == "mute\n"
    report = json.loads((out / "report.json").read_text())["step_reports"]
    assert report["en_entries"]["counts"] == {"input": 7, "removed": 2, "retained": 4, "merged": 1} and report["en"] == {"rows": 2, "words": 1}
    assert json.loads((out / "en/reports/rejected.json").read_text())["groups"][0]["reason"] == "mixed_uppercase_notation"
    assert "- merged: 1" in (out / "en/reports/summary.md").read_text() and '<p>"a+b"</p>' in (out / "en/reports/summary.md").read_text()
    assert json.loads((out / "en/reports/ipa_reversal.json").read_text())["pronunciations"] == 2
    before = (out / "SHA256SUMS").read_text()
    assert len(before.splitlines()) == 2
    again = make()
    again.from_dumps([str(dump)])
    assert again.ran == [] and (out / "SHA256SUMS").read_text() == before
    lists = build.Build(spark, str(tmp_path / "lists"), "v2", lambda lang, ws: [said[w] for w in ws], "1", ("en",))
    lists.from_lists({("en", "wiktionary"): str(out / "en/wordlist_en_eligible.txt"), ("en", "espeak"): str(out / "en/wordlist_en_espeak_eligible.txt")})
    assert (tmp_path / "lists/en/wordlist_en_espeak_eligible.txt").read_text() == (out / "en/wordlist_en_espeak_eligible.txt").read_text()


def test_command_line(spark, tmp_path):
    dump, engine = tmp_path / "d.jsonl", tmp_path / "engine"
    dump.write_text('{"lang_code": "tr", "word": "su", "sounds": [{"ipa": "/ˈsu/"}]}\n')
    engine.write_text(f"#!{sys.executable}\nimport sys\nprint('toy') if '--version' in sys.argv else [print('ˈ' + w.strip()) for w in sys.stdin]\n")
    engine.chmod(0o755)
    cli.main(["report", str(dump), "--out", str(tmp_path / "r.json")])
    assert json.loads((tmp_path / "r.json").read_text())["archives"][0]["size_bytes"] == dump.stat().st_size
    cli.main(["build", str(dump), "--out", str(tmp_path / "o"), "--release-version", "v3", "--engine", str(engine), "--language", "tr"])
    assert (tmp_path / "o/tr/tr_v3.db.gz").exists()


def test_sample_and_names(spark):
    words = spark.createDataFrame([(lang, "wiktionary", f"w{i}") for lang in ("en", "tr") for i in range(40)], "lang string, source string, word string")
    a = build.sample(words, 5)
    assert a.count() == 10 and a.exceptAll(build.sample(words.repartition(3), 5)).count() == 0
    assert build.sample(words, 40, a).count() == 70 and build.release_name("Mon, 02 Mar 2026 23:30:00 -0100") == "v20260303"
    assert pronounce.toy("en", ["chin"]) == ["/ˈtʃɪn/"]
