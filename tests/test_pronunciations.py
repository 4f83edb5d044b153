"""Cleaning of pronunciations, on cases made from its rules."""

import sys

import pytest
from pyspark.sql import functions as F

from klangwerk.functions import pronunciations as pr
from klangwerk.functions import headwords as hw
from klangwerk.operators import prepare, pronounce, validate

CASES = {
    # field: (variants, changes, reasons)
    "/ˈlamo/": (["/ˈlamo/"], [], []),
    "  [ˈpɛ.nə] ": (["[ˈpɛ.nə]"], [], []),
    "/ˈo~ˈu ~ a/": (["/ˈo/", "/ˈu/", "/a/"], ["split_tilde_alternatives"], []),
    "/ˈo/ ~ [ˈu]": (["/ˈo/", "[ˈu]"], ["split_tilde_alternatives"], []),
    "/ˈo~/": ([], [], ["ambiguous_tilde_notation"]),
    "ˈo ~ ˈu": ([], [], ["ambiguous_tilde_notation"]),
    "/ˈo/, /ˈu/": (["/ˈo/", "/ˈu/"], ["split_wrapped_comma_alternatives"], []),
    "ˈo, ˈu": ([], [], ["ambiguous_comma_notation"]),
    "/ˈmi(n)a(s)/": (["/ˈmia/", "/ˈmias/", "/ˈmina/", "/ˈminas/"], ["expand_optional_groups"], []),
    "/ˈo(n)/, /ˈo(n)/": (["/ˈo/", "/ˈon/"], ["split_wrapped_comma_alternatives", "expand_optional_groups"], []),
    "/(a)(e)(i)(o)/": ([], [], ["too_many_optional_variants"]),
    "/b(a)(a)(a)(a)/": (["/b/", "/ba/", "/baa/", "/baaa/", "/baaaa/"], ["expand_optional_groups"], []),
    "/(a)(e)(i)/, /(o)/": ([], ["split_wrapped_comma_alternatives", "expand_optional_groups"], ["too_many_optional_variants"]),
    "/a()/": ([], [], ["invalid_optional_group"]),
    "/a(e/": ([], [], ["invalid_optional_group"]),
    "/ˈo(n)/, /a)/": ([], ["split_wrapped_comma_alternatives", "expand_optional_groups"], ["invalid_optional_group"]),
    "o (n)": (["o ", "o n"], ["expand_optional_groups"], []),  # what a group leaves is kept as written
    "/'li·na/": (["/ˈli.na/"], ["normalize_ascii_stress", "normalize_middle_dot"], []),
    "/ /": ([], [], ["empty_pronunciation"]),
    "": ([], [], ["empty_pronunciation"]),
    "/ˈ/": ([], [], ["empty_pronunciation"]),
    "/˥/": ([], [], ["empty_pronunciation"]),
    "/ˈka.../": ([], [], ["incomplete_pronunciation"]),
    "-ˈka": ([], [], ["incomplete_pronunciation"]),
    "/ˈa/b/": ([], [], ["invalid_delimiters"]),
    "/ˈKa/": ([], [], ["mixed_uppercase_notation"]),
    "/ˈαa/": ([], [], ["non_ipa_orthographic_symbol"]),
    "/ˈkı/": ([], [], ["orthographic_dotless_i"]),
    "/ˈa☂☂b☂/": ([], [], ["unrecognized_tokens"]),
    "/ˈs/": ([], [], ["misplaced_stress_mark"]),
    "/ˈs̩/": (["/ˈs̩/"], [], []),
    "/\u0007ˈa/": ([], [], ["embedded_control"]),
    "/ˈé/": (["/ˈé/"], [], []),  # composed
}


def test_cleaning(spark):
    rows = spark.createDataFrame([(ipa, "en") for ipa in CASES] + [(None, "en"), ("/a/", "fr")], "ipa string, lang string")
    out = {(r.ipa, r.lang): r for r in pr.with_cleaned(rows).collect()}
    got = {ipa: (out[ipa, "en"].valid, out[ipa, "en"].changes, [x.reason for x in out[ipa, "en"].rejects]) for ipa in CASES}
    assert got == CASES
    strange = out["/ˈa☂☂b☂/", "en"].rejects[0]
    assert sum(strange.tokens.values()) == 3 and strange.candidate == "/ˈa☂☂b☂/" and out["-ˈka", "en"].rejects[0].characters == ["-"]
    assert out[None, "en"].valid is None and out["/a/", "fr"].rejects is None


def test_headwords(spark):
    rows = [("Straße", "de"), ("IŞIK", "tr"), ("Işık", "tr"), ("N.A.T.O.", "en"), ("x", "en"), ("7", "en"), ("co­op", "en"), ("it’s", "en"), ("a+b", "en"), ("", "en"), ("ét", "en"), ("İz", "en")]
    out = {r.word: (r.h.word, r.h.changes, r.h.reason) for r in hw.with_clean_headword(spark.createDataFrame(rows, "word string, lang string")).collect()}
    assert out["Straße"] == ("straße", ["lowercase"], None) and out["Işık"] == ("ışık", ["lowercase"], None)
    assert out["N.A.T.O."][2] == out["IŞIK"][2] == "uppercase_abbreviation" and out["x"][2] == "single_letter_headword" and out["7"][2] is None
    assert out["co­op"] == ("coop", ["remove_soft_hyphen"], None) and out["it’s"] == ("it's", ["normalize_apostrophe"], "disallowed_headword_characters")
    assert out["a+b"][2] == out["İz"][2] == "disallowed_headword_characters" and out[""][2] == "empty_headword_after_normalization" and out["ét"][1] == ["normalize_nfc"]


ENGINE = """#!{python}
import sys
if sys.argv[1:] == ["--version"]:
    print("toy 1")
elif "xx" in sys.argv:
    sys.exit("no such voice")
else:
    for word in sys.stdin.read().splitlines():
        for part in ([] if word == "mute" else word.split("-") if word != "echo" else ["fence"]):
            print(" " + part.upper())
"""


@pytest.fixture(scope="module")
def engine(tmp_path_factory):
    path = tmp_path_factory.mktemp("bin") / "engine"
    path.write_text(ENGINE.format(python=sys.executable))
    path.chmod(0o755)
    return str(path)


def test_engine(engine):
    call = pronounce.command(pronounce.resolve(engine))
    assert call("en", ["tea", "mute", "pea-nut", "mute", "ox"]) == ["TEA", "", "PEA NUT", "", "OX"]
    assert call("en", ["tea", "echo", "mute"]) == ["TEA", "FENCE", ""]  # sounds like the fence: asked alone
    assert call("en", []) == [] and pronounce.version(engine) == "toy 1"
    with pytest.raises(RuntimeError):
        call("xx", ["tea"])
    with pytest.raises(FileNotFoundError):
        pronounce.resolve("no-such-engine")
    assert pronounce.arguments("de", True) == ["-q", "--ipa", "--sep=_", "-D", "-v", "de"]


def test_pronounce(spark, engine):
    words = spark.createDataFrame([("en", "tea"), ("de", "mute"), ("en", "mute"), ("de", "ei")], "lang string, word string")
    told, empty = pronounce.generated(pronounce.pronounce(words, pronounce.command(engine), batch=1))
    assert sorted(map(tuple, told.collect())) == [("de", "ei", "EI"), ("en", "tea", "TEA")]
    assert sorted(map(tuple, empty.collect())) == [("de", "mute"), ("en", "mute")]


RAW = "lang string, has_ipa boolean, archive int, line long, word string, word_json string, fields array<struct<is_text boolean, value string, json string>>"


def raw(line, word, *ipas, archive=0):
    return ("en", bool(ipas), archive, line, word, f'"{word}"' if word else "7", [(True, i, f'"{i}"') for i in ipas])


def test_prepare_events(spark):
    rows = [raw(0, "Tea", "/ˈti/", "?", "/ˈti/"), raw(1, "tea", "/ˈti/", "/'ti/", "/ti/"), raw(2, "a+b"), raw(3, None), raw(4, "mute"), raw(5, "TEA-"), raw(6, "x")]
    p = prepare.prepare(spark.createDataFrame(rows, RAW), normalised=True)
    got = {r.rule: (r.occurrences, r.affected_entries) for r in prepare.rule_counts(p.events).collect()}
    assert got == {
        "lowercase": (1, 1), "merged_duplicate": (0, 1), "unusable_ipa_field": (1, 1), "duplicate_ipa": (2, 2), "normalize_ascii_stress": (1, 1), "duplicate_normalized_ipa": (1, 1),
        "missing_stress_mark": (1, 1), "disallowed_headword_characters": (2, 2), "missing_text_headword": (1, 1), "single_letter_headword": (1, 1),
    }
    assert [tuple(r) for r in prepare.counts(p.entries).collect()] == [("en", 7, 4, 2, 1)]
    assert {r.reason: r.originals for r in prepare.excluded(p.entries).collect()}["disallowed_headword_characters"] == ['"TEA-"', '"a+b"']
    assert sorted(r.word for r in p.missing.collect()) == ["mute"] and [r.ipa for r in p.clean.collect()] == ["/ˈti/"]


def test_clean_wordlist(spark):
    rows = [("en", 0, "Tea", ["b", "a"]), ("en", 1, "tea", ["a", "c"]), ("en", 2, "x", ["d"])]
    good, bad, changed = prepare.clean_wordlist(spark.createDataFrame(rows, "lang string, pos long, word string, ipas array<string>"), normalised=True)
    assert [tuple(r) for r in good.collect()] == [("en", 0, "tea", ["b", "a", "c"])]
    assert [r.reason for r in bad.collect()] == ["single_letter_headword"] and [r.word for r in changed.collect()] == ["tea"]


def test_validate(spark):
    make = lambda rows, more="": spark.createDataFrame(rows, "lang string, word string, ipa string" + more)
    clean = make([("en", "tea", "/ˈti/", 0), ("en", "lemon", "/ˈlɛmən/", 1), ("en", "bare", "/ba/", 2)], ", position long")
    repairs = make([("en", "ox", "/Ox/", "mixed_uppercase_notation"), ("en", "mute", "-", "incomplete_pronunciation")], ", reason string")
    fresh = make([("en", "ox", "/ˈɑks/"), ("en", "tea", "/ti/"), ("en", "lemon", "/ˈzyzɨtʌs/"), ("en", "bare", "/bɛɹ/"), ("en", "mute", "☂")])
    v = validate.validate(clean, clean.limit(0).drop("position"), repairs, fresh, replace_extreme=True)
    assert sorted((r.word, r.ipa) for r in v.source.collect()) == [("tea", "/ˈti/")]
    assert sorted((r.word, r.ipa) for r in v.machine.collect()) == [("bare", "/bɛɹ/"), ("lemon", "/ˈzyzɨtʌs/"), ("ox", "/ˈɑks/")]
    assert [tuple(r) for r in v.failed.collect()] == [("en", "mute")]
    with pytest.raises(ValueError, match="mute"):
        validate.stop_on(v.failed)
    n = {r.counter: r.n for r in v.counters.collect()}
    assert n == {
        "wiktionary_input_words": 3, "wiktionary_input_pronunciations": 3, "wiktionary_output_words": 1, "wiktionary_output_pronunciations": 1, "espeak_output_words": 3, "espeak_output_pronunciations": 3,
        "rejected_candidates": 4, "regeneration_requested_words": 3, "comparison_requested_words": 5, "regenerated_words": 2, "regeneration_failed_words": 1, "compared_variants": 2,
        "extreme_replaced_variants": 1, "reported_comparison_variants": 1,
    }
    assert {r.reason: r.ipas for r in validate.grouped(v.rejected).collect()}["missing_stress_mark"] == ["/ba/"]
    assert {r.word: r.reasons for r in validate.lookup_reasons(v.rejected).collect()}["ox"] == ["mixed_uppercase_notation"]
    assert sorted((r.position, r.word) for r in validate.requests(clean, repairs).collect()) == [(0, "mute"), (0, "ox"), (1, "tea"), (2, "lemon"), (3, "bare")]


def test_unknown_sounds_raise(spark):
    one = spark.createDataFrame([("en", "a", "/ˈ☂/")], "lang string, word string, ipa string")
    with pytest.raises(Exception, match="unrecognized sound"):
        validate.compare(one, one).collect()
