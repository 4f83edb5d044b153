"""Normalised phoneme tokens: the same patterns as Catalyst expressions and as Python functions."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from klangwerk.functions import inventory as inv

WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFC")


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of the value, which is computed once however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def _prepared(ipa: Column, espeak: bool, normalised: bool) -> Column:
    swapped = F.translate(ipa, "\u200d\u200c" + ("_" if espeak else ""), "\u0361." + ("." if espeak else ""))
    return strip(swapped) if normalised else nfc(strip(swapped))


def tokens(ipa: Column, lang: str, espeak: bool = False, normalised: bool = False) -> Column:
    """array<string>; `normalised` says that ipa is NFC already, which keeps the plan inside the JVM."""
    found = F.regexp_extract_all(_prepared(ipa, espeak, normalised), F.lit(inv.token_pattern(lang)), F.lit(1))
    return F.transform(found, lambda t: F.regexp_replace(t, inv.char_class(inv.SEPARATORS), ""))


def is_marker(t: Column) -> Column:
    return t.rlike(f"^{inv.MARK}$")


def is_vowel(t: Column, lang: str) -> Column:
    return t.rlike(inv.vowel_pattern(lang))


def is_nucleus(t: Column, lang: str) -> Column:
    return is_vowel(t, lang) | t.rlike(inv.NUCLEUS)


def unknown(found: Column, lang: str) -> Column:
    return F.filter(found, lambda t: ~t.rlike(inv.known_pattern(lang)))


def known(found: Column, lang: str) -> Column:
    """The tokens; an error that names the first one outside the language's inventory."""
    strange = unknown(found, lang)
    return F.when(F.size(strange) > 0, F.raise_error(F.concat(F.lit(f"{lang}: unrecognized sound: "), strange[0]))).otherwise(found)


def phonemes(found: Column) -> Column:
    return F.filter(found, lambda t: ~is_marker(t))


def assonance_key(found: Column, lang: str) -> Column:
    return F.array_join(F.filter(F.reverse(found), lambda t: is_vowel(t, lang)), " ")


def _classes(found: Column, lang: str) -> Column:
    stress = inv.char_class(inv.STRESS)
    letter = lambda t: F.when(t.rlike(f"^{stress}$"), "S").when(is_nucleus(t, lang), "N").otherwise("x")
    return F.array_join(F.transform(found, letter), "")


def misplaced_stress(found: Column, lang: str) -> Column:
    return _classes(found, lang).rlike("S[^N]*(S|$)")


def rhyme_tail(found: Column, lang: str) -> Column:
    """From the first nucleus after the last stress mark, without tone marks; empty without one."""

    def cut(classes: Column) -> Column:
        last = F.length(classes) - F.locate("S", F.reverse(classes)) + 1
        nucleus = F.locate("N", F.substr(classes, last + 1))
        tail = F.filter(F.slice(found, last + nucleus, F.size(found)), lambda t: ~is_marker(t))
        return F.when((F.locate("S", classes) > 0) & (nucleus > 0), tail).otherwise(F.array().cast("array<string>"))

    return let(_classes(found, lang), cut)


@lru_cache(None)
def compiled(kind: str, lang: str) -> regex.Pattern:
    pattern = {"token": inv.token_pattern, "known": inv.known_pattern, "vowel": inv.vowel_pattern}[kind](lang)
    return regex.compile(inv._python(pattern))


_SEPARATOR = regex.compile(inv._python(inv.char_class(inv.SEPARATORS)))


def py_tokens(ipa: str, lang: str, espeak: bool = False) -> list[str]:
    import unicodedata

    ipa = ipa.replace("\u200d", "\u0361").replace("\u200c", ".")
    ipa = unicodedata.normalize("NFC", (ipa.replace("_", ".") if espeak else ipa).strip())
    return [_SEPARATOR.sub("", m[1]) for m in compiled("token", lang).finditer(ipa)]


def py_unknown(found: list[str], lang: str) -> list[str]:
    known = compiled("known", lang)
    return [t for t in found if not known.match(t)]


def py_is_marker(t: str) -> bool:
    return len(t) == 1 and t in inv.STRESS + inv.PROSODY


def py_is_nucleus(t: str, lang: str) -> bool:
    return bool(compiled("vowel", lang).match(t)) or "\u0329" in t or "\u030d" in t


def py_rhyme_tail(found: list[str], lang: str) -> list[str]:
    last = max((i for i, t in enumerate(found) if t in inv.STRESS), default=None)
    if last is None:
        return []
    start = next((i for i in range(last + 1, len(found)) if py_is_nucleus(found[i], lang)), None)
    return [] if start is None else [t for t in found[start:] if not py_is_marker(t)]


def edit_distance(left: Column, right: Column) -> Column:
    """Levenshtein distance of token arrays: tokens become private-use letters for the built-in function."""

    def coded(vocabulary: Column) -> Column:
        letter = lambda t: F.decode(F.unhex(F.lpad(F.hex(F.array_position(vocabulary, t) + F.lit(0xE000)), 4, "0")), "UTF-16BE")
        word = lambda a: F.array_join(F.transform(a, letter), "")
        return F.levenshtein(word(left), word(right))

    return let(F.array_distinct(F.concat(left, right)), coded)


def compare(source: Column, engine: Column, lang: str) -> Column:
    """How a source pronunciation's tokens differ from an engine's."""

    def told(x: Column) -> Column:
        edits, longest = x["edits"], F.greatest(F.size(x["a"]), F.size(x["b"]))
        left, right = x["left"], x["right"]
        return F.struct(
            edits.alias("phoneme_edits"), F.when(longest > 0, edits / longest).otherwise(0.0).alias("phoneme_distance_ratio"),
            F.size(x["a"]).alias("wiktionary_phoneme_count"), F.size(x["b"]).alias("espeak_phoneme_count"),
            left.alias("wiktionary_rhyme_tail"), right.alias("espeak_rhyme_tail"),
            ((F.size(left) > 0) & (F.size(right) > 0) & (left == right)).alias("rhyme_tail_matches"),
        )

    both = F.struct(phonemes(source).alias("a"), phonemes(engine).alias("b"), rhyme_tail(source, lang).alias("left"), rhyme_tail(engine, lang).alias("right"))
    return let(both, lambda x: let(F.struct(x["a"].alias("a"), x["b"].alias("b"), x["left"].alias("left"), x["right"].alias("right"), edit_distance(x["a"], x["b"]).alias("edits")), told))


def extreme(c: Column, threshold: float = 0.8) -> Column:
    fewest = F.least(c["wiktionary_phoneme_count"], c["espeak_phoneme_count"])
    return (c["phoneme_distance_ratio"] >= threshold) & (c["phoneme_edits"] >= 4) & (fewest >= 5)
