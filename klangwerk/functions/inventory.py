"""Sound inventories and the patterns built from them. Patterns serve Java's engine and Python's `regex` alike."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

# They must equal the released data's inventories.
LANGUAGES = ("en", "de", "tr")
VOWELS = {
    "en": "a e i o u y æ ɑ ɒ ɔ ə ɛ ɚ ɘ ɜ ɝ ɞ ɤ ɨ ɪ ɯ ɵ ʉ ʊ ʌ ʏ ø œ ɐ ᵊ ᵻ ᵿ aɪ aʊ eɪ oʊ ɔɪ əʊ ɪə eə ʊə".split(),
    "de": "a e i o u y æ ɑ ɒ ɔ ə ɛ ɐ ɘ ɜ ɝ ɚ ɤ ɨ ɪ ɯ ɶ ɵ ʉ ʊ ʌ ʏ ø œ ᵊ aɪ aʊ ɔʏ oʏ ʊɪ".split(),
    "tr": "a e i o u y ä æ ɑ ɒ ɔ ə ɛ ɐ ɜ ɚ ɞ ɤ ɨ ɪ ɯ ɶ ʊ ʌ ʏ ø œ".split(),
}
CONSONANTS = {
    "en": "b c d f g h j k l m n p r q s t v w x z ç ð β ɓ ɕ ɖ ɗ ɟ ɢ ɡ ɣ ɥ ɦ ɫ ɬ ɭ ɱ ɲ ɳ ɸ ɹ ɺ ɻ ɽ ɾ ʀ ʁ ʂ ʃ ʈ ʋ ʎ ʑ ʒ ʔ ʕ ʝ ʟ ʙ ʍ θ χ ŋ ł ǀ ǁ ǃ ʤ tʃ dʒ t͡ʃ d͡ʒ t͜ʃ d͜ʒ".split(),
    "de": "b c d f g h j k l m n p q r s t v w x z ç ð β ɓ ɕ ɟ ɡ ɣ ɥ ɦ ɫ ɬ ɮ ɱ ɲ ɴ ɸ ɹ ɺ ɽ ɾ ʀ ʁ ʂ ʃ ʈ ʋ ʎ ʑ ʒ ʔ ʕ ʝ ʟ ʙ θ χ ŋ ħ ɰ ʦ ʧ ǀ ǁ ǃ pf ts tʃ dʒ p͡f t͡s t͡ʃ d͡ʒ p͜f t͜s t͜ʃ d͜ʒ".split(),
    "tr": "b c d f g h j k l m n p q r s t v w x z ç β ɕ ɟ ɡ ɣ ɥ ɦ ɫ ɰ ɱ ɲ ɳ ɸ ɹ ɾ ł ʀ ʁ ʃ ʈ ʋ ʎ ʑ ʐ ʒ ʔ ʕ ʝ θ χ ŋ ʧ ʤ ǀ ǁ ǃ tʃ dʒ t͡ʃ d͡ʒ t͜ʃ d͜ʒ".split(),
}
STRESS = "ˈˌ"
SEPARATORS = " ./[]()⟨⟩⁽⁾|‿⁀‖⫽\ufe0e"
PROSODY = "˥˦˧˨˩¹²³⁴⁵⁻↗↘↑↓ꜛꜜ"
# the combining marks by their code points
POSTFIX = ":ːˑ\u0306\u032f\u0303\u0325\u032c\u0329\u032a\u033a\u033b\u031d\u031e\u0318\u0319\u031a\u0330\u0324\u0339\u031c\u031f\u0320\u033c\u033dˀ˔˭ʰʱʲˠˤʴʷⁿˡ˞ʳʵʶˣ˕˖ᵈᵏᵐᵝᶦᶴ"
PREFIX = "ˀʰʱʲˠˤʷⁿˡᵈᵏᵐ"
TIES = "\u035c\u0361\u200d"
CODEC_PREFIX = PREFIX + "ᵑᶮ"
CODEC_POSTFIX = POSTFIX + "ʼ"
BOUNDARIES = SEPARATORS + "~·,;-#‧\u200c"
LEGACY = "ʦʧʤ"
MIRRORED = {"[": "]", "(": ")", "⟨": "⟩", "⁽": "⁾"}
PLACEHOLDERS = ("", "?", "-", "...", "…", "[]", "//", "[...]", "[…]", "/.../", "/…/", "[?]", "/?/")
FRAGMENT_DASHES = "-\u2010\u2011\u2012\u2013\u2014\u2015\u2212\u00ad"
HEADWORD_LETTERS = (
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    "ÄÖÜẞäöüß" "ÂÇĞÎİÖŞÛÜâçğîıöşûü" "ÀÂÆÇÈÉÊËÎÏÔŒÙÛÜŸàâæçèéêëîïôœùûüÿ"
    "ÁÃÅÐÍÌÑÒÓÕØÚÝÞáãåðíìñòóõøúýþ"
    "ĀĂĄĆĈČĎĐĒĖĘĢĤĪĮĶĹĻĽŁŃŅŇŐŔŖŘŚŜŠŢŤŪŬŰŲŴŶŹŻŽƏ"
    "āăąćĉčďđēėęģĥīįķĺļľłńņňőŕŗřśŝšţťūŭűųŵŷźżžə" "ʻ"
)
APOSTROPHES, DASHES, SUBSCRIPTS = "’‘ʼ", "‐‑‒–—−", "₀₁₂₃₄₅₆₇₈₉"
POLICY = "rhyme-cleanup-v19"
MAX_OPTIONAL_VARIANTS = 8
# End of fixed values.


def char_class(chars: str, extra: str = "") -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" if ord(c) < 128 else c for c in dict.fromkeys(chars)) + extra + "]"


def _java(pattern: str) -> str:
    return pattern


def _python(pattern: str) -> str:
    import re

    return re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\x{int(m[1], 16):02x}", pattern)


def _escape(symbol: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" if ord(c) < 128 and not c.isalnum() else c for c in symbol)


MODIFIER = f"(?:(?!{char_class(SEPARATORS)})" + char_class(POSTFIX, r"\p{Mn}\p{Me}") + ")"
MARK = char_class(STRESS + PROSODY)
_SEP = char_class(SEPARATORS)


def _modifies(c: str) -> bool:
    return c not in SEPARATORS and (c in POSTFIX or unicodedata.category(c) in ("Mn", "Me"))


@lru_cache(None)
def composed(lang: str, vowels_only: bool = False) -> str:
    """Precomposed letters that stand for an inventory letter with modifiers."""
    known = {p for p in VOWELS[lang] + ([] if vowels_only else CONSONANTS[lang]) if len(p) == 1}
    found = (chr(i) for i in range(0xC0, 0x3000) if chr(i) not in known)
    parts = ((c, unicodedata.normalize("NFD", c)) for c in found)
    return "".join(c for c, d in parts if len(d) > 1 and d[0] in known and all(map(_modifies, d[1:])))


def _alternatives(symbols: list[str], more: str) -> str:
    longest_first = sorted(set(symbols), key=lambda p: (-len(p), p))
    return "(?:" + "|".join([*map(_escape, longest_first), *([char_class(more)] if more else [])]) + ")"


@lru_cache(None)
def base_pattern(lang: str) -> str:
    return _alternatives(VOWELS[lang] + CONSONANTS[lang], composed(lang))


@lru_cache(None)
def token_pattern(lang: str) -> str:
    """A normalised token with the separators that lie inside it."""
    base, pre = base_pattern(lang), char_class(PREFIX)
    led = f"{pre}{MODIFIER}*+{base}"
    return (
        f"({MARK}|(?:(?<![^{_SEP[1:-1]}{MARK[1:-1]}]){led}{MODIFIER}*+|{MODIFIER}++|{base}{MODIFIER}*+|[^{_SEP[1:-1]}]{MODIFIER}*+)"
        f"(?:{_SEP}++(?!{led}){MODIFIER}++)*+)"
    )


@lru_cache(None)
def known_pattern(lang: str) -> str:
    return f"^(?:{MARK}|(?:{char_class(PREFIX)}{MODIFIER}*+)?{base_pattern(lang)}{MODIFIER}*+)$"


@lru_cache(None)
def vowel_pattern(lang: str) -> str:
    return f"^{char_class(PREFIX)}*(?:{_alternatives(VOWELS[lang], composed(lang, True))})"


NUCLEUS = "[\u0329\u030d]"
