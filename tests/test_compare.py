import re

from klangwerk.operators import validate
from klangwerk.plans import registry

SOUNDS = {"en": "aɪ|aʊ|eɪ|oʊ|tʃ|.", "de": "aɪ|aʊ|ʊɪ|tʃ|pf|ts|.", "tr": "tʃ|."}
TEXTS = {"en": "chain such out boy church level hid", "de": "pfau zuischen katse achtung otto", "es": "chico muchacho ana ok"}


def toy(word):
    return "/ˈ" + word.translate(str.maketrans("iu", "ɪʊ")).replace("ch", "tʃ") + "/"


def distance(lang, a, b):
    a, b = (re.findall(SOUNDS[lang], x[2:-1]) for x in (a, b))
    before = list(range(len(b) + 1))
    for i, x in enumerate(a):
        now = [i + 1]
        for j, y in enumerate(b):
            now.append(min(before[j] + (x != y), before[j + 1] + 1, now[j] + 1))
        before = now
    return before[-1], max(len(a), len(b)), min(len(a), len(b))


def test_all_words_compared(spark, tmp_path):
    docs = [(i, text, lang) for i, (lang, text) in enumerate(TEXTS.items())]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    words = {("tr" if lang == "es" else lang, w) for lang, text in TEXTS.items() for w in text.split()}
    far, extreme, near = {}, {}, {}
    for lang, w in words:
        d, n, least = distance(lang, toy(w), toy(w[::-1]))
        far[lang, w] = d, round(d / n, 9)
        key = lang, d / n >= 0.8 and d >= 4 and least >= 5
        extreme[key] = extreme.get(key, 0) + 1
        variants = {}
        for k, v in enumerate((toy(w[::-1]), toy(w + "a"))):
            d, n, _ = distance(lang, toy(w), v)
            variants[d / n, d, k] = v
        near[lang, w] = variants[min(variants)]
    run = lambda name: registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert {(r.lang, r.word): (r.phoneme_edits, round(r.phoneme_distance_ratio, 9)) for r in run("phoneme_distance")} == far
    assert {(r.lang, r.extreme): r.words for r in run("extreme_mismatch")} == extreme
    assert {(r.lang, r.word): r.closest for r in run("closest_variant")} == near


def test_first_of_equally_close(spark):
    own = spark.createDataFrame([("tr", "ab", "/ˈab/")], "lang string, word string, ipa string")
    other = spark.createDataFrame([("tr", "ab", 0, "/ˈad/"), ("tr", "ab", 1, "/ˈaf/"), ("tr", "ab", 2, "/ˈaa/")], "lang string, word string, position int, ipa string")
    assert validate.compare(own, other).first().espeak_ipa == "/ˈad/"
