"""Named queries over the driver's tables and their SQL counterparts.

The tables hold no pronunciations, so a lexicon is derived: words of documents (es is taken as tr to
exercise Turkish casing, fr is outside the release), and a toy engine that spells words of letters in IPA.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.functions import codec
from klangwerk.functions import headwords as hw
from klangwerk.functions import inventory as inv
from klangwerk.functions import pronunciations as pr
from klangwerk.functions import tokens as tk
from klangwerk.operators import audit, index, legacy, prepare, validate
from klangwerk.sources import dumps

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; a table that comes in fewer parts than there are cores is dealt out first."""
    docs, cores = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


def _lang(c: Column) -> Column:
    return F.when(c == "es", "tr").otherwise(c)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, doc_id, word) of every word of the documents in a release language."""
    docs = _documents(spark, sf_dir).select("doc_id", _lang(F.col("lang")).alias("lang"), "text")
    docs = docs.where(F.col("lang").isin(*inv.LANGUAGES))
    return docs.select("lang", "doc_id", F.explode(F.split("text", "[ \n]+")).alias("word")).where("word <> ''")


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, word, records): each distinct word once, so that what is done to a word is done once."""
    return words(spark, sf_dir).groupBy("lang", "word").agg(F.count("*").alias("records"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hw.with_clean_headword(vocabulary(spark, sf_dir), normalised=True)


#: Letters that the toy engine can say: those of headwords whose sounds all inventories hold, and two that it writes otherwise.
_SAYABLE = "".join(c for c in dict.fromkeys(inv.HEADWORD_LETTERS.lower()) if c in "ßı" or all(c in inv.VOWELS[x] + inv.CONSONANTS[x] or c in inv.composed(x) for x in inv.LANGUAGES))
_VOWELS = "aeɪoʊyɯ" + "".join(c for c in _SAYABLE if ord(c) > 127 and all(c in inv.VOWELS[x] or c in inv.composed(x, True) for x in inv.LANGUAGES))


def spelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(lang, source, word, ipa): distinct words of letters in the toy engine's IPA."""
    found = words(spark, sf_dir).select("lang", F.lower("word").alias("word")).distinct().where(F.col("word").rlike(f"^[{_SAYABLE}]{{2,}}$"))
    return found.select("lang", F.lit("wiktionary").alias("source"), "word", _toy(F.col("word")).alias("ipa"))


def _toy(w: Column) -> Column:
    return F.concat(F.lit("/ˈ"), F.replace(F.translate(w, "iußı", "ɪʊsɯ"), F.lit("ch"), F.lit("tʃ")), F.lit("/"))


def _by_lang(f: Callable[[str], Column]) -> Column:
    return F.coalesce(*[F.when(F.col("lang") == lang, f(lang)) for lang in inv.LANGUAGES])


def _sounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelled words with their tokens, in a column of their own: what reads them often doesn't find them anew."""
    return spelled(spark, sf_dir).withColumn("t", _by_lang(lambda lang: tk.tokens(F.col("ipa"), lang, normalised=True)))


# Shared pieces of the SQL side.
_LETTERS = inv.HEADWORD_LETTERS + "0-9"
_WORDS = """words AS (
  SELECT lang, doc_id, word FROM (
    SELECT CASE WHEN lang = 'es' THEN 'tr' ELSE lang END AS lang, doc_id, unnest(regexp_split_to_array(text, '[ \\n]+')) AS word FROM documents)
  WHERE lang IN ('en', 'de', 'tr') AND word <> '')"""
_SAY = "'/ˈ' || replace(translate({}, 'iußı', 'ɪʊsɯ'), 'ch', 'tʃ') || '/'"
_SOUNDS = "regexp_extract_all({0}[3:length({0}) - 1], CASE lang WHEN 'en' THEN 'aɪ|aʊ|eɪ|oʊ|tʃ|.' WHEN 'de' THEN 'aɪ|aʊ|ʊɪ|tʃ|pf|ts|.' ELSE 'tʃ|.' END)"
_SPELLED = f"""{_WORDS},
spelled AS (
  SELECT lang, word, {_SAY.format("word")} AS ipa
  FROM (SELECT DISTINCT lang, lower(word) AS word FROM words) WHERE regexp_matches(word, '^[{_SAYABLE}]{{2,}}$'))"""
_TOKENS = f"""{_SPELLED},
sounds AS (SELECT lang, word, ipa, {_SOUNDS.format("ipa")} AS t FROM spelled),
keyed AS (
  SELECT lang, word, ipa, t, array_to_string(list_reverse(list_concat(['/', 'ˈ' || t[1]], t[2:], ['/'])), ' ') AS key,
    array_to_string(list_filter(list_reverse(t), lambda x: regexp_matches(x, '^[{_VOWELS}]')), ' ') AS assonance FROM sounds)"""
_CLASSIFIED = f"""{_WORDS},
headwords AS (
  SELECT lang, doc_id, word, CASE
    WHEN regexp_matches(replace(word, '.', ''), '^\\p{{L}}{{2,}}$') AND upper(replace(word, '.', '')) = replace(word, '.', '') AND NOT regexp_matches(word, '[\\p{{Ll}}\\p{{Lt}}ßªº]') AND regexp_matches(word, '\\p{{Lu}}') THEN 'uppercase_abbreviation'
    WHEN regexp_matches(translate(word, '’‘ʼ‐‑‒–—−', '''''''------'), '[^{_LETTERS}]') THEN 'disallowed_headword_characters'
    WHEN length(word) = 1 AND NOT regexp_matches(word, '[0-9]') THEN 'single_letter_headword' END AS reason,
    lower(CASE WHEN lang = 'tr' THEN translate(word, 'Iİ', 'ıi') ELSE word END) AS headword FROM words)"""


@_query("""SELECT CASE WHEN lang = 'es' THEN 'tr' ELSE lang END AS lang, lang IN ('en', 'de', 'es') AS selected, count(*) AS records
FROM documents GROUP BY 1, 2""")
def language_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(_lang(F.col("lang")).alias("lang"))
    return docs.groupBy("lang", F.col("lang").isin(*inv.LANGUAGES).alias("selected")).agg(F.count("*").alias("records"))


def _dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as lines of a dump: every tenth is cut short, every eleventh is no object."""
    sound = F.array(F.struct(F.when(F.col("doc_id") % 3 == 0, "?").otherwise(F.concat(F.lit("/ˈ"), F.col("source"), F.lit("/"))).alias("ipa")))
    entry = F.to_json(F.struct(F.col("source").alias("word"), _lang(F.col("lang")).alias("lang_code"), F.when(F.col("doc_id") % 2 == 0, sound).alias("sounds")))
    line = F.when(F.col("doc_id") % 10 == 0, "{").when(F.col("doc_id") % 11 == 0, "[1]").otherwise(entry)
    return _documents(spark, sf_dir).select(F.lit(0).alias("archive"), F.col("doc_id").alias("line"), line.alias("value"), F.lit(True).alias("valid"))


@_query("""SELECT count(*) AS records_read, count(*) FILTER (doc_id % 10 = 0) AS bad_json_records,
  count(*) FILTER (doc_id % 10 <> 0 AND doc_id % 11 = 0) AS invalid_records,
  count(*) FILTER (doc_id % 10 <> 0 AND doc_id % 11 <> 0 AND lang IN ('en', 'de', 'es')) AS selected_records FROM documents""")
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.ingest_counts(dumps.parse(_dump(spark, sf_dir)))


@_query("""SELECT CASE WHEN lang = 'es' THEN 'tr' ELSE lang END AS lang, doc_id % 2 = 0 AS has_ipa, count(*) AS records FROM documents
WHERE doc_id % 10 <> 0 AND doc_id % 11 <> 0 AND lang IN ('en', 'de', 'es') GROUP BY 1, 2""")
def ipa_presence_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dumps.raw_entries(dumps.parse(_dump(spark, sf_dir))).groupBy("lang", "has_ipa").agg(F.count("*").alias("records"))


@_query("""SELECT doc_id % 3 <> 0 AS usable, count(*) AS fields FROM documents
WHERE doc_id % 10 <> 0 AND doc_id % 11 <> 0 AND doc_id % 2 = 0 AND lang IN ('en', 'de', 'es') GROUP BY 1""")
def placeholder_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = dumps.raw_entries(dumps.parse(_dump(spark, sf_dir))).select(F.explode("fields").alias("f"))
    return fields.groupBy((F.col("f.is_text") & pr.usable(F.col("f.value"))).alias("usable")).agg(F.count("*").alias("fields"))


@_query(f"""WITH {_CLASSIFIED}
SELECT lang, coalesce(reason, 'accepted') AS outcome, count(*) AS records, count(DISTINCT word) AS words FROM headwords GROUP BY 1, 2""")
def headword_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).groupBy("lang", F.coalesce("h.reason", F.lit("accepted")).alias("outcome")).agg(F.sum("records").alias("records"), F.count("*").alias("words"))


@_query(f"""WITH {_CLASSIFIED}
SELECT lang, headword, count(*) AS records FROM headwords WHERE reason IS NULL GROUP BY 1, 2""")
def headword_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.when(F.col("h.reason").isNull(), F.col("h.word"))
    return _cleaned(spark, sf_dir).groupBy("lang", kept.alias("headword")).agg(F.sum("records").alias("records")).where("headword is not null")


@_query(f"""WITH {_WORDS}
SELECT lang, character, count(*) AS occurrences FROM (
  SELECT lang, unnest(regexp_extract_all(translate(word, '’‘ʼ‐‑‒–—−', '''''''------'), '[^{_LETTERS}]')) AS character FROM (SELECT DISTINCT lang, word FROM words))
GROUP BY 1, 2""")
def headword_invalid_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vocabulary(spark, sf_dir).select("lang", F.explode(hw.invalid_characters(hw.translated(F.col("word")))).alias("c"))
    return found.groupBy("lang", "c.character").agg(F.sum("c.count").alias("occurrences"))


@_query(f"""WITH {_CLASSIFIED}
SELECT headword, count(DISTINCT word) AS spellings FROM headwords WHERE lang = 'tr' AND reason IS NULL AND regexp_matches(word, '[Iıİi]') GROUP BY 1""")
def turkish_casing(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = vocabulary(spark, sf_dir).where((F.col("lang") == "tr") & F.col("word").rlike("[Iıİi]"))
    told = hw.with_clean_headword(own, normalised=True).where("h.reason is null")
    return told.groupBy(F.col("h.word").alias("headword")).agg(F.count("*").alias("spellings"))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct word of a document as a raw entry; words of a length divisible by three have no field."""
    own = words(spark, sf_dir).select("lang", "doc_id", "word").distinct()
    field = F.struct(F.lit(True).alias("is_text"), _toy(F.lower("word")).alias("value"), F.lit(None).cast("string").alias("json"))
    fields = F.when(F.length("word") % 3 != 0, F.array(field)).otherwise(F.array().cast("array<struct<is_text:boolean,value:string,json:string>>"))
    return own.select("lang", (F.length("word") % 3 != 0).alias("has_ipa"), F.lit(0).alias("archive"), F.col("doc_id").alias("line"), "word", F.to_json(F.array("word")).alias("word_json"), fields.alias("fields"))


@_query(f"""WITH {_CLASSIFIED}, e AS (SELECT DISTINCT lang, doc_id, word, reason, headword FROM headwords)
SELECT lang, count(*) AS input, count(*) FILTER (reason IS NOT NULL) AS removed,
  count(DISTINCT CASE WHEN reason IS NULL THEN headword END) AS retained,
  count(*) FILTER (reason IS NULL) - count(DISTINCT CASE WHEN reason IS NULL THEN headword END) AS merged FROM e GROUP BY 1""")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.counts(prepare.headwords(_entries(spark, sf_dir), normalised=True))


@_query(f"""WITH {_CLASSIFIED}
SELECT lang, headword AS word, min(CASE WHEN length(word) % 3 <> 0 THEN 0 ELSE 1 END) = 0 AS with_ipa,
  coalesce(min(CASE WHEN length(word) % 3 <> 0 THEN doc_id END), min(doc_id)) AS first_line FROM headwords WHERE reason IS NULL GROUP BY 1, 2""")
def wordlist_merge_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = prepare.headwords(_entries(spark, sf_dir), normalised=True).where("decision = 'retained'")
    return kept.select("lang", F.col("headword").alias("word"), F.col("has_ipa").alias("with_ipa"), F.col("line").alias("first_line"))


@_query(f"""WITH {_CLASSIFIED}
SELECT lang, headword AS word FROM headwords WHERE reason IS NULL GROUP BY 1, 2 HAVING bool_and(length(word) % 3 = 0)""")
def missing_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.prepare(_entries(spark, sf_dir), normalised=True).missing


@_query(f"""WITH {_WORDS}
SELECT lang, count(DISTINCT w) AS words, count(DISTINCT CASE WHEN has THEN w END) AS with_ipa FROM (
  SELECT lang, length(word) % 3 <> 0 AS has, CASE WHEN length(regexp_replace(word, '[^\\p{{Lu}}]', '', 'g')) < 2 THEN lower(word) ELSE word END AS w FROM words) GROUP BY 1""")
def legacy_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, rest = legacy.extract(_entries(spark, sf_dir), normalised=True)
    both = listed.select("lang", "word", F.lit(1).alias("has")).union(rest.select("lang", "word", F.lit(0)))
    return both.groupBy("lang").agg(F.count("*").alias("words"), F.sum("has").alias("with_ipa"))


def _notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, kind = F.substr("ipa", F.lit(3), F.length("ipa") - 3), F.length("word") % 8
    field = (
        F.when(kind == 0, F.concat(F.lit("/ˈ"), w, F.lit("/"))).when(kind == 1, F.concat(F.lit("/ˈ"), w, F.lit("~ˈ"), w, F.lit("n/")))
        .when(kind == 2, F.concat(F.lit("/ˈ"), w, F.lit("-/"))).when(kind == 3, F.concat(F.lit("/ˈ"), w, F.lit("X/")))
        .when(kind == 4, F.concat(F.lit("/ˈ"), w, F.lit("☃/"))).when(kind == 5, F.concat(F.lit("/ˈ"), w, F.lit("(n)/ ")))
        .when(kind == 6, F.concat(F.lit("ˈ"), w, F.lit(",ˈ"), w)).otherwise(F.concat(F.lit("/ˈ"), w, F.lit("\u0001/")))
    )
    return spelled(spark, sf_dir).select("lang", "word", field.alias("ipa"))


_KINDS = f"""{_SPELLED}, n AS (SELECT lang, word, ipa[3:length(ipa) - 1] AS w, length(word) % 8 AS k, regexp_matches(ipa, '[{_VOWELS}]') AS vowel FROM spelled)"""


@_query(f"""WITH {_KINDS}
SELECT lang, CASE k WHEN 2 THEN 'incomplete_pronunciation' WHEN 3 THEN 'mixed_uppercase_notation' WHEN 4 THEN 'unrecognized_tokens' WHEN 6 THEN 'ambiguous_comma_notation'
  WHEN 7 THEN 'embedded_control' ELSE 'misplaced_stress_mark' END AS reason, CAST(sum(CASE WHEN k IN (1, 5) THEN 2 ELSE 1 END) AS BIGINT) AS rejects
FROM n WHERE k IN (2, 3, 4, 6, 7) OR NOT vowel GROUP BY 1, 2""")
def pronunciation_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = pr.with_cleaned(_notations(spark, sf_dir), normalised=True).select("lang", F.explode("rejects").alias("r"))
    return told.groupBy("lang", "r.reason").agg(F.count("*").alias("rejects"))


@_query(f"""WITH {_KINDS}
SELECT lang, word, unnest(CASE k WHEN 0 THEN ['/ˈ' || w || '/'] ELSE ['/ˈ' || w || '/', '/ˈ' || w || 'n/'] END) AS variant FROM n WHERE k IN (0, 1, 5) AND vowel""")
def clean_pronunciation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pr.with_cleaned(_notations(spark, sf_dir), normalised=True).select("lang", "word", F.explode("valid").alias("variant"))


@_query(f"""WITH {_TOKENS}
SELECT lang, token, count(*) AS occurrences FROM (SELECT lang, unnest(list_concat(['ˈ'], t)) AS token FROM sounds) GROUP BY 1, 2""")
def token_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sounds(spark, sf_dir).select("lang", F.explode("t").alias("token")).groupBy("lang", "token").agg(F.count("*").alias("occurrences"))


def _assonance(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _by_lang(lambda lang: tk.assonance_key(F.col("t"), lang))
    return _sounds(spark, sf_dir).select("lang", "word", keys.alias("assonance"))


@_query(f"WITH {_TOKENS} SELECT lang, assonance, count(*) AS words, min(word) AS example FROM keyed GROUP BY 1, 2")
def assonance_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assonance(spark, sf_dir).groupBy("lang", "assonance").agg(F.count("*").alias("words"), F.min("word").alias("example"))


@_query(f"""WITH {_TOKENS}, g AS (SELECT lang, assonance, count(*) AS words FROM keyed GROUP BY 1, 2)
SELECT * FROM g ORDER BY words DESC, lang, assonance LIMIT 25""")
def assonance_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _assonance(spark, sf_dir).groupBy("lang", "assonance").agg(F.count("*").alias("words"))
    return groups.orderBy(F.desc("words"), "lang", "assonance").limit(25)


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build_index(spelled(spark, sf_dir))


@_query(f"WITH {_TOKENS} SELECT lang, word, ipa, key AS ipa_reversed, assonance AS assonance_reversed FROM keyed")
def rhyme_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).select("lang", "word", "ipa", "ipa_reversed", "assonance_reversed")


@_query(f"WITH {_SPELLED} SELECT lang, ipa AS restored, word FROM spelled")
def restore_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).select("lang", codec.restore(F.col("ipa_reversed")).alias("restored"), "word")


@_query(f"WITH {_TOKENS} SELECT lang, word FROM keyed WHERE key = '/ t s' OR key LIKE '/ t s %' OR key = '/ n ɪ' OR key LIKE '/ n ɪ %'")
def rhyme_prefix_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _index(spark, sf_dir)
    return index.rhymes(told, "t s").union(index.rhymes(told, "n ɪ")).select("lang", "word")


@_query(f"""WITH {_TOKENS} SELECT lang, count(*) FILTER (key LIKE '/ ts %') AS affricate, count(*) FILTER (key LIKE '/ s t %') AS cluster FROM keyed GROUP BY 1""")
def suffix_distinguishes_affricate(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("ipa_reversed")
    return _index(spark, sf_dir).groupBy("lang").agg(F.count_if(index.prefix(key, "/ ts")).alias("affricate"), F.count_if(index.prefix(key, "/ s t")).alias("cluster"))


@_query(f"""WITH {_TOKENS}, f AS (SELECT lang, word, list_reverse(list_concat(['ˈ' || t[1]], t[2:])) AS f FROM keyed)
SELECT lang, array_to_string(f[1:3], ' ') AS tail, count(DISTINCT word) AS words FROM f WHERE len(f) >= 3 GROUP BY 1, 2 HAVING count(DISTINCT word) > 1""")
def rhyme_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.rhyme_groups(_index(spark, sf_dir), 3).where("words > 1")


@_query(f"WITH {_TOKENS} SELECT lang, count(*) FILTER (NOT regexp_matches(ipa, '[{_VOWELS}]')) AS misplaced, count(*) AS words FROM keyed GROUP BY 1")
def misplaced_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = _by_lang(lambda lang: tk.misplaced_stress(F.col("t"), lang))
    return _sounds(spark, sf_dir).groupBy("lang").agg(F.count_if(bad).alias("misplaced"), F.count("*").alias("words"))


@_query(f"""WITH {_TOKENS}, v AS (SELECT lang, t, list_position(list_transform(t, lambda x: regexp_matches(x, '^[{_VOWELS}]')), true) AS p FROM sounds)
SELECT lang, CASE WHEN p > 0 THEN array_to_string(t[p:], ' ') ELSE '' END AS tail, count(*) AS words FROM v GROUP BY 1, 2""")
def rhyme_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = _by_lang(lambda lang: F.array_join(tk.rhyme_tail(F.col("t"), lang), " "))
    return _sounds(spark, sf_dir).groupBy("lang", tail.alias("tail")).agg(F.count("*").alias("words"))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelled word against the same word spelled backwards, in the sounds of its language."""
    own = _sounds(spark, sf_dir).withColumn("b", _by_lang(lambda lang: tk.tokens(_toy(F.reverse("word")), lang, normalised=True)))
    return own.withColumn("c", _by_lang(lambda lang: tk.compare(F.col("t"), F.col("b"), lang))).select("lang", "word", "c.*", "c")


# Sounds become single ASCII characters, so that SQL's levenshtein of bytes is that of sounds.
_CODED = f"""{_SPELLED},
variants AS (SELECT lang, word, unnest([0, 1, 2]) AS v, unnest([ipa, {_SAY.format("reverse(word)")}, {_SAY.format("(word || 'a')")}]) AS said FROM spelled),
heard AS (SELECT lang, word, v, said, {_SOUNDS.format("said")} AS t FROM variants),
known AS (SELECT list(DISTINCT x ORDER BY x) AS xs FROM (SELECT unnest(t) AS x FROM heard)),
coded AS (SELECT lang, word, v, said, len(t) AS n, array_to_string(list_transform(t, lambda x: chr(CAST(33 + list_position(xs, x) AS INTEGER))), '') AS c FROM heard, known),
p AS (SELECT a.lang, a.word, b.v, b.said, levenshtein(a.c, b.c) AS d, greatest(a.n, b.n) AS n, least(a.n, b.n) AS fewest FROM coded a JOIN coded b USING (lang, word) WHERE a.v = 0 AND b.v > 0)"""


@_query(f"WITH {_CODED} SELECT lang, word, CAST(d AS INTEGER) AS phoneme_edits, d / n AS phoneme_distance_ratio FROM p WHERE v = 1")
def phoneme_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).select("lang", "word", "phoneme_edits", "phoneme_distance_ratio")


@_query(f"WITH {_CODED} SELECT lang, d / n >= 0.8 AND d >= 4 AND fewest >= 5 AS extreme, count(*) AS words FROM p WHERE v = 1 GROUP BY 1, 2")
def extreme_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _compared(spark, sf_dir).groupBy("lang", tk.extreme(F.col("c")).alias("extreme")).agg(F.count("*").alias("words"))


@_query(f"WITH {_CODED} SELECT lang, word, arg_min(said, {{'r': d / n, 'd': d, 'v': v}}) AS closest FROM p GROUP BY 1, 2")
def closest_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties included: of equally close variants the first wins."""
    own = spelled(spark, sf_dir).select("lang", "word", "ipa")
    other = own.select("lang", "word", F.posexplode(F.array(_toy(F.reverse("word")), _toy(F.concat("word", F.lit("a"))))).alias("position", "ipa"))
    return validate.compare(own, other).select("lang", "word", F.col("espeak_ipa").alias("closest"))


@_query(f"""WITH {_TOKENS}
SELECT lang, 'wiktionary' AS source, count(*) AS pronunciations, count(DISTINCT ipa) AS unique_ipa, CAST(sum(len(t) + 2) AS BIGINT) AS tokens FROM keyed GROUP BY 1""")
def audit_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.totals(_index(spark, sf_dir)).drop("records_with_diagnostics")


_PAIRS = {lang: [p for p in inv.VOWELS[lang] + inv.CONSONANTS[lang] if len(p) == 2] for lang in inv.LANGUAGES}
_PLAUSIBLE = sorted({p for ps in _PAIRS.values() for p in ps} | {"dz"})


@_query(f"""WITH {_TOKENS},
split AS (SELECT lang, word, ipa, unnest(list_transform(range(1, len(t)), lambda i: t[i][length(t[i]):] || t[i + 1][1:1])) AS pair FROM sounds),
found AS (
  SELECT lang, word, ipa, 'inferred_multigraph' AS reason, x AS spelling FROM (SELECT lang, word, ipa, unnest(t) AS x FROM sounds) WHERE length(x) = 2
  UNION ALL SELECT lang, word, ipa, 'possible_multigraph_split', pair FROM split WHERE pair IN {tuple(_PLAUSIBLE)}
    AND NOT (CASE lang {" ".join(f"WHEN '{lang}' THEN pair IN {tuple(ps)}" for lang, ps in _PAIRS.items())} END))
SELECT lang, reason, spelling, count(*) AS count, min({{'w': word, 'i': ipa}}).w AS word, min({{'w': word, 'i': ipa}}).i AS ipa FROM found GROUP BY 1, 2, 3""")
def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = audit.diagnostics(_index(spark, sf_dir))
    return found.select("lang", "reason", "spelling", "count", F.col("example.word").alias("word"), F.col("example.ipa").alias("ipa"))


@_query(f"""WITH {_SPELLED} SELECT lang, CASE WHEN length(word) % 2 = 0 THEN 'engine_exact_match' ELSE 'engine_spelling_differs' END AS evidence, count(*) AS words FROM spelled GROUP BY 1, 2""")
def engine_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.array_join(F.split("ipa", ""), "_")
    own = spelled(spark, sf_dir).withColumn("source", F.lit("espeak"))
    own = own.withColumn("reference", F.when(F.length("word") % 2 == 0, fields).otherwise(F.concat(fields, F.lit("_x"))))
    return index.build_index(own, strict=False).groupBy("lang", "evidence").agg(F.count("*").alias("words"))


@_query(f"""WITH {_CLASSIFIED}, e AS (SELECT DISTINCT lang, doc_id, word, reason FROM headwords)
SELECT lang, CASE WHEN reason IS NULL THEN 'kept' ELSE reason END AS outcome, count(*) AS records FROM e GROUP BY ROLLUP (1, 2)""")
def reports_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = prepare.headwords(_entries(spark, sf_dir), normalised=True)
    return told.select("lang", F.coalesce("reason", F.lit("kept")).alias("outcome")).rollup("lang", "outcome").agg(F.count("*").alias("records"))


@_query(f"""WITH {_SPELLED} SELECT lang, 'misplaced_stress_mark' AS reason, count(*) AS repairs FROM spelled WHERE NOT regexp_matches(ipa, '[{_VOWELS}]') GROUP BY 1""")
def repair_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = F.array(F.struct(F.lit(True).alias("is_text"), F.col("ipa").alias("value"), F.lit(None).cast("string").alias("json")))
    raw = spelled(spark, sf_dir).select("lang", F.lit(True).alias("has_ipa"), F.lit(0).alias("archive"), F.lit(0).cast("long").alias("line"), "word", F.to_json(F.array("word")).alias("word_json"), field.alias("fields"))
    return prepare.prepare(raw, normalised=True).repairs.groupBy("lang", "reason").agg(F.count("*").alias("repairs"))


@_query(f"""WITH {_SPELLED} SELECT lang, count(*) FILTER (regexp_matches(ipa, '[{_VOWELS}]')) AS source_words, count(*) FILTER (NOT regexp_matches(ipa, '[{_VOWELS}]')) AS machine_words FROM spelled GROUP BY 1""")
def eligible_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words without a nucleus are repaired by an engine that gives them one."""
    own = spelled(spark, sf_dir).select("lang", "word", "ipa")
    bad = own.where(~F.col("ipa").rlike(f"[{_VOWELS}]")).select("lang", "word", "ipa", F.lit("misplaced_stress_mark").alias("reason"))
    fresh = bad.select("lang", "word", F.concat(F.lit("/ˈ"), F.lit("a/")).alias("ipa"))
    v = validate.validate(own, own.limit(0), bad, fresh)
    both = v.source.select("lang", F.lit(1).alias("s"), F.lit(0).alias("m")).union(v.machine.select("lang", F.lit(0), F.lit(1)))
    return both.groupBy("lang").agg(F.sum("s").alias("source_words"), F.sum("m").alias("machine_words"))
