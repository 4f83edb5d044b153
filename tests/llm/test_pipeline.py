import pytest

import corpus_pipeline as pipe

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, lines_removed string, s string, u string, root string, size string"
LEAK = "the quick seven foxes ran across a frozen lake before the morning bell rang twice"
EN = "this is the text of a document about the weather and the people who live by the sea number"
DE = "dies ist der text eines dokuments über das wetter und die menschen die am meer leben nummer"
FOOTER = "all rights are reserved by the owners"


def row(i, text, lang, source):
    return (i, text, lang, source, len(text or ""), "kept", "kept", "kept", "kept", "kept", "gone")


def body(base, i):
    return " ".join(f"{base} {i} {k}" for k in range(i % 7 + 3))


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    rows = [row(i, body((EN, DE)[i % 2], i) + f"\n{FOOTER}", ("en", "de")[i % 2], f"s{i % 12}") for i in range(40)]
    rows += [row(100, rows[4][1], "en", "s1"), row(100, rows[4][1], "en", "s1"), row(101, body(EN, 77) + " " + LEAK, None, None)]
    rows += [row(102, None, None, "s1"), row(103, "", "en", "s2"), row(None, body(EN, 91), "en", None), row(104, body(DE, 92) * 200, "de", "s3")]
    at = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, LEAK), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


def test_run(spark, made):
    out = pipe.run(spark, made).collect()
    got = [r.doc_id for r in out]
    # wordless rows are no language, 100 is a copy, 101 leaks; what the mix leaves out is up to its hashes
    assert not {100, 101, 102, 103} & set(got) and len(got) == len(set(got)) and all(r.taken > 0 for r in out)
    assert all(FOOTER not in r.text and r.n_chars == len(r.text) for r in out)
    assert all((r.score, r.lines_removed, r.s, r.u, r.root) == ("kept",) * 5 for r in out)


def test_stages(spark, made):
    docs = spark.read.parquet(f"{made}/documents.parquet")
    ids = lambda df: sorted((r.doc_id is not None, r.doc_id) for r in df.select("doc_id").collect())
    stages = dict(pipe.STAGES)
    every = ids(docs)
    # 102 and 103 hold no letter; 104 says one sentence 800 times, which tells too little for its length
    assert ids(stages["language_id"](spark, docs, made)) == [x for x in every if x[1] not in (102, 103, 104)]
    assert ids(stages["line_dedup"](spark, docs, made)) == every
    assert ids(stages["near_duplicates"](spark, docs, made)) == [x for x in every if x[1] != 100]
    assert ids(stages["decontamination"](spark, docs, made)) == [x for x in every if x[1] != 101]
    for _, stage in pipe.STAGES[:-1]:
        assert stage(spark, docs, made).schema.names == docs.schema.names


def test_rows_without_id(spark, made):
    rows = [row(None, None, None, "a"), row(None, None, None, "b"), row(None, "", "en", "a"), row(None, "x y", "en", "a"), row(None, "x y", "en", "b")]
    out = pipe.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), made).collect()
    assert sorted(str(r.text) for r in out) == ["", "None", "None", "x y"]


def test_empty(spark, made):
    docs = spark.read.parquet(f"{made}/documents.parquet").limit(0)
    for _, stage in pipe.STAGES:
        assert stage(spark, docs, made).count() == 0


def test_lines_over_half(spark, made):
    notice = "\n".join(f"line {k} of a long notice that all sites share" for k in range(8))
    rows = [row(i, f"own words {i}\n{notice}", "en", f"s{i}") for i in range(12)] + [row(20, notice, "en", "s1"), row(21, f"\n{notice}\n", "en", "s2")]
    out = {r.doc_id: r for r in pipe.line_dedup(spark, spark.createDataFrame(rows, SCHEMA), made).collect()}
    assert all(out[i].text == f"own words {i}" and out[i].n_chars == len(out[i].text) for i in range(12))
    # every line spreads: whole copies, of which the next stage leaves one
    assert out[20].text == notice and out[21].text == f"\n{notice}\n"


def test_near_copies_of_five_words(spark, made):
    # one of 50 words edited: 41 of 51 shingles of five words are shared, but only 43 of 51 of four
    words = [f"w{k}" for k in range(50)]
    rows = [row(1, " ".join(words), "en", "a"), row(2, " ".join(words[:25] + ["v"] + words[26:]), "en", "b"), row(3, " ".join(words[:30] + ["v"] * 20), "en", "b")]
    out = pipe.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), made).collect()
    assert sorted(r.doc_id for r in out) == [1, 3]
