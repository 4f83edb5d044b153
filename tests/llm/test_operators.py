import hashlib
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from klangwerk.llm import ann, chat, components, decontam, exactdup, jaccard, langid, linededup, mixing, quality, sitetree, suffix
from klangwerk.llm import textkit as tk

LONG = " ".join(f"w{i}" for i in range(400))
DOCS = [
    (1, LONG, "en", "a", "x"), (2, LONG, "en", "b", "x"), (3, LONG.replace("w7 ", "v7 "), None, "a", "x"), (4, None, "en", None, "x"), (5, "", "de", "a", "x"),
    (6, "ab", "de", "b", "x"), (6, "ab", "de", "b", "x"), (7, "\x0b \t\n", "en", "a", "x"), (8, "x" * 5000, "en", "b", "x"), (9, "Ab cd ef gh", "en", "a", "x"), (10, "aB CD ef gh", "de", "b", "x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, score string")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def brute_groups():
    sets = {}
    for i, t, *_ in DOCS:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} - {()}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                    root[a] = root[b] = min(root[a], root[b])
    return {(i, len(sets[i]), root[i]) for i in sets}


def test_jaccard(docs, empty):
    assert {tuple(r) for r in jaccard.near_duplicates(docs).collect()} == brute_groups()
    assert jaccard.near_duplicates(empty).count() == 0


def test_suffix_dedup(docs, empty):
    length, seen = 50, {}
    for _, t, *_ in DOCS:
        b = (t or "").encode()
        for j in range(len(b) - length + 1):
            seen[b[j : j + length]] = seen.get(b[j : j + length], 0) + 1
    want = []
    for i, t, *_ in DOCS:
        b, gone = (t or "").encode(), set()
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                gone |= set(range(j, j + length))
        want.append((i, len(b), len(gone), sum(k - 1 not in gone for k in gone), hashlib.sha256(bytes(c for k, c in enumerate(b) if k not in gone)).hexdigest()))
    # shards of all sizes: one for all, several of a key, one a piece
    for shard in (1 << 20, 700, 1):
        got = exactdup.remove_repeats(docs, length, shard=shard).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert exactdup.remove_repeats(empty).count() == 0


def test_suffix_dedup_long(spark):
    # texts over 4 MiB are cut into pieces; a passage across a cut is found in another text, null ids keep their rows apart
    rng = np.random.default_rng(6)
    long = rng.integers(97, 123, 9 << 20).astype(np.uint8).tobytes().decode()
    cut = exactdup._PIECE
    rows = [(1, long), (2, long[cut - 300 : cut + 300]), (None, "q" + long[100:600]), (None, "r" + long[:99])]
    out = {r.n_bytes: r for r in exactdup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(out[len(t)][c] for c in ("n_removed", "n_spans")) for _, t in rows] == [(1100, 2), (600, 1), (500, 1), (0, 0)]


def test_suffix_work(monkeypatch):
    # suffix arrays are made of keys with several pieces only, and only the shards of one key are merged
    class Frame:
        def repartition(self, *_):
            return self

        sortWithinPartitions = repartition

        def mapInArrow(self, f, _):
            return f

    rng = np.random.default_rng(2)
    fresh = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    twice, hot = fresh(60), fresh(50)
    rows = [(1, 0, [1], fresh(90)), (2, 0, [2, 3], fresh(80)), (2, 0, [4], b""), (3, 0, [5], b"a" + twice), (3, 1, [6], b"b" + twice), (4, 0, [7], fresh(70))]
    rows[2] = (2, 0, [4], rows[1][3])
    rows += [(5, i, [10 + i], fresh(9) + hot + fresh(9)) for i in range(4)] + [(6, 0, [20], b"c" + twice), (6, 1, [21], fresh(40) + fresh(30)), (7, 0, [22], fresh(60))]
    kinds = {"key": pa.int64(), "print": pa.int64(), "rids": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "piece": pa.binary()}
    cols = [[k for k, *_ in rows], [p for _, p, *_ in rows], [r for _, _, r, _ in rows], [[100] * len(r) for _, _, r, _ in rows], [t for *_, t in rows]]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds.values())], list(kinds))
    built, merges, repeated, bounds = [], [], suffix.repeated, suffix.lower_bounds
    monkeypatch.setattr(suffix, "repeated", lambda text, *a: built.append(text.tobytes()) or repeated(text, *a))
    monkeypatch.setattr(suffix, "lower_bounds", lambda text, sa, other, *a: merges.append((text.tobytes(), other.tobytes())) or bounds(text, sa, other, *a))
    for parts in ([batch], [batch.slice(i, 1) for i in range(len(rows))]):
        built.clear()
        merges.clear()
        got = {tuple(r.values()) for b in exactdup._spans(Frame(), 50, shard=140)(iter(parts)) for r in b.to_pylist()}
        assert got == {(i, 100, 180) for i in (2, 3, 4)} | {(5, 101, 161), (6, 101, 161)} | {(10 + i, 109, 159) for i in range(4)}
        assert sum(map(len, built)) == 2 * 61 + 4 * 68 + 61 + 70
        assert merges and all(hot in x and hot in y for x, y in merges)


def test_windows():
    # runs of strings hold each string inside a row once, and equal strings have equal keys by both orders, at equal distances
    rng = np.random.default_rng(5)
    size = np.array([0, 300, 39, 40, 0, 41, 500, 3])
    offsets, data = np.concatenate([[0], np.cumsum(size)]), rng.integers(97, 123, size.sum()).astype(np.uint8)
    data[offsets[6] + 100 : offsets[6] + 250] = data[offsets[1] + 20 : offsets[1] + 170]
    starts = [(i, r) for r in range(len(size)) for i in range(offsets[r], offsets[r + 1] - 39)]
    both = list(exactdup._windows(data, offsets, 40, True))
    for runs in (*both, *exactdup._windows(data, offsets, 40, False)):
        b, e, row, keys, place = runs
        assert [(i, r) for x, y, r in zip(b, e, row) for i in range(x, y)] == starts
        of = np.repeat(np.arange(len(b)), e - b)
        at, seen = np.array([i for i, _ in starts]), {}
        for i, k in zip(at, of):
            seen.setdefault(data[i : i + 40].tobytes(), set()).add((int(place[k] - i), *(int(x[k]) for x in keys)))
        assert len(seen) == len(starts) - 111 and all(len(x) == 1 for x in seen.values())
    # a run goes on as long as its keys do
    assert len(both) == 1 and len(both[0][0]) < len(starts) // 2
    assert not list(exactdup._windows(data[:39], np.array([0, 39]), 40, True)) and not list(exactdup._windows(data[:0], np.array([0, 0]), 40, False))


def test_shared_passages(spark, monkeypatch):
    # passages of 51 words and more that documents share, under 400 bytes and whatever the white space; not those of one text alone
    rng = np.random.default_rng(4)
    own = lambda n: [f"{rng.integers(10**6):x}" for _ in range(n)]
    short, long, once = ["a", *own(50)], own(90), own(60)
    rows = [(1, own(70) + short + own(9)), (2, own(5) + short), (3, short[:50] + own(80)), (4, once + own(3) + once), (5, long), (6, own(200) + long), (7, own(300))]
    rows = [(i, " ".join(w)) for i, w in rows] + [(8, "\n".join(long)), (9, None), (None, " ".join(once[:51])), (10, "x " * 120), (10, "x " * 120), (11, "y " * 60)]
    strings = [Counter(tuple(w[i : i + 51]) for i in range(len(w) - 50)) for w in ((t or "").split() for _, t in rows)]
    want = [(i, sum(s.values()), sum(n for x, n in s.items() if sum(x in o for o in strings) > 1)) for (i, _), s in zip(rows, strings)]
    assert [n for _, _, n in want] == [1, 1, 0, 2, 40, 40, 0, 40, 0, 1, 70, 70, 0]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    key = lambda r: (r[0] is None, *r)
    shared, size = exactdup._shared, "spark.sql.execution.arrow.maxRecordsPerBatch"
    for held, batch in ((1 << 20, spark.conf.get(size)), (1, "1"), (1, spark.conf.get(size))):
        spark.conf.set(size, batch)
        monkeypatch.setattr(exactdup, "_shared", lambda d, w, k, h=held: shared(d, w, k, h))
        got = exactdup.remove_repeats(df).select("doc_id", "n_passages", "n_shared").collect()
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    # a passage that each of many texts has many times is dealt once a batch, and not once a place
    many = spark.createDataFrame([(i, f"a{i} " + " ".join(once) * 9) for i in range(200)], "doc_id long, text string").coalesce(1)
    full = np.full(1 << 10, np.uint64(2**64 - 1))
    assert shared(many, 51, full).count() == 200 and max(r.n for r in shared(many, 51, full).collect()) == 9 * 60 - 8 - 50
    # words of long texts are taken in parts
    batch = pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})
    whole = [np.concatenate(x) for x in zip(*exactdup._passages(batch, 51))]
    monkeypatch.setattr(exactdup, "_PIECE", 7)
    parts = [np.concatenate(x) for x in zip(*exactdup._passages(batch, 51))]
    assert all((x == y).all() for x, y in zip(whole[:3], parts[:3])) and len(whole[0]) == sum(n for _, n, _ in want)


def test_lower_bounds():
    rng = np.random.default_rng(8)
    for _ in range(40):
        a, b = (rng.integers(97, 100, rng.integers(20, 200)).astype(np.uint8) for _ in range(2))
        length = int(rng.integers(1, 12))
        starts = np.arange(len(b) - length + 1)
        sa = suffix.suffix_array(a)
        got = suffix.lower_bounds(a, sa, b, starts, length)
        assert list(got) == [b[i : i + length].tobytes() in a.tobytes() for i in starts]


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(50):
        s = rng.integers(97, 99, rng.integers(1, 120)).astype(np.uint8)
        raw, sa = s.tobytes(), suffix.suffix_array(s)
        assert list(sa) == sorted(range(len(raw)), key=lambda i: raw[i:])
        want = [0] + [len(os.path.commonprefix([raw[a:], raw[b:]])) for a, b in zip(sa[:-1], sa[1:])]
        assert list(suffix.common_prefixes(s, sa)) == want


def test_suffix_array_sizes():
    # positions and ranks of larger texts don't fit in one number; each suffix is above the one before by its first byte and the rest's rank
    rng = np.random.default_rng(3)
    for n in ((1 << 21) - 1, 1 << 21):
        text = rng.integers(97, 101, n).astype(np.uint8)
        text[-5_000:] = text[:5_000]
        sa = suffix.suffix_array(text)
        rank = np.full(n + 1, -1)
        rank[sa] = np.arange(n)
        assert (rank[:n] >= 0).all()
        a, b = sa[:-1], sa[1:]
        assert ((text[a] < text[b]) | ((text[a] == text[b]) & (rank[a + 1] < rank[b + 1]))).all()


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(1.5 * total)
    clash = docs.withColumns({c: docs["score"] for c in ("s", "full", "cut", "size", "target")})
    rows = mixing.mix(clash, keep=("s", "full", "cut", "size", "target")).collect()
    assert len(rows) == len(DOCS) and all((r.s, r.full, r.cut) == ("x",) * 3 and r["size"] != "x" for r in rows)
    assert mixing.mix(empty).count() == 0


def brute_targets(sizes):
    """Sizes by source in order: share, and share the excess anew until no target is above its cap."""
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sizes)}
    capped = {}
    while True:
        rest = {s: n for s, n in sizes.items() if s not in capped}
        left = 1.5 * sum(sizes.values()) - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s: 2.0 * sizes[s] for s in rest if target[s] > 2 * sizes[s]}
        if not over:
            return capped | target
        capped |= over


def test_mixing_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 40))), None if (s := int(rng.integers(0, 9))) == 8 else f"s{s}") for i in range(4000) for _ in range(1 + (i % 50 == 0))]
    rows += [(5000 + i, "w " * 700, "big") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    sizes = {s: sizes[s] for s in sorted(sizes, key=lambda s: (s is None, s or ""))}
    want, taken = brute_targets(sizes), {}
    for r in out:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * r.target and r.taken in (0, r["size"], 2 * r["size"])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    longest = max(len(t.split()) for _, t, _ in rows)
    assert all(abs(taken[s] - want[s]) <= 2 * longest for s in want) and len(out) == len(rows)
    assert sorted(map(str, out)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    # smaller budgets take a part of what larger ones take
    less = {(r.doc_id, r.text_key): r.taken for r in mixing.mix(docs.withColumn("text_key", F.col("text")), share=0.7, keep=("text_key",)).collect()}
    more = {(r.doc_id, r.text_key): r.taken for r in mixing.mix(docs.withColumn("text_key", F.col("text")), share=1.1, keep=("text_key",)).collect()}
    assert all(less[k] <= more[k] for k in less)


def test_langid_rule(spark):
    # told from brute-force sizes, with ties to the language of more labelled documents; held-out accuracy
    rng = np.random.default_rng(12)
    vocabulary = {f"l{k}": ["".join(rng.choice(list("abcdefghijklmnopqrst"[k * 4 : k * 4 + 9]), 5)) for _ in range(300)] for k in range(3)}
    rows = [(i, " ".join(rng.choice(vocabulary[f"l{i % 3}"], int(rng.integers(1, 120)))), f"l{i % 3}" if i < 450 else None) for i in range(600)]
    docs = spark.createDataFrame(rows + [(600, "a", None), (600, "a", None)], "doc_id long, text string, lang string")
    told = langid.learn(docs.where("doc_id < 450"))
    out = {r.doc_id: r for r in langid.identify(docs, told).collect()}
    coders = [langid.zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=langid.zstandard.ZstdCompressionDict(d, dict_type=langid.zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False) for d in told.values()]
    for i, text, _ in rows[450:500]:
        sizes = [len(c.compress(langid.letters(text))) for c in coders]
        assert out[i].lang_pred == list(told)[sizes.index(min(sizes))]
    assert sum(out[i].lang_pred == f"l{i % 3}" for i in range(450, 600)) >= 140


def test_langid(docs, empty):
    found = {r.doc_id: r for r in langid.identify(docs, langid.learn(docs)).collect()}
    assert found[4].lang_pred == found[5].lang_pred == found[7].lang_pred == "und" and found[1].lang_pred == "en"
    assert langid.letters("\u00b2 12 _!") == b"" and langid.letters("A\u00b2, b") == "a\u00b2 b".encode()
    assert langid.identify(docs, {}).where("lang_pred <> 'und'").count() == 0 and langid.learn(empty) == {}


def test_langid_long():
    rng = np.random.default_rng(4)
    vocabulary = [["".join(w) for w in rng.choice(list("abcdefghijklmnop"), (2000, 6))] for _ in range(2)]
    text = lambda words, n: " ".join(rng.choice(words, n))
    classify = langid.Classifier({f"l{i}": text(v, 9000).encode()[: langid.DICT_BYTES] for i, v in enumerate(vocabulary)})
    for n in (20, 1000, 500_000):
        lang, score, rejected = classify(text(vocabulary[1], n))
        assert lang == "l1" and score > 0.5 and not rejected


def test_lines(spark, empty):
    rows = [(i, f"own {i} {'z' * 40}\nshared line", f"s{i}") for i in range(12)] + [(50, None, "s1"), (51, "", None), (52, "shared line", "s2")]
    out = {r.doc_id: r for r in linededup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert out[3].text == f"own 3 {'z' * 40}" and out[50].text is None and out[52].text == "shared line"
    clash = spark.createDataFrame([(1, "a", "s", 7)], "doc_id long, text string, source string, lines_removed int")
    assert linededup.line_dedup(clash).first().lines_removed == 0
    assert linededup.line_dedup(empty).count() == 0


def test_chat(spark):
    for text in ("</s>[INST] ok [/INST]", "\\</s>\\\\", "<", "", "<\\s>"):
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROL)
    turns = [("user", "</s>"), ("assistant", "[INST] a"), ("user", ""), ("assistant", "b")]
    out, spans, rewritten = chat.locate(chat.tagged, turns)
    assert chat.parse(out) == turns and not rewritten and [chat.unescape(out[a:b]) for _, _, a, b in spans] == [t for _, t in turns]
    assert chat.locate(chat.last_only, turns)[2]
    df = spark.createDataFrame([(1, 0, None, None), (1, 0, "user", "x"), (None, 1, "user", "y")], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(df)).count() == 2
    big = spark.createDataFrame([(9007199254740993, 0, "user", "x"), (None, 0, "user", "x" * 9000)], "conv_id long, turn long, role string, text string")
    assert {r.conv_id for r in chat.digests(chat.format_conversations(big)).collect()} == {9007199254740993, None}
    assert {r.rewrites_history for r in chat.format_conversations(spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(("user", "assistant") * 40)], "conv_id long, turn long, role string, text string"), "last_only").collect()} == {True}


def test_leaks(docs, spark, empty):
    item = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(100, 130))), (2, None), (3, "ab")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, item).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert decontam.find_leaks(empty, item).count() == 0


def free_edits(item, text):
    """Least edits from item to any part of text."""
    before = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        now = [i + 1]
        for j, v in enumerate(text):
            now.append(min(before[j] + (v != w), before[j + 1] + 1, now[j] + 1))
        before = now
    return min(before)


def test_edited_leaks(spark):
    rng = np.random.default_rng(9)
    word = lambda: f"w{rng.integers(400)}"
    items, texts = [], []
    for n in (5, 5, 6, 9, 10, 15, 20, 40, 80, 120, 200, 300):
        item = [word() for _ in range(n)]
        for kind in ("substitute", "mixed", "more"):
            part = list(item)
            # spread over the item, where they break the most runs
            for p in np.linspace(0, n - 1, n // 5 + 2 + (kind == "more"))[1:-1].round().astype(int)[::-1]:
                act = "substitute" if kind == "substitute" else rng.choice(["substitute", "insert", "delete"])
                part[p : p + (act != "insert")] = [] if act == "delete" else [f"x{rng.integers(9)}"]
            texts.append([word() for _ in range(20)] + part + [word() for _ in range(20)])
        items.append(item)
    found = decontam.find_leaks(
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string"),
    )
    want = {(d, i): n for d, t in enumerate(texts) for i, item in enumerate(items) if (n := free_edits(item, t)) <= len(item) // 5}
    got = {(r.doc_id, r.item_id): r.edits for r in found.collect()}
    print("found", len(set(got) & set(want)), "of", len(want))
    assert len(want) >= 24 and got == want


def test_characters_as_words():
    # against a pattern, on rows of mixed scripts
    one = "\u0e00-\u0eff\u1000-\u107f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U00033fff"
    pattern = re.compile(f"[{one}]|[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f{one}]+")
    rng = np.random.default_rng(13)
    for _ in range(200):
        rows = ["".join(rng.choice(list("aB1 .\u00e9\u10d0\uac00\u0e01\u1000\u1780\u3042\u4e2d\u9fff\U00020000\U0001f600"), rng.integers(0, 9))) for _ in range(4)]
        data = np.frombuffer("".join(rows).encode(), np.uint8)
        offsets = np.cumsum([0, *(len(r.encode()) for r in rows)])
        s, e, row = tk.words(data, offsets, tk.ALNUM, characters=True)
        assert [(int(r), data[a:b].tobytes().decode()) for a, b, r in zip(s, e, row)] == [(i, w) for i, r in enumerate(rows) for w in pattern.findall(r)]


def test_leaks_without_spaces(spark):
    # a passage of 30 ideographs, one of them changed, inside a longer run
    item = "".join(chr(0x4E00 + 7 * i) for i in range(30))
    texts = ["".join(chr(0x6E00 + i) for i in range(50)) + item[:12] + "\u3042" + item[13:] + "\u4e2d" * 20, "".join(chr(0x6E00 + i) for i in range(99)), item[::-1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = decontam.find_leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.start_word, r.edits, r.n_words) for r in found] == [(0, 50, 1, 30)]


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 16))
    x[300:400] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [None] * 16), (704, [1.0])]
    v = ann.clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {}
    for r in ann.search(v, v.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    hits = 0
    for q, found in got.items():
        s = (x * x[q]).sum(axis=1)
        want = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        hits += len(set(want) & {i for _, i in found})
    assert len(got) == 30 and hits / 600 >= 0.9 and ann.search(v.limit(0), v.limit(0)).count() == 0


def test_neighbours_of_many_lists(spark):
    # 71 lists, of which the first round takes 24; isotropic, so that neighbours lie in any of them
    rng = np.random.default_rng(7)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    v = ann.clean(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>"))
    got = {}
    for r in ann.search(v, v.where("vec_id % 400 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = {q: set([i for i in np.argsort(-(x @ x[q])) if i != q][:20]) for q in range(0, 20_000, 400)}
    hits = sum(len(want[q] & got[q]) for q in want)
    print("recall", hits / 1000)
    assert len(got) == 50 and hits / 1000 >= 0.99


def test_pages(spark):
    html = "<nav>menu</nav><div class=ad>buy</div><article><h1>T &amp; t</h1><p><b>one<br> two<p>three<div class='comments'>no</div><footer>f</footer></article><footer>x</footer>"
    rows = [(1, "http://a.b/c", html), (2, None, None), (3, "x", "")] + [(10 + i, "http://h.i/", f"<div class=top>same</div><div><p>text {i}</p></div>") for i in range(8)]
    out = {r.page_id: r.text for r in sitetree.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[1] == "T & t\n\none two\n\nthree" and out[2] == out[3] == "" and out[12] == "text 2"


def test_marks():
    text = lambda html: sitetree.Page(html).main_text()
    assert text('<p title="a hidden gem">one</p><p data-hidden="false">two</p><p hidden>no</p>') == "one\n\ntwo"
    assert text('<article><div class="alert">one</div><div id="search-results-discussion">two</div><div class="comments">no</div></article>') == "one\n\ntwo"
    assert text('<div class="alert">no</div><p>one <button>no</button> more</p>') == "one more"
    # a teaser doesn't stand for the page
    assert text(f"<article><p>short</p></article><div><p>{'long ' * 20}</p></div>") == f"short\n\n{('long ' * 20).strip()}"


def brute_importance(pages):
    """By host and path, from the pages' features: equal pages once."""
    seen, nodes = set(), {}
    for host, html in pages:
        page = sitetree.Page(html)
        for path, style, content in page.features():
            if (host, path, page.unmarked()) not in seen:
                seen.add((host, path, page.unmarked()))
                nodes.setdefault((host, path), []).append((style, content))
    out = {}
    for at, rows in nodes.items():
        h = []
        for i in (0, 1):
            values = [r[i] for r in rows if r[i]]
            p = [values.count(v) / len(values) for v in set(values)]
            h.append(0.0 if not values else -sum(x * np.log(x) for x in p) / np.log(len(values)) if len(values) > 1 else 1.0)
        out[at] = (1 + len(rows) * max(h)) / (1 + len(rows))
    return out


def test_site_tree(spark):
    # boilerplate without telling names, on pages with and without landmarks; near copies of a page, and a small host
    def page(i, host, copy=None):
        j = i if copy is None else copy
        body = f"<h1>title {j % 3}</h1><p>text {j} of its own</p><div class=x1><p>read all on this site</p></div>"
        main = f"<article>{body}</article>" if host != "h2" else f"<div class=c>{body}</div>"
        return host, f"<html><body><div class=top><p>the same</p><ul><li>a<li>b</ul></div>{main}<div class=y>c {i % 2}</div><script>{i}</script></body></html>"

    pages = [page(i, "h1") for i in range(30)] + [page(100 + i, "h1", 5) for i in range(20)] + [page(i, "h2") for i in range(20)] + [page(i, "h3") for i in range(2)]
    df = spark.createDataFrame([(i, f"https://{h}/p{i}", html) for i, (h, html) in enumerate(pages)] + [(3, "https://h1/p3", pages[3][1]), (None, None, None)], "page_id long, url string, html string")
    hosts = df.select(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), "html")
    tree = {(r.host, r.node): r.importance for r in sitetree.importance(sitetree.site_nodes(hosts)).collect()}
    want = brute_importance(pages)
    assert len(tree) == len(want) and all(abs(tree[h, sitetree._digest(p.encode())] - v) < 1e-9 for (h, p), v in want.items())
    out = {r.page_id: r.text for r in sitetree.extract(df.withColumn("low", F.lit("x")).withColumn("host", F.lit("y"))).collect()}
    assert out[7] == "title 1\n\ntext 7 of its own" and out[33] == "title 2\n\ntext 5 of its own"  # the tree takes the box out of the article
    # without landmarks a host's three titles and two footers tell enough pages apart to stay, what all share goes
    assert out[52] == "title 2\n\ntext 2 of its own\n\nc 0"
    assert "read all on this site" in out[70] and "the same" in out[70] or out[70].startswith("title")  # two pages prove nothing
    assert len(out) == len(pages) + 1 and out[None] == ""
    # the same where low nodes are too many to go to all executors
    assert {r.page_id: r.text for r in sitetree.extract(df, low_nodes=0).collect()} == out


def test_unclosed_markup():
    text = lambda html: sitetree.Page(html).main_text()
    assert text("<html><head><title>t</title><meta charset=utf-8><body><p>one</p>") == "one"
    assert text("<head><meta charset=utf-8><style>p {}</style><p>one</p><p>two</p>") == "one\n\ntwo"
    assert text("<head><title>t</title> one <p>two</p>") == "one\n\ntwo"
    assert text("<p>one</p><svg viewBox='0 0 1 1'/><p>two</p>") == "one\n\ntwo"
    assert text("<p>one <svg/> more</p><p>two</p>") == "one more\n\ntwo"
    assert text("<p>one</p><svg><path d=x><text>no</text><p>two</p>") == "one\n\ntwo"
    assert text("<div><p>one</p><select><option>a<option>b</div><p>two</p>") == "one\n\ntwo"
    assert text("<div><p>one</p><object data=x><param name=a></div><p>two</p>") == "one\n\ntwo"
    assert text("<svg><text>no</text></svg><select><option>a</select><template><p>no</p></template><p>one</p>") == "one"


def test_quality(docs, spark, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (8, 0)], "doc_id long, quality int")
    model = quality.learn(docs.select("doc_id", "text"), labels)
    rows = quality.score(docs, model, ["doc_id"]).collect()
    assert len(rows) == len(DOCS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert quality.score(empty, model, ["doc_id"]).count() == 0


def test_share_below():
    rng = np.random.default_rng(3)
    a, b = (np.sort(np.stack([rng.choice(40, 8, replace=False) for _ in range(3000)]), axis=1) for _ in range(2))
    want = [any(k < 20 for k in set(x) & set(y)) for x, y in zip(a.tolist(), b.tolist())]
    assert list(jaccard._share_below(a, b, 20)) == want


def scan_input(spark, members, lists, n=50):
    apart = spark.createDataFrame([(k, s, n, -k, s) for k in range(1, lists + 1) for s in members], "key long, sid long, n long, at long, root long")
    size = apart.groupBy("key").count().withColumnRenamed("count", "k")
    sets = spark.createDataFrame([(s, n, bytes([1] * n + [0] * (256 - n))) for s in members], "sid long, n long, counts binary")
    return apart, size, sets


def test_scan(spark):
    # sets that share every list, none of one component: each pair is given once
    apart, size, sets = scan_input(spark, range(1, 9), 5)
    got = sorted((r.u, r.v, r.more) for r in jaccard._scan(apart, size, sets, 0, 85).collect())
    assert got == sorted((a, b, False) for a in range(1, 9) for b in range(a + 1, 9))


def test_scan_of_the_best(spark):
    # of many equal pairs each component gives a few, and says that it left some out
    apart, size, sets = scan_input(spark, range(1, 41), 3)
    got = jaccard._scan(apart, size, sets, 0, 85, 2).collect()
    pairs = [(r.u, r.v) for r in got if r.u is not None]
    assert any(r.more for r in got) and len(set(pairs)) == len(pairs) <= 3 * 2 * 40 and {x for p in pairs for x in p} == set(range(1, 41))


def test_best():
    rng = np.random.default_rng(5)
    a, b, most = rng.integers(0, 9, 200), rng.integers(9, 20, 200), rng.random(200)
    want = np.zeros(200, bool)
    for ends in (a, b):
        for e in np.unique(ends):
            own = np.flatnonzero(ends == e)
            want[own[np.argsort(-most[own])[:3]]] = True
    assert list(jaccard._best(a, b, most, 3)) == list(want)


def test_jaccard_groups(spark):
    # a list of over 1,024 sets, chains of near copies, light and heavy sets, null ids and repeats, against brute force
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base[: 60 - int(rng.integers(0, 8))] + [f"e{j}x{t}" for t in range(int(rng.integers(0, 7)))]) for j in range(1300)]
    texts += [" ".join(f"c{i}" for i in range(k, k + 40)) for k in range(0, 120, 3)] + [" ".join(f"s{k // 4}q{i}" for i in range(4 + k % 4)) for k in range(40)]
    rows = list(enumerate(texts)) + [(None, texts[0]), (None, None), (5, texts[5]), (9000, texts[7])]
    sets = [frozenset(tuple(w[j : j + 4]) for j in range(len(w) - 3)) or frozenset([tuple(w)] if w else []) for w in ((t or "").split() for _, t in rows)]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    where = {}
    for i, s in enumerate(distinct):
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in enumerate(distinct):
        shared = {}
        for g in s:
            for j in where[g]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= 85 * (len(s) + len(distinct[j]) - n) and find(s) is not find(distinct[j]):
                root[find(s)] = find(distinct[j])
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    want = sorted((str(i), len(s), least[find(s)] if s else i) for (i, _), s in zip(rows, sets))
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want
    assert len({w[2] for w in want}) < len(want) / 4


def jobs_of(spark, group, f):
    """What f returns, and how many jobs it took."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        return f(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_components(spark, monkeypatch):
    # one task up to a bound, rounds beyond it: the same trees, and no rounds for a few links
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(-400, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(7, 7), (2000, 2000)]
    root = {x: x for p in links for x in p}
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    want = sorted((x, r) for x, r in root.items() if x != r)
    df = spark.createDataFrame(links, "u long, v long")
    got, jobs = jobs_of(spark, "few", lambda: components.components(df).collect())
    assert sorted(map(tuple, got)) == want and jobs <= 5
    monkeypatch.setattr(components, "WHOLE", 100)
    assert sorted(map(tuple, components.components(df).collect())) == want


def test_frequencies(spark):
    # the driver asks once, not once a partition
    told = jaccard.set_table(spark.createDataFrame([(i, f"a b c d{i} e f") for i in range(50)], "doc_id long, text string"), 4).cache()
    out, jobs = jobs_of(spark, "sketch", lambda: jaccard.frequencies(told))
    told.unpersist()
    assert jobs <= 4 and sum(round(2 ** (x / 1000)) - 1 for x in out[out > 0]) == 150


def test_jaccard_in_rounds(docs, monkeypatch):
    # the ways of many pairs and links give the same
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(components, "WHOLE", 0)
    assert {tuple(r) for r in jaccard.near_duplicates(docs).collect()} == brute_groups()
