"""Operator 6: exact n-gram Jaccard self join, size-aware: heavy and light sets go different ways.

A light set (at most B shingles) enumerates its subsets of each fixed size c that a partner may share:
two light sets link exactly where they share a c-subset with c >= the overlap their sizes need, so a
subset's smallest set links with all others that qualify and no list is ever paired out. A heavy set
scans inverted lists: it looks up the shortest prefix of its shingles, rare ones first, that a partner
cannot miss. B is the size at which the cost of both ways, over the measured sizes, is least.

Equal sets are one vertex from the start. Inverted lists are scanned in rounds. In the first each member
meets only its list's leader. The next ones scan each list, block against block, for pairs of different
components that sizes, positions and counts leave possible; of these, each component gives only its few
best (BEST), those that are likest by their counts. Pairs are checked exactly, and those that link make
a forest: what they join needs no further test with each other, so a group of near copies costs about a
pair a member. A last scan gives all pairs that are still apart, unless the one before left none out, so
no link is lost.

Cases: null text, empty text and text without words give an empty set, which links with nothing;
repeated rows share a vertex; a null id keeps its row; long texts are handled in bounded blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klangwerk.llm import textkit as tk
from klangwerk.llm.components import components
from klangwerk.llm.store import bloom, discard, hot_join, in_bloom, materialise, table

WORDS = 4
PERCENT = 85
#: Buckets of the sketch of document frequencies that orders the shingles of a set, rare ones first. Any
#: order gives the same links: a coarse one, as on very many shingles, only makes lists longer.
SKETCH_BITS = 22
#: How many pairs a component gives in each block of a list, by round of the scan; in the last all.
BEST = (4, None)
#: Sets of a list that one task compares with each other; longer lists are dealt out by pairs of blocks.
LIST_BLOCK = 1024
#: Keys that each set of the scan brings along, to tell lists that give the same pair.
FIRST_KEYS = 8
#: So few pairs with a leader are verified as they are: to rule some out by counts first takes longer.
FEW = 1 << 14


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray]]:
    """(slice, the distinct shingles of each row in hash order, set ids)."""
    for part, data, offsets in tk.blocks(batch, "text"):
        s, e, row = tk.words(data, offsets)
        h, at = tk.shingles(tk.word_hashes(data, s, e), row, k, part.num_rows)
        sets = [np.unique(x) for x in tk.split_rows(h, at, part.num_rows)]
        sums = np.array([np.sum(tk.mix(x), dtype=np.uint64) for x in sets], np.uint64)
        n = np.array([len(x) for x in sets], np.uint64)
        ids = np.where(n > 0, tk.mix(n * np.uint64(0x9E3779B97F4A7C15) + sums), np.uint64(0))
        yield part, sets, ids.view(np.int64)


def _batch(schema: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema.split())


def set_table(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, sid, n, counts) of every document; and (part, sketch) rows: frequencies by shingle bucket, of a task.

    counts: how many shingles fall to each of 256 ranges of hashes, 255 at most; two sets share no more
    than the sum of the lesser counts, so it tells most candidates that can't link at 256 bytes a set.
    """
    cut = 1 << (SKETCH_BITS - 6)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pending = np.zeros(1 << SKETCH_BITS, np.uint32), []

        def add() -> None:
            nonlocal total, pending
            if pending:
                total += np.bincount(np.concatenate(pending), minlength=1 << SKETCH_BITS).astype(np.uint32)
            pending = []

        for batch in batches:
            for part, sets, ids in _sets(batch, k):
                n = np.array([len(x) for x in sets], np.int64)
                counts = tk.binaries([np.minimum(np.bincount((x >> np.uint64(56)).astype(np.int64), minlength=256), 255).astype(np.uint8).tobytes() if len(x) else None for x in sets])
                none = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
                yield _batch("doc_id sid n counts part sketch", part.column("doc_id").cast(pa.int64()), ids, n, counts, *none)
                pending += [(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int32) for x in sets]
                if sum(map(len, pending)) > 1 << 21:
                    add()
        add()
        if total.any():
            none = pa.nulls(64, pa.int64()), pa.nulls(64, pa.int64()), pa.nulls(64, pa.int64()), pa.nulls(64, pa.binary())
            parts = [zlib.compress(total[i * cut : (i + 1) * cut].tobytes(), 1) for i in range(64)]
            yield _batch("doc_id sid n counts part sketch", *none, pa.array(range(64), pa.int32()), tk.binaries(parts))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, sid long, n long, counts binary, part int, sketch binary")


def frequencies(told: DataFrame) -> np.ndarray:
    """The sum of the tasks' sketches on a log scale, two bytes a bucket. Summed in 64 parts on executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("sketch")):
                x = np.frombuffer(zlib.decompress(raw.as_buffer()), np.uint32)
                sums[part] = sums.get(part, 0) + x.astype(np.uint64)
        logs = {k: np.round(np.log2(v + 1.0) * 1000).astype(np.uint16) for k, v in sums.items()}
        yield _batch("part sketch", pa.array(list(logs), pa.int32()), tk.binaries([x.tobytes() for x in logs.values()]))

    out = np.zeros(1 << SKETCH_BITS, np.uint16)
    cut = 1 << (SKETCH_BITS - 6)
    summed = told.where("part is not null").select("part", "sketch").repartition(64, "part").mapInArrow(run, "part int, sketch binary")
    got = summed.toArrow()  # 8 MiB; one job, where an iterator takes one a partition
    for part, raw in zip(got["part"].to_pylist(), got["sketch"]):
        out[part * cut : (part + 1) * cut] = np.frombuffer(raw.as_buffer(), np.uint16)
    return out


def prefix_length(n: np.ndarray | int, percent: int):
    """How many shingles of a set of n a partner cannot miss all of."""
    return n - (n * percent + 99) // 100 + 1


def subset_count(n: int, percent: int) -> int:
    return sum(comb(n, c) for c in range((n * percent + 99) // 100, n + 1))


def boundary(histogram: dict[int, int], percent: int, limit: int = 24) -> int:
    """The largest size of a light set: both ways are priced over all sets, in rows sent plus shingles checked."""
    def cost(b: int) -> float:
        light = sum(c * subset_count(n, percent) for n, c in histogram.items() if n <= b)
        heavy = sum(c * (2 * prefix_length(n, percent) + n) for n, c in histogram.items() if n * 100 >= (b + 1) * percent)
        return light + heavy

    return min(range(0, limit + 1), key=lambda b: (cost(b), b))


def _prefixes(docs: DataFrame, k: int, percent: int, light: int, frequent: np.ndarray) -> DataFrame:
    """(key, sid, n, at): subset keys of light sets (at = c) and prefix shingles of heavy ones (at = -position - 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets, ids in _sets(batch, k):
                keys, who, sizes, ats = [], [], [], []

                def put(key: np.ndarray, i: int, at: np.ndarray) -> None:
                    keys.append(key)
                    who.append(np.full(len(key), ids[i]))
                    sizes.append(np.full(len(key), len(sets[i]), np.int64))
                    ats.append(at)

                done = set()
                for i, x in enumerate(sets):
                    n = len(x)
                    if not n or ids[i] in done:
                        continue
                    done.add(ids[i])
                    if n <= light:
                        m = tk.mix(x)
                        for c in range((n * percent + 99) // 100, n + 1):
                            gone = [sum((int(m[j]) for j in out), 0) for out in combinations(range(n), n - c)]
                            total = int(np.sum(m, dtype=np.uint64))
                            sub = np.array([(total - g) & (2**64 - 1) for g in gone], np.uint64)
                            put(tk.mix(sub + np.uint64(c * 0xA0761D6478BD642F & 2**64 - 1)), i, np.full(len(sub), c, np.int64))
                    if n * 100 >= (light + 1) * percent:
                        weight = frequent[(x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                        order = np.lexsort((x, weight))[: prefix_length(n, percent)]
                        put(x[order], i, -np.arange(len(order), dtype=np.int64) - 1)
                if keys:
                    yield _batch("key sid n at", np.concatenate(keys).view(np.int64), np.concatenate(who), np.concatenate(sizes), np.concatenate(ats))

    return docs.select("doc_id", "text").mapInArrow(run, "key long, sid long, n long, at long")


def _needed(a, b, percent: int):
    """The overlap that sets of sizes a and b need."""
    return F.ceil((a + b) * F.lit(percent) / F.lit(100 + percent))


def _texts_of(docs: DataFrame, k: int, sets: DataFrame, wanted: DataFrame, work: str) -> DataFrame:
    """(sid, members) of the sets in wanted. Bloom filters of a document of each, and of the sets, leave
    other texts unread and other sets out of the shuffle."""
    one = materialise(sets.join(wanted, "sid", "left_semi").select("sid", "doc_id"), f"{work}/one")
    n = one.count()
    words, ids = bloom(one, "sid", n), bloom(one.where("doc_id is not null"), "doc_id", n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # rows without an id can't be told apart before their sets are known
            own = batch.column("doc_id").cast(pa.int64())
            near = in_bloom(ids, own.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)) | own.is_null().to_numpy(zero_copy_only=False)
            for _, sets_, sids in _sets(batch.filter(pa.array(near)), k):
                first = np.unique(sids, return_index=True)[1]
                keep = first[in_bloom(words, sids[first].view(np.uint64)) & (sids[first] != 0)]
                if len(keep):
                    yield _batch("sid members", sids[keep], tk.binaries([sets_[i].tobytes() for i in keep]))

    found = docs.select("doc_id", "text").mapInArrow(run, "sid long, members binary")
    return found.groupBy("sid").agg(F.first("members").alias("members")).join(one.select("sid"), "sid", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    """The sets of the pairs, each once."""
    return pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct()


def _possible(sets: DataFrame, pairs: DataFrame, percent: int, work: str) -> DataFrame:
    """The pairs that their counts by range of hashes leave possible."""
    told = materialise(sets.join(_ends(pairs), "sid", "left_semi").select("sid", "n", "counts"), f"{work}/counts")
    side = lambda x, n, c: told.select(F.col("sid").alias(x), F.col("n").alias(n), F.col("counts").alias(c))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(x.as_py() for x in batch.column(c)), np.uint8).reshape(-1, 256) for c in ("a", "b"))
            n, n2 = batch.column("n").to_numpy(), batch.column("n2").to_numpy()
            most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
            full = ((a == 255) & (b == 255)).any(axis=1)  # such a range tells no bound
            mask = pa.array(full | (100 * most >= percent * (n + n2 - most)))
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)], ["u", "v"])

    met = pairs.join(side("u", "n", "a"), "u").join(side("v", "n2", "b"), "v")
    return materialise(met.select("u", "v", "n", "n2", "a", "b").mapInArrow(run, "u long, v long"), f"{work}/possible")


def _only(df: DataFrame, column: str, words: np.ndarray) -> DataFrame:
    """The rows that a Bloom filter of the column's wanted values lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bloom(words, batch.column(column).to_numpy().view(np.uint64))))

    return df.mapInArrow(run, df.schema)


def _crowded(scans: DataFrame, work: str) -> DataFrame:
    """The entries of lists with more than one set."""
    keys = scans.groupBy("key").agg(F.min("sid").alias("a"), F.max("sid").alias("b")).where("a <> b").select("key")
    keys = materialise(keys, f"{work}/keys")
    return materialise(_only(scans, "key", bloom(keys, "key", keys.count())).distinct().join(keys, "key"), "jaccard-crowded")


def _verified(docs: DataFrame, k: int, sets: DataFrame, pairs: DataFrame, percent: int, work: str) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough, by exact intersection; only sets in pairs are sent."""
    near = materialise(_texts_of(docs, k, sets, _ends(pairs), work), f"{work}/members")
    both = pairs.join(near.select(F.col("sid").alias("u"), F.col("members").alias("a")), "u").join(
        near.select(F.col("sid").alias("v"), F.col("members").alias("b")), "v"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"))):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                spot = np.searchsorted(y, x)
                both_n = int(np.count_nonzero(y[np.minimum(spot, len(y) - 1)] == x))
                keep[i] = 100 * both_n >= percent * (len(x) + len(y) - both_n)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("u").filter(mask), batch.column("v").filter(mask)], ["u", "v"])

    return both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def _scan(apart: DataFrame, size: DataFrame, sets: DataFrame, light: int, percent: int, best: int | None = None) -> DataFrame:
    """Pairs (u, v, more) of a list and of different components that may link; lists are compared in memory, by blocks.

    With `best`, each component gives so many pairs of a block at most, the likest by their counts, and of
    pairs between the same components the likest goes out; a row without u, or `more`, tells that pairs
    were left for a later round. Without, all go out, and each that meets in many lists by the one of the
    smallest key, as far as their FIRST_KEYS smallest keys tell; the smallest shared key always gives it.
    """
    wanted = apart.select("sid").distinct()
    counts = sets.join(wanted, "sid", "left_semi").select("sid", "counts")
    first = apart.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list("key")), 1, FIRST_KEYS).alias("first"))
    blocks = F.ceil(F.col("k") / F.lit(LIST_BLOCK)).cast("int")
    met = apart.join(size.select("key", blocks.alias("blocks")), "key").join(counts, "sid").join(first, "sid")
    mine = F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    met = met.withColumn("own", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "n", "at", "root", "counts", "first")

    def pairs(t: dict[str, np.ndarray]) -> tuple[list[np.ndarray], bool]:
        """Of one group: (u, v, root of u, root of v, what they share at most) of rows that may link, and whether some were left out."""
        left, right = np.flatnonzero(t["own"] == t["i"]), np.flatnonzero(t["own"] == t["j"])
        out = []
        for a in range(0, len(left), 64):
            x, y = left[a : a + 64][:, None], right[None, :]
            n, n2, at, at2 = t["n"][x], t["n"][y], t["at"][x], t["at"][y]
            most = np.minimum(n + at, n2 + at2) + np.minimum(-at, -at2)
            ok = (t["root"][x] != t["root"][y]) & ((n > light) | (n2 > light)) & (100 * most >= percent * (n + n2 - most))
            ok &= (x < y) if t["i"][0] == t["j"][0] else True
            for r, c in _rows(ok):
                p, q = left[a + r], right[c]
                one, two = t["counts"][p], t["counts"][q]
                most = np.minimum(one, two).sum(axis=1, dtype=np.int64)
                both, full = t["n"][p] + t["n"][q], ((one == 255) & (two == 255)).any(axis=1)
                most = np.where(full, both, most)
                keep = full | (100 * most >= percent * (both - most))
                p, q, most = p[keep], q[keep], most[keep] / both[keep]
                if len(p) and best is None:
                    keep = ~_share_below(t["first"][p], t["first"][q], t["key"][0])
                    p, q, most = p[keep], q[keep], most[keep]
                if len(p):
                    out.append(np.stack([p, q]).astype(np.int64))
                    out.append(most)
        if not out:
            return [], False
        (p, q), most = np.concatenate(out[::2], axis=1), np.concatenate(out[1::2])
        less = False
        if best is not None:
            keep = _best(t["root"][p], t["root"][q], most, best)
            p, q, most, less = p[keep], q[keep], most[keep], not keep.all()
        return [t["sid"][p], t["sid"][q], t["root"][p], t["root"][q], most], less

    names = ["own", "i", "j", "sid", "n", "at", "root"]
    pad = np.iinfo(np.int64).max

    def table_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        t = {c: batch.column(c).to_numpy() for c in ("key", *names)}
        raw = b"".join(x.as_py() for x in batch.column("counts"))
        col = batch.column("first")
        length = pc.list_value_length(col).to_numpy()
        first = np.full((len(length), FIRST_KEYS), pad, np.int64)
        first[np.arange(FIRST_KEYS) < length[:, None]] = col.flatten().to_numpy()
        return t | {"counts": np.frombuffer(raw, np.uint8).reshape(-1, 256), "first": first}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        left_out = False

        def found(t: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
            nonlocal left_out
            cols, less = pairs(t)
            left_out |= less
            if cols:
                yield _batch("u v ru rv most", *cols)

        for batch in batches:
            if not batch.num_rows:
                continue
            t = table_of(batch)
            if held is not None:
                t = {c: np.concatenate([held[c], t[c]]) for c in t}
            change = np.flatnonzero((np.diff(t["key"]) != 0) | (np.diff(t["i"]) != 0) | (np.diff(t["j"]) != 0)) + 1
            cuts = np.concatenate([[0], change])
            for b, e in zip(cuts[:-1], cuts[1:]):
                if e - b > 1:
                    yield from found({c: t[c][b:e] for c in t})
            held = {c: t[c][cuts[-1] :] for c in t}
        if held is not None and len(held["key"]) > 1:
            yield from found(held)
        if left_out:
            yield _batch("u v ru rv most", *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.float64()))

    dealt = met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "sid")
    told = dealt.mapInArrow(run, "u long, v long, ru long, rv long, most double")
    pair = F.struct(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    if best is None:
        return told.select(pair.alias("p")).distinct().select("p.u", "p.v", F.lit(False).alias("more"))
    roots = F.least("ru", "rv").alias("a"), F.greatest("ru", "rv").alias("b")
    likest = told.select(*roots, "most", pair.alias("p")).groupBy("a", "b").agg(F.max_by("p", F.struct("most", "p")).alias("p"), F.min("p").alias("x"), F.max("p").alias("y"))
    return likest.select("p.u", "p.v", (F.col("p.u").isNull() | (F.col("x") != F.col("y"))).alias("more"))


def _best(a: np.ndarray, b: np.ndarray, most: np.ndarray, best: int) -> np.ndarray:
    """Which pairs of components a and b are among the `best` likest of either."""
    ends, which = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((which, -most[which], ends))
    e = ends[order]
    begin = np.concatenate([[True], e[1:] != e[:-1]])
    rank = np.arange(len(e)) - np.maximum.accumulate(np.where(begin, np.arange(len(e)), 0))
    keep = np.zeros(len(a), bool)
    keep[which[order[rank < best]]] = True
    return keep


def _share_below(a: np.ndarray, b: np.ndarray, key: int) -> np.ndarray:
    """Which rows of a and b, sorted keys each, share a key under `key`."""
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), 1024):
        x, y = a[i : i + 1024], b[i : i + 1024]
        both = np.sort(np.concatenate([x, y], axis=1), axis=1)
        out[i : i + 1024] = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] < key)).any(axis=1)
    return out


def _rows(ok: np.ndarray, most: int = 1 << 13) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The true cells of a matrix, so many at a time."""
    r, c = np.nonzero(ok)
    for i in range(0, len(r), most):
        yield r[i : i + most], c[i : i + most]


def similar_sets(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, sid, n) of every document, and (sid, doc_id, root): each set with its least document and component."""
    told = materialise(set_table(docs, k), "jaccard-sets")
    sets = told.where("part is null")
    rows = sets.select("doc_id", "sid", "n")
    # a row a set, however many documents have it
    each = sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.max("counts").alias("counts"))
    each = materialise(each, "jaccard-each")
    histogram = {r["n"]: r["count"] for r in rows.where("n > 0 and n <= 64").groupBy("n").count().collect()}
    light = boundary(histogram, percent)

    first = f"jaccard-lists-{uuid.uuid4().hex}"  # what only the first steps read
    lists = materialise(_prefixes(docs, k, percent, light, frequencies(told)), f"{first}/all")
    # a subset's smallest set needs the least overlap with every other: pairing with it loses no link
    subsets = lists.where("at > 0").groupBy("key", "at").agg(F.min(F.struct("n", "sid")).alias("f"), F.min("sid").alias("a"), F.max("sid").alias("b")).where("a <> b")
    light_links = lists.where("at > 0").join(subsets.select("key", "at", "f"), ["key", "at"]).where(
        (F.col("sid") != F.col("f.sid")) & (F.col("at") >= _needed(F.col("n"), F.col("f.n"), percent))
    ).select(F.col("f.sid").alias("u"), F.col("sid").alias("v"))
    links = materialise(light_links.distinct(), "jaccard-links")

    near = (F.col("n") * 100 >= F.col("n2") * percent) & (F.col("n2") * 100 >= F.col("n") * percent)
    heavy = (F.col("n") > light) | (F.col("n2") > light)
    # what both sets have from the shared shingle on, and before it, bounds their overlap
    rest = F.least(F.col("n") + F.col("at"), F.col("n2") + F.col("at2")) + 1
    others = F.least(-F.col("at"), -F.col("at2")) - 1
    fits = near & heavy & (rest + others >= _needed(F.col("n"), F.col("n2"), percent))
    crowded = _crowded(lists.where("at < 0"), first)
    discard(docs.sparkSession, first)
    linked = links.limit(1).count() > 0
    found = components(links) if linked else links.select("u", F.col("v").alias("root"))
    tested = None
    for best in (0, *BEST):
        work = f"jaccard-round-{uuid.uuid4().hex}"  # what only this round reads
        known = crowded.withColumn("root", F.col("sid"))
        if linked:
            known = crowded.join(found, crowded["sid"] == found["u"], "left").select("key", "sid", "n", "at", F.coalesce("root", "sid").alias("root"))
        # written, so that the rows of a long list may be dealt to many tasks
        turn = F.struct(F.xxhash64("sid").alias("turn"), "sid", "n", "at", "root")
        leader = [F.min(turn).alias("h")] if best == 0 else []
        split = known.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("k"), *leader)
        split = materialise(split.where("a <> b").drop("a", "b"), f"{work}/split")
        if not split.limit(1).count():
            break
        apart = materialise(known.join(split.select("key"), "key"), "jaccard-apart") if linked else known
        crowded = apart.drop("root")  # lists of one component stay so
        if best == 0:
            head = split.select("key", *[F.col(f"h.{a}").alias(b) for a, b in (("sid", "sid2"), ("n", "n2"), ("at", "at2"), ("root", "root2"))])
            pairs = apart.join(head, "key").where((F.col("root") != F.col("root2")) & fits)
            pairs = pairs.select(F.least("sid", "sid2").alias("u"), F.greatest("sid", "sid2").alias("v")).distinct()
            pairs = tested = materialise(pairs, "jaccard-pairs")
            if pairs.limit(FEW + 1).count() > FEW:
                pairs = _possible(each, pairs, percent, work)
            more = True
        else:
            scanned = materialise(_scan(apart, split, each, light, percent, best), "jaccard-pairs")
            more = bool(scanned.where("more").limit(1).count())
            pairs = scanned.where("u is not null").select("u", "v").join(tested, ["u", "v"], "left_anti")
            tested = tested.union(scanned.where("u is not null").select("u", "v"))
        new = materialise(_verified(docs, k, each, pairs, percent, work), "jaccard-links")
        discard(docs.sparkSession, work)
        if new.limit(1).count():
            # what is known already is a forest of stars
            found, linked = components(found.select("u", F.col("root").alias("v")).union(new)), True
        if not more:
            break
    return rows, each.select("sid", "doc_id").join(found, F.col("sid") == F.col("u"), "left").select("sid", "doc_id", F.coalesce("root", "sid").alias("root"))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    rows, own = similar_sets(docs.select(F.col(id_col).alias("doc_id"), "text"), k, percent)
    own = materialise(own, "jaccard-roots")
    least = own.groupBy("root").agg(F.min("doc_id").alias("least"))
    least = materialise(hot_join(own.select("sid", "root"), least, "root").select("sid", "least"), "jaccard-least")
    # sets without shingles all have the id 0, which least doesn't hold
    return hot_join(rows, least, "sid").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
