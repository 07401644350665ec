"""Exact dedup, near join, repeated passages and Merkle fingerprints against brute force."""

import hashlib
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow as pa
import pytest

from lathework.llm import components, exact_dedup, merkle, near_join, suffix_dedup, textbytes
from lathework.llm.common import free_shuffles
from lathework.session import recorded, settle
from pyspark.sql import functions as F

SPACE = re.compile(r"[\x20\x09-\x0D]")


def key(v):
    return (v is None, v if v is not None else 0)


def test_exact(nasty):
    rows = nasty.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub("", r["text"] or "")].append(r)
    want = Counter()
    for norm, members in groups.items():
        keep = min(members, key=lambda r: (-len(r["text"] or ""), key(r["doc_id"])))["doc_id"]
        for r in members:
            want[(r["doc_id"], keep, len(members), hashlib.sha256(norm.encode()).hexdigest())] += 1
    got = exact_dedup.exact_duplicates(nasty).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


@pytest.mark.parametrize("bits", [exact_dedup.BLOCK, 1 << 20])
def test_exact_does_not_depend_on_the_filter(docs, bits):
    full = exact_dedup.exact_duplicates(docs)
    tight = exact_dedup.exact_duplicates(docs, bits_per_row=1, max_bits=bits)
    assert full.exceptAll(tight).count() == 0 and full.count() == tight.count() == docs.count()


def test_filter_flags_every_repeated_hash(spark):
    df = spark.range(3000).select(F.xxhash64(F.when(F.col("id") < 2000, F.lit(1)).otherwise(F.col("id"))).alias("h"), "id").repartition(5)
    found = exact_dedup.repeated_slots(df.select("h"), 1 << 16)
    flagged = exact_dedup.flag_repeated(df, 1 << 16, found)
    assert flagged.filter("id < 2000 AND NOT maybe").count() == 0
    assert flagged.filter("id >= 2000 AND maybe").count() < 100


def test_keep_distinct(nasty):
    out = exact_dedup.keep_distinct(nasty)
    assert out.columns == nasty.columns
    norms = [SPACE.sub("", r["text"] or "") for r in out.collect()]
    assert sorted(norms) == sorted({SPACE.sub("", r["text"] or "") for r in nasty.collect()})


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return Counter((d, len(sets[i]), min(least[find(i)], key=key)) for i, (d, _) in enumerate(rows))


def near_cluster(seed=5, copies=60):
    """Copies of one text with more and more words changed, and texts that share a passage only."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(5000)}" for _ in range(150)]
    passage = " ".join(f"p{rng.randrange(5000)}" for _ in range(40))
    rows = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randrange(7)):
            text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(text[: 150 - 3 * (i % 4)])))
    for i in range(copies):
        rows.append((1000 + i, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(40 + i))))
    return rows


def test_near_against_brute_force(spark, nasty):
    for rows in ([tuple(r) for r in nasty.select("doc_id", "text").collect()], near_cluster()):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = near_join.near_duplicates(df.withColumn("_at", F.lit(1)).withColumn("id", F.lit(2)))
        assert Counter(tuple(r) for r in got.select("doc_id", "n_shingles", "component_id").collect()) == brute_components(rows)


def test_keep_one(nasty):
    out = near_join.keep_one(nasty)
    assert out.columns == nasty.columns
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect()]
    want = len({c for _, n, c in brute_components(rows) if n}) + sum(k for (_, n, _), k in brute_components(rows).items() if not n)
    assert out.count() == want


def test_prefixes_go_before_texts_are_fetched(spark, monkeypatch):
    """The prefixes, the largest table but the texts, are on the disk no longer than they are read."""
    there = []

    def fetched(*args, real=near_join.texts_of):
        there.append([x for x in written if os.path.exists(x.removeprefix("file:"))])
        return real(*args)

    monkeypatch.setattr(near_join, "texts_of", fetched)
    rows = near_cluster()
    with recorded() as written:
        got = near_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in got) == brute_components(rows)
    assert len(there) == 1 and {os.path.basename(x) for x in there[0]} == {"distinct", "groups", "lists", "members"}


def test_recorders_that_are_equal(spark):
    with recorded() as outer:
        with recorded() as inner:
            settle(spark.range(2))
        settle(spark.range(3))
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]


def test_free_shuffles(spark):
    """Files of a job that nothing refers to go at once, also those of the last job."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x for x in re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" "))}

    for _ in range(3):
        before = files()
        counts = spark.range(20_000).withColumn("k", F.col("id") % 100).groupBy("k").count()
        settle(spark.range(20_000).withColumn("k", F.col("id") % 100).join(counts.hint("merge"), "k").groupBy("k").agg(F.sum("count")))
        own = files() - before
        assert own
        free_shuffles(spark)
        for _ in range(20):
            if not own & files():
                break
            time.sleep(0.1)
        assert not own & files()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 600)]
    df = spark.createDataFrame(edges, "a long, b long")
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components.components(df.limit(0)).count() == 0


def brute_repeats(rows, window=200):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(t[i:i + window] for t in raw for i in range(len(t) - window + 1))
    out = []
    for (d, _), t in zip(rows, raw):
        spans = []
        for i in range(len(t) - window + 1):
            if count[t[i:i + window]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + t[at:a], b
        out.append((d, len(t), kept + t[at:], tuple(map(tuple, spans))))
    return Counter(out)


@pytest.mark.parametrize("sort_runs", [2, suffix_dedup.SORT_RUNS])
def test_repeats_against_brute_force(spark, nasty, sort_runs):
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect() if r["doc_id"] != 11]
    rng = random.Random(2)
    common = "".join(rng.choice("abcdefgh ") for _ in range(260))
    for i in range(30):  # one passage in many contexts, cut at many places
        a, b = rng.randrange(60), rng.randrange(1, 60)
        rows.append((100 + i, "".join(rng.choice("xyz") for _ in range(150)) + common[a:-b] + "".join(rng.choice("uvw") for _ in range(150))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_dedup.remove_repeats(df, sort_runs=sort_runs)
    found = Counter((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple((x["begin"], x["end"]) for x in r["spans"])) for r in got.collect())
    assert found == brute_repeats(rows)


def test_runs_of_many_texts_are_those_of_each():
    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (0, 199, 200, 1500, 3, 200, 900)]
    texts.append(np.tile(texts[3][:7], 200))  # equal anchors: the first place counts
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = list(zip(*suffix_dedup.runs_of(offsets, np.concatenate(texts))))
    want = []
    for i, t in enumerate(texts):
        own = suffix_dedup.runs_of(np.array([0, len(t)]), t)
        want += [(i, *x[1:]) for x in zip(*own)] if own is not None else []
    assert found == want and suffix_dedup.runs_of(offsets[:3], texts[1]) is None
    for i, t in enumerate(texts):  # each window once, and never more than fit around an anchor
        covered = [w for text, first, n, *_ in found if text == i for w in range(first, first + n)]
        assert covered == list(range(max(0, len(t) - 199)))
    assert max(x[2] for x in found) <= 137


@pytest.mark.parametrize("rows", [1, 3, 10_000])
def test_stretches_join_across_batches(spark, rows):
    rng = random.Random(5)
    have = [(rng.choice([-4, 0, 1, 2, 9]), a, a + rng.randrange(1, 40)) for a in (rng.randrange(900) for _ in range(120))]
    want = {}
    for row, a, b in sorted(have):
        mine = want.setdefault(row, [])
        if mine and a <= mine[-1][1]:
            mine[-1][1] = max(b, mine[-1][1])
        else:
            mine.append([a, b])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        got = suffix_dedup.joined(spark.createDataFrame(have, "_row long, begin long, end long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert {r["_row"]: [list(x) for x in r["hits"]] for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("window, size, runs", [(200, 1, 1), (200, 7, 4), (21, 7, 4), (200, 20, 4096), (200, 1, 4096), (200, 1000, 4096)])
def test_anchors_sorted_in_parts_are_those_of_one(monkeypatch, window, size, runs):
    monkeypatch.setattr(suffix_dedup, "SORT_RUNS", runs)
    rng = random.Random(6)
    kinds = [bytes(rng.choice(b"ab") for _ in range(window + 30)) for _ in range(4)]
    rows = []
    for r in range(60):  # copies of a few kinds that differ in a byte, with their anchors at one place or another
        raw = bytearray(rng.choice(kinds))
        raw[rng.randrange(len(raw))] = 120
        a, n, place = rng.randrange(10), rng.randrange(1, 20), rng.randrange(20, 23)
        rows.append((r // 12 * 1000, r, n, place, 1 + (r % 17 == 0), bytes(raw[a:a + n + window - 1])))
    names = ["h", "r", "windows", "place", "many", "stretch"]
    whole = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=names)
    seen = Counter()
    for h, _, n, place, many, raw in rows:
        seen.update({(h, place - s, raw[s:s + window]): many for s in range(n)})
    want = {}
    for h, r, n, place, _, raw in rows:
        hit = [s for s in range(n) if seen[h, place - s, raw[s:s + window]] > 1]
        if hit:
            want[h, r] = (hit[0], hit[-1])
    parts = [whole.slice(i, size) for i in range(0, len(rows), size)]
    got = [x for b in suffix_dedup._sort_anchors(iter(parts), window) for x in zip(*b.to_pydict().values())]
    assert len(got) == len(want) > 3 and {(h, r): (low, high) for h, r, low, high in got} == want


def test_blind_trie_orders_and_groups():
    rng = np.random.default_rng(0)
    table = rng.integers(0, 3, (200, 6)).astype(np.uint64)
    trie = suffix_dedup.BlindTrie(table, 0)
    for i in range(1, 200):
        trie.add(i)
    leaves = list(trie.leaves())
    assert sorted(i for x in leaves for i in x) == list(range(200))
    keys = [tuple(table[x[0]]) for x in leaves]
    assert keys == sorted(set(keys)) and all((table[x] == table[x[0]]).all() for x in leaves)


def test_shingles_of_slices():
    column = pa.array(["a b c d e f", None, "", "G h i j k", "x"])
    for part in (column, column.slice(1), column.slice(3, 1)):
        sets = [x for _, o, d in textbytes.chunks(part, 4) for x in textbytes.distinct_by_row(*textbytes.shingles(o, d))]
        assert [len(x) for x in sets] == [len(shingle_set(t)) for t in part.to_pylist()]


def test_merkle(spark, nasty):
    got = merkle.edit_likeness(nasty)
    rows = sorted({(r["doc_id"], r["text"] or "") for r in nasty.select("doc_id", "text").collect()}, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = {}
    for i, (d, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        want[d] = (len(t), t[: len(t) - len(t) // 2] + nxt[: len(t) // 2])
    out = got.collect()
    assert len(out) == nasty.count()
    prints = {}
    for r in out:
        assert (r["n_chars"], r["edited"]) == want[r["doc_id"]]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        text = dict(rows)[r["doc_id"]]
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if r["edited"] == text:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    assert len(set(prints.values())) == len(prints)
    single = merkle.edit_likeness(spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")).first()
    assert single["near_next"] == 1.0 and 0 < single["near_edited"] < 1


def test_merkle_names_the_edited_branch(spark):
    rows = [(1, "a b\nc d\n\ne f\ng h"), (2, "a b\nc X\n\ne f\ng h")]
    a, b = (r["fingerprint"] for r in merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect())
    (root, rest), (root2, rest2) = a.split(":"), b.split(":")
    same = [x == y for x, y in zip(rest.split(";"), rest2.split(";"))]
    assert root != root2 and same == [False, True]
    assert [x == y for x, y in zip(rest.split(";")[0].split("=")[1].split(","), rest2.split(";")[0].split("=")[1].split(","))] == [True, False]


@pytest.mark.parametrize("job", [
    exact_dedup.exact_duplicates, exact_dedup.keep_distinct, near_join.near_duplicates, near_join.keep_one, suffix_dedup.remove_repeats,
    merkle.edit_likeness,
])
def test_empty_table(nothing, job):
    assert job(nothing).count() == 0
