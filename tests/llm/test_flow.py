"""Packing, mixing, pages, lists and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check_queries import compare, connect
from lathework.llm import html_text, mixing, packing, url_lists
from lathework.llm.registry import QUERIES
from lathework.llm.tokens import ChunkIds

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return np.array(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def check_pieces(pieces, texts, capacity=2048):
    """Every id once, sequences without gaps, and no padding at all."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p["ids"]), "<u4")
        assert len(ids) == p["length"] > 0
        by_doc[p["doc_id"]].append((p["start"], ids, p["doc_tokens"]))
        by_seq[p["sequence_id"]].append((p["offset"], p["length"]))
    want = defaultdict(list)
    for d, t in texts:
        want[d].append(whole_ids(t))
    assert set(by_doc) == set(want)
    for d, found in by_doc.items():
        total = Counter()
        for start, ids, n in found:
            total.update((start + i, int(x), n) for i, x in enumerate(ids))
        assert total == Counter((i, int(x), len(ids)) for ids in want[d] for i, x in enumerate(ids))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0


def test_pack(nasty):
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect()]
    pieces = packing.pack(nasty, PATH).withColumn("crc", packing.ids_crc32()).collect()
    check_pieces(pieces, rows)
    assert all(p["crc"] == zlib.crc32(bytes(p["ids"])) for p in pieces)


def test_pack_small_windows_and_nothing(nasty, nothing):
    rows = [tuple(r) for r in nasty.select("doc_id", "text").collect() if r["doc_id"] != 11]
    check_pieces(packing.pack(nasty.filter("doc_id <> 11 OR doc_id IS NULL"), PATH, capacity=64).collect(), rows, 64)
    assert packing.pack(nothing, PATH).count() == 0


def test_level_choice_is_the_best_one():
    rng = np.random.default_rng(4)
    packer = packing.LevelPacker(32)
    for i in range(500):
        size = int(rng.integers(1, 32))
        n = packer.counts.copy()
        costs = {}
        for level in range(0, 32 - size + 1):
            if level and not n[level]:
                continue
            m = n.copy()
            m[level] -= bool(level)
            if level + size < 32:
                m[level + size] += 1
            costs[level] = int((m[:32] ** 2).sum())
        assert costs[packer.level_for(size)] == min(costs.values())
        packer.place(i, np.zeros(size, "<u4"))
        assert (packer.counts[32], packer.counts.min()) == (0, 0)


def test_chunk_ids_equal_whole_texts(docs):
    ids = ChunkIds(PATH, most=50)
    texts = [r["text"] for r in docs.limit(40).collect()]
    for t in [*texts, "It's DON'T,. a, b. é́ ﬁ ΑΣ İx 12.5 a\x1cb c d <|endoftext|>x"]:
        assert ids.of(t) + np.array([1], "<u4").tobytes() == whole_ids(t).tobytes()


def test_mix(nasty, nothing):
    rows = mixing.mix_summary(nasty).collect()
    assert len(rows) == nasty.count()
    per = {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        t = per.setdefault(r["source_size"], [r["target"], 0])
        t[1] += r["taken"]
    assert all(abs(target - taken) <= 1 for target, taken in per.values())
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.mix_summary(nasty.repartition(7)).collect()), key=str)
    tiny = mixing.mix_summary(nasty, bucket_rows=2).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, tiny), key=str)
    assert mixing.mix_summary(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_mixed_rows(nasty):
    out = mixing.mix(nasty)
    assert out.columns == nasty.columns
    words = out.select(mixing.count_words(F.col("text")).alias("w")).agg(F.sum("w")).first()[0]
    assert words == sum(r["taken"] for r in mixing.mix_summary(nasty).collect())


def test_targets_stop_at_twice_the_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 5)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes).collect()}
    assert got["a"] == 20.0 and got[None] == 10.0 and got["b"] == pytest.approx(1.5 * 1015 - 30)


def test_schedules(spark):
    knots = spark.createDataFrame([("a", 0.0, 2.0), ("a", 0.5, 0.0), ("a", 1.0, 4.0), ("b", 0.0, 0.0)], "source string, t double, w double")
    rows = mixing.integrated(knots)
    got = rows.select(F.explode(F.sequence(F.lit(0), F.lit(10))).alias("i"), "segments").select(
        "i", mixing.inverse(F.col("segments"), F.col("i") / 10.0).alias("t")
    ).collect()
    for r in got:  # area: 0.5 up to one half, 1.0 beyond
        t = r["t"]
        area = t * 2 - 2 * t * t if t <= 0.5 else 0.5 + 4 * (t - 0.5) ** 2
        assert area / 1.5 == pytest.approx(r["i"] / 10, abs=1e-6)


PAGES = [
    (1, "<html><body><nav>Home About</nav><article><h1>A &amp; B</h1><p>One <b>two</b>three\n four<p>five</article><footer>c</footer>", "A & B One twothree four five"),
    (2, '<body><div class="sidebar">s s s s</div><div><h1>Title</h1><p>' + "word " * 30 + '</p></div><div id="comments"><p>' + "nice " * 20 + "</p></div>", "Title " + ("word " * 30).strip()),
    (3, None, ""), (4, "", ""), (5, "<script>var a = '<p>no</p>';</script>", ""), (6, "plain &lt;text&gt;", "plain <text>"),
    (7, "<main><form>f <input></form><p>Only&nbsp;this<!-- not <p>this</p> --></p><aside>x</aside></main>", "Only this"),
    (8, "<p>" + "long " * 50_000, ("long " * 50_000).strip()),
]


def test_pages(spark):
    df = spark.createDataFrame([(i, f"http://x/{i}", h) for i, h, _ in PAGES], "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r["page_id"]: r for r in html_text.extract(df).collect()}
    for i, _, want in PAGES:
        assert (got[i]["text"], got[i]["n_chars"]) == (want, len(want)), i
    assert html_text.extract(df.limit(0)).count() == 0


def test_region_is_the_best_stretch():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.integers(-4, 5, 12).astype(float).tolist()
        best = max([0.0, *[sum(s[a:b]) for a in range(12) for b in range(a + 1, 13)]])
        a, b = html_text.best_region(s)
        assert sum(s[a:b]) == best


def test_lists(spark):
    entries = spark.createDataFrame(
        [("b.com", "block", 10, "add"), ("b.com", "block", 20, "remove"), ("b.com", "block", 20, "add"), ("a.b.com", "allow", 15, "add"),
         ("b.com", "block", 30, "remove"), (None, "block", 1, "add"), ("c.com", "block", 5, "add"), ("c.com", "block", 5, "remove")],
        "domain string, kind string, at long, action string",
    )
    captures = spark.createDataFrame(
        [(1, "http://x.b.com/p", 9), (2, "http://X.b.com/p", 10), (3, "http://a.b.com", 16), (4, "https://u@b.com:80/", 20),
         (5, "http://b.com./", 30), (6, None, 12), (7, "http://c.com/", 6), (8, "http://b.com/", None), (8, "http://b.com/", None)],
        "i int, url string, fetched_at long",
    )
    got = Counter((r["i"], r["url_blocked"], r["url_rule"]) for r in url_lists.judge(captures, entries).collect())
    # the additions at 10 end at 20; at the same instant an addition counts before a removal
    assert got == Counter({
        (1, False, None): 1, (2, True, "b.com"): 1, (3, False, "a.b.com"): 1, (4, False, None): 1, (5, False, None): 1, (6, False, None): 1,
        (7, False, None): 1, (8, False, None): 2,
    })
    assert url_lists.judge(captures, entries.limit(0)).filter("url_blocked").count() == 0
    assert url_lists.judge(captures.limit(0), entries).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if oracle_sql().get(n)))
def test_query(spark, data, name):
    status, rows, note = compare(connect(data), queries()[name](spark, data), oracle_sql()[name])
    assert status == "ok" and rows > 0, note


def test_pipeline(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], data).cache())
        assert steps[-1].columns == docs.columns
    n = [s.count() for s in steps]
    assert n[0] > n[1] > n[2] >= n[3] > 0 and n[4] > 0
    texts = [tuple(r) for r in steps[4].select("doc_id", "text").collect()]
    check_pieces(corpus_pipeline.STAGES[-1][1](spark, steps[4], data).collect(), texts)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "mix", "pack"]
