"""Vector codes, the filter audit and personal data against plain Python."""

import glob
import hashlib
import os
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.llm import ball_codes, filter_audit, hot, pii, term_matrix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_full_search(rows, parts, entries, rounds):
    """Codes, errors and codebooks of ``(vec_id, label, whole numbers)``, already sorted."""
    x = np.array([r[2] for r in rows], dtype=np.int64).reshape(len(rows), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()
    for k in range(rounds + 1):
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        code = far.argmin(axis=2)
        if k < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    held = x[code[:, p] == e, p]
                    if len(held):
                        books[p, e] = [int(s) // len(held) for s in held.sum(axis=0)]
    return code, far.min(axis=2).sum(axis=1), books


@pytest.mark.parametrize("seed, spread, entries", [(1, 3.0, 16), (2, 0.01, 16), (3, 200.0, 5), (4, 1.0, 64)])
def test_codes_are_those_of_a_full_search(spark, seed, spread, entries):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (7, 8))
    rows = [(int(i), [None, 1, 2][i % 3], (centres[i % 7] + rng.normal(0, spread / 8, 8)).tolist()) for i in range(300)]
    rows += [(i, 1, list(rows[0][2])) for i in range(300, 420)]  # a third of all is one vector
    want = by_full_search([(i, n, np.floor(np.array(v) * 256).astype(np.int64)) for i, n, v in rows], 4, entries, 2)
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    codes, books = ball_codes.fit_codes(df, parts=4, entries=entries, rounds=2)
    got = sorted(codes.collect(), key=lambda r: r["vec_id"])
    assert [list(r["code"]) for r in got] == want[0].tolist() and [r["error"] for r in got] == want[1].tolist()
    assert (books == want[2]).all()


def test_stable_cores_and_rings_save_work():
    entries = np.array([[0, 0], [100, 0], [0, 100], [1000, 1000]])
    ball = ball_codes.Balls.of(entries, np.array([60.0, 60.0, 60.0, 10.0]))
    assert ball.neighbour[ball.start[0]:ball.start[1]].tolist() == [1, 2] and ball.start[4] == ball.start[3]
    found, far = ball.assign(np.array([[10, 0], [50, 0], [51, 0], [0, 60]]), np.zeros(4, np.int64))
    assert found.tolist() == [0, 0, 1, 2] and far.tolist() == [100, 2500, 49 * 49, 1600]  # ties go to the lower index


def test_codes_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5] * 16), (1, 1, [0.5] * 16), (2, None, None), (3, None, [nan] * 16), (4, 2, [inf] + [0.0] * 15), (5, 2, [None] + [1.0] * 15),
            (None, None, [-0.001] * 16), (7, None, [2.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").select(
        "*", *[F.lit("x").alias(n) for n in ("q", "code", "error", "_n", "_key")]
    )
    got = sorted(map(tuple, ball_codes.vector_codes(df).collect()), key=str)
    assert [r[0] for r in got] == [1, 1, 7, None] and all(r[2] == 0 and r[3] == 0 for r in got)
    assert {r[0]: r[1] for r in got} == {1: "00" * 16, 7: "02" * 16, None: "03" * 16}
    assert len({r[4] for r in got}) == 1
    assert ball_codes.vector_codes(df.limit(0)).count() == 0 and ball_codes.vector_codes(df.filter("vec_id = 3")).count() == 0
    with pytest.raises(ValueError, match="components"):
        ball_codes.vector_codes(spark.createDataFrame([(1, 1, [1.0] * 15)], df.schema[:3]))


def test_attach(spark, tmp_path):
    rows = spark.createDataFrame([("a",)] * 900 + [(None,)] * 900 + [(f"k{i}",) for i in range(900)], "k string")
    answers = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.length(F.coalesce("k", F.lit("")))).filter("k <> 'k7' OR k IS NULL")
    for many in (1, 3, 1000, 10_000):
        before, hot.MANY = hot.MANY, many
        try:
            out = hot.attach(rows, answers, "k", "n")
        finally:
            hot.MANY = before
        got = Counter((r["k"], r["v"]) for r in out.collect())
        assert got == Counter((k, None if k == "k7" else len(k or "")) for (k,) in rows.collect())


def cells_of(matrix, terms):
    """``{doc_id: [Counter of words, ...]}`` of a matrix."""
    words = {r["term"]: r["word"].decode() for r in terms.collect()}
    assert len(set(words.values())) == len(words)
    out = defaultdict(list)
    for r in matrix.collect():
        ends, counts, found = term_matrix.wide(r["ends"]), term_matrix.wide(r["counts"]), term_matrix.terms_of(r["ends"], r["terms"])
        for doc, a, b in zip(r["docs"], ends[:-1], ends[1:]):
            assert (np.diff(found[a:b]) > 0).all()
            out[doc["doc_id"]].append(Counter({words[t]: n for t, n in zip(found[a:b].tolist(), counts[a:b].tolist())}))
    return out


@pytest.mark.parametrize("shard, piece", [(1 << 22, 1 << 19), (2000, 300), (1, 1)])
def test_term_matrix(nasty, monkeypatch, shard, piece):
    monkeypatch.setattr(term_matrix.pieces, "__defaults__", (piece,))
    rows = nasty.select("doc_id", "text")
    got = cells_of(*term_matrix.term_matrix(rows, shard_bytes=shard))
    want = defaultdict(list)
    for r in rows.collect():
        want[r["doc_id"]].append(Counter(WORD.findall(r["text"] or "")))
    order = lambda found: {k: sorted(map(str, map(sorted, (c.items() for c in v)))) for k, v in found.items()}
    assert order(got) == order(want)


def test_pieces_cut_between_words():
    import pyarrow as pa

    text = "aa bb " * 50 + "c" * 400 + " dd"
    found = list(term_matrix.pieces(pa.array(["x y", text, None, "z"]), 20))
    assert b"".join(bytes(d) for r, _, d in found if r == 1).decode() == text
    words = [bytes(d[a:b]).decode() for _, o, d in found for a, b in zip(*term_matrix.word_bounds(o, d)[:2])]
    assert words == ["x", "y", *text.split(), "z"]


def test_words_with_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(term_matrix, "stretch_hash", lambda sums, a, b: (a * 0).astype(np.uint64))
    rows, codes, words = term_matrix.encoded(np.array([0, 10]), np.frombuffer(b"aa b ab aa", np.uint8))
    assert [words[i] for i in codes] == [b"aa", b"b", b"ab", b"aa"]


def test_term_matrix_over_small_batches(spark, nasty, monkeypatch):
    rows = nasty.select("doc_id", "text")
    want = cells_of(*term_matrix.term_matrix(rows, shard_bytes=500))
    monkeypatch.setattr(term_matrix, "HELD_WORDS", 2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = cells_of(*term_matrix.term_matrix(rows, shard_bytes=500))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    order = lambda found: {k: sorted(map(str, map(sorted, (c.items() for c in v)))) for k, v in found.items()}
    assert order(got) == order(want)


def test_words_travel_by_bucket(nasty):
    found = term_matrix.local_shards(nasty.select("doc_id", "text"), 3, shard_bytes=500).collect()
    of_word = {}
    for r in found:
        assert [x["bucket"] for x in r["words"]] == sorted({x["bucket"] for x in r["words"]}) and len(r["words"]) <= 3
        at = 0
        for x in r["words"]:  # buckets follow each other in the shard's columns
            sizes = term_matrix.wide(x["sizes"])
            assert x["at"] == at and sizes.sum() == len(x["raw"])
            at += len(sizes)
            for a, n in zip(np.cumsum(sizes) - sizes, sizes):
                assert of_word.setdefault(bytes(x["raw"][a:a + n]), x["bucket"]) == x["bucket"]
    assert len(found) > 1
    want = {w.encode() for r in nasty.collect() for w in WORD.findall(r["text"] or "")}
    assert set(of_word) == want and len(set(of_word.values())) == 3


def test_filter_audit(spark, nasty, nothing):
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(19)] + [(3, None, False), (None, 1, True), (4, 1, None)], "doc_id long, quality int, t boolean")
    labels = labels.select("doc_id", "quality", F.col("t").cast("int").alias("toxic"), F.lit(1).alias("part"))
    docs = nasty.withColumn("lang", F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 4 == 1, "EN").otherwise("en"))
    docs = docs.select("*", *[F.lit("z").alias(x) for x in ("part", "fails", "digest", "words", "shard", "copies")])
    rows = docs.select("doc_id", "text", "lang").collect()
    least = {}
    for r in rows:
        if r["doc_id"] is not None:
            least[r["text"] or ""] = min(r["doc_id"], least.get(r["text"] or "", r["doc_id"]))
    one = {"quality": defaultdict(int), "toxic": defaultdict(int)}
    for r in labels.collect():
        for k in one:
            one[k][r["doc_id"]] = max(one[k][r["doc_id"]], r[k] or 0)
    failed = []
    for r in rows:
        t = r["text"] or ""
        w = WORD.findall(t)
        tests = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": r["doc_id"] is not None and r["doc_id"] > least[t]}
        i = r["doc_id"]
        failed.append((r["lang"] or "", {k for k, v in tests.items() if v}, i is not None and one["quality"][i], i is not None and one["toxic"][i]))
    want = {}
    shapley = Counter()
    for part in {f[0] for f in failed}:
        for order in map("".join, permutations("ABCDE")):
            left = [f for f in failed if f[0] == part]
            for step, own in enumerate(order, 1):
                gone = [f for f in left if own in f[1]]
                left = [f for f in left if own not in f[1]]
                every = [f for f in failed if f[0] == part and own in f[1]]
                want[part, order, step] = (len(left), len(gone), len(every) - len(gone), sum(f[1] == {own} for f in every),
                                           sum(bool(f[2]) for f in gone), sum(bool(f[3]) for f in gone))
                shapley[part, own] += len(gone)
    got = {tuple(r)[:3]: tuple(r)[3:] for r in filter_audit.filter_audit(docs, labels).collect()}
    assert got == {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}
    assert filter_audit.filter_audit(nothing, labels).count() == 0


def by_rules(text):
    """The rules' patterns as they are stated."""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(x) for x in m.group() if x.isdigit()]
        check = sum(sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and check % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(x.isdigit() for x in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


@pytest.mark.parametrize("letters", ["a.@-1_", "1.0 2", "12- 0", "+1 ().-9a", "a@b.c1-+ 2()_\n"])
def test_rules_for_personal_data(letters):
    rng = random.Random(letters)
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert pii.base_spans(text) == by_rules(text), text


@pytest.mark.parametrize("unit", ["1", "a", "1.", "+1", "@", "a@", "1 ", "(1", "a:"])
def test_long_runs_are_linear(unit):
    pii.mentions_of(unit * 200_000)


def test_patterns_find_what_rules_do_not(spark, nasty):
    rows = [(i, f"w{i} please call me at +1 (555) 010-{i:04d} today and 4111111111111111 x") for i in range(20)]
    rows += [(100 + i, f"v{i} please call me at (555) 020-{i:04d} today") for i in range(4)]
    rows += [(200, "the part number 555 030 1234 is out"), (201, "mail ann@example.com or reach us at (555) 020-0001 é"), (202, "é call me at 17 today")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.personal_data(df.unionByName(nasty.select("doc_id", "text").filter("doc_id IS NULL"))).collect()}
    for i, text in rows:
        assert hashlib.sha256(listed(by_rules(text)).encode()).hexdigest() == got[i]["base_sha256"]
        want = by_rules(text)
        if 100 <= i < 110 or i == 201:  # the value that is known from elsewhere counts as well
            at = text.index("(555)")
            want = sorted([*want, (at, 3, at + len("(555) 020-0000"))])
        assert got[i]["spans"] == listed(want), text
    assert got[0]["n_phone"] == got[0]["n_card"] == 1 and got[200]["found"] == 0 and got[202]["found"] == 0


def test_personal_data_of_odd_rows(nasty, nothing):
    extra = nasty.select("*", *[F.lit(1).alias(x) for x in ("mentions", "value", "kind", "more", "base")])
    got = pii.personal_data(extra).collect()
    assert len(got) == nasty.count()
    want = Counter((r["doc_id"], hashlib.sha256(listed(by_rules(r["text"] or "")).encode()).hexdigest()) for r in nasty.collect())
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got) == want
    assert pii.personal_data(nothing).count() == 0


def test_pipeline_is_the_first_query_of_a_session_elsewhere(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession as S; "
        "s = S.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', 4)"
        f".config('spark.checkpoint.dir', {str(tmp_path / 'shared')!r}).getOrCreate(); "
        "print('rows', e.queries()['pipeline'](s, '/root/testdata/sf0.001').count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "rows" in done.stdout, done.stderr[-2000:]
    kept = {os.path.basename(x) for x in glob.glob(f"{tmp_path}/shared/*/*")}
    assert not kept & {"sets", "lists", "open", "rows", "placed", "digests"}  # helper tables of finished stages
