"""Rules and the random field on held-out labels, forward-backward against enumeration."""

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lathework.llm import rules, textbytes, toxicity


def accuracy(found, labels, label):
    rows = found.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = rules.quality(docs, labels).cache()
    assert found.count() == docs.count()
    assert accuracy(found, labels, "quality") >= 0.93


def test_toxicity_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity(docs, labels).cache()
    assert accuracy(found, labels, "toxic") >= 0.9
    marked = found.filter("size(spans) > 0").join(docs, "doc_id").select("text", "spans").collect()
    assert marked and all(r["text"][x["begin"]:x["end"]].strip() for r in marked for x in r["spans"])


def test_held_out_labels_are_not_learned_from(spark, nasty):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(20)], "doc_id long, quality int, toxic int")
    for every, at, job, label in ((5, 0, rules.quality, "quality"), (3, 1, toxicity.toxicity, "toxic")):
        flipped = labels.withColumn(label, F.when(rules.held_out(F.col("doc_id"), every, at), 1 - F.col(label)).otherwise(F.col(label)))
        one, two = (job(nasty, x).select("doc_id", "score").dropDuplicates() for x in (labels, flipped))
        assert one.exceptAll(two).count() == 0


@pytest.mark.parametrize("job", [rules.quality, toxicity.toxicity])
def test_edges(spark, nasty, nothing, job):
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    found = job(nasty, labels)
    assert found.count() == nasty.count() and found.filter("score IS NULL OR score < 0 OR score > 1 OR isnan(score)").count() == 0
    assert job(nothing, labels).count() == 0
    assert job(nasty, labels.limit(0)).select("score").distinct().collect() == [(0.5,)]
    ones = labels.filter("quality = 1 AND toxic = 0")
    assert job(nasty, ones).select("score").distinct().count() == 1


def test_rules_are_compiled(spark):
    model = rules.RuleModel(-1.0, [((("chars", True, 3.0), ("shouts", False, 0.5)), 2.0), ((("chars", False, 3.0),), -1.0)])
    df = rules.with_statistics(spark.createDataFrame([("abcdef",), ("ab",), ("!!!!!!",)], "text string")).select("text", model.score().alias("s"))
    got = {r["text"]: r["s"] for r in df.collect()}
    logistic = lambda x: 1 / (1 + np.exp(-x))
    assert got == pytest.approx({"abcdef": logistic(1.0), "ab": logistic(-2.0), "!!!!!!": logistic(-1.0)})
    assert rules.tightened((("a", True, 1.0), ("a", True, 2.0), ("b", False, 3.0))) == (("a", True, 2.0), ("b", False, 3.0))


def test_keep_quality(spark, docs, labels):
    kept = rules.keep_quality(docs, labels)
    found = rules.quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in found.filter("predicted = 1").select("doc_id").collect())


@pytest.mark.parametrize("lengths", [(5, 0, 1, 7), (3,)])
def test_forward_backward(monkeypatch, lengths):
    monkeypatch.setattr(toxicity, "LANE", 3)
    rng = np.random.default_rng(1)
    logits, steps, start = rng.normal(size=sum(lengths)), rng.normal(size=(2, 2)), 0.4
    marginal, pairs, norm = toxicity.forward_backward(logits, np.array(lengths), steps, start)
    at, want_pairs = 0, np.zeros((2, 2))
    for row, n in enumerate(lengths):
        own = logits[at:at + n]
        total, ones = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(np.dot(own, y) + (start * y[0] if n else 0) + sum(steps[a, b] for a, b in zip(y, y[1:])))
            total += w
            ones += w * np.array(y)
        if n:
            assert marginal[at:at + n] == pytest.approx(ones / total) and norm[row] == pytest.approx(np.log(total))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(np.dot(own, y) + (start * y[0] if n else 0) + sum(steps[a, b] for a, b in zip(y, y[1:]))) / total
            for a, b in zip(y, y[1:]):
                want_pairs[a, b] += w
        at += n
    assert pairs == pytest.approx(want_pairs)


def test_climb_finds_the_maximum():
    def gradient(x):  # a concave function whose maximum is at 3
        return np.concatenate([-2 * (x - 3), [-((x - 3) ** 2).sum() - 10]])

    assert toxicity.climb(gradient, 4, 30, decay=0.0) == pytest.approx(np.full(4, 3.0), abs=1e-3)


def test_coded_tokens_are_those_of_the_pattern():
    texts = ["", "a_b-c 1.5x", "  ", "ümlaut ßtraße_1 x٣", "日本 語a\u00a0b", "Same same same", "\x00a\x7fb", None, "é"]
    at = 0
    for row, offsets, data in textbytes.chunks(pa.array(texts), 12):
        lengths, ids, words = toxicity.coded(offsets, data)
        assert row == at and len(set(words)) == len(words)
        for text, own in zip(texts[row:row + len(lengths)], np.split(words[ids], np.cumsum(lengths))):
            assert own.tolist() == toxicity.TOKEN.findall(text or "")
        at += len(lengths)
    assert at == len(texts)


def test_lanes_do_not_change_marginals(monkeypatch):
    rng = np.random.default_rng(2)
    lengths = np.array([2500, 0, 1, 1024, 1025, 40])
    logits, steps = rng.normal(scale=9.0, size=lengths.sum()), rng.normal(size=(2, 2))
    found = []
    for lane in (7, toxicity.LANE, 5000):
        monkeypatch.setattr(toxicity, "LANE", lane)
        found.append(toxicity.forward_backward(logits, lengths, steps, -0.3))
    for got in found[:-1]:
        assert all(a == pytest.approx(b, rel=1e-9, abs=1e-12) for a, b in zip(got, found[-1]))


def test_feature_counts(spark):
    rows = [("Abcd abcd x", 1), ("abcd", 0), ("x " * 9, 1), (None, 0), ("", 1)]
    df = spark.createDataFrame(rows, "text string, label int").repartition(2)
    found = {r["feature"]: tuple(r)[1:] for r in toxicity.count_features(df).collect()}
    want = {}
    for text, label in rows:
        tally = Counter(f for w in toxicity.TOKEN.findall(text or "") for f in toxicity.features(w))
        for f, n in tally.items():
            n = min(n, toxicity.BURST)
            want[f] = tuple(a + b for a, b in zip(want.get(f, (0,) * 4), (label, 1, n * label, n)))
    assert found == want
