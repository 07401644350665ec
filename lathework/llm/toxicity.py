"""Toxic spans and scores from a linear-chain conditional random field.

Two states, plain and toxic. A token's features are the word and its first and last letters; a
field of weights and transitions is fitted by gradient steps over tokens of labelled texts,
each step one Spark job that sums the gradients of all tasks. Tokens are labelled from
the labels of documents: in a toxic text, those with a feature that hardly occurs elsewhere.
Forward-backward gives each token's marginal; a document's score is a logistic function
of the sum and the maximum of its marginals, and neighbouring tokens above one half are spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import add_up, c
from lathework.llm.common import narrow, text_of
from lathework.llm.mixing import place_hash
from lathework.llm.rules import held_out
from lathework.llm.textbytes import chunks, word_array, word_bounds
from lathework.session import settle

FIT_ROWS = 12_000  # labelled rows at most that the field is fitted on, chosen by the hash of the id
LEAST_TEXTS = 3  # texts of the sample that a feature is in at least
EVIDENCE = 20.0  # likelihood ratio from which a feature marks its tokens as toxic
MARKING = 0.6  # share of a feature's tokens that are in toxic texts, from which it can mark
BURST = 4  # tokens of one text that count for that share
STEPS = 30
DECAY = 0.1  # of the squared weights, against the sum of the log likelihoods
CUT = 0.7
HELD_OUT, AT = 3, 1
LANE = 1024
TEXT_BYTES = 1 << 22  # text whose words and tokens are looked at together
TOKEN = re.compile(r"\w+")
BETWEEN = np.array([b < 128 and not TOKEN.match(chr(b)) for b in range(256)])  # bytes that are in no token
CACHE_WORDS = 300_000


def features(word: str) -> list[str]:
    """The word, its first letters and its last letters."""
    w = word.lower()
    return ["w" + w, *["p" + w[:k] for k in (3, 4, 5, 6, 7) if len(w) > k], *["s" + w[-k:] for k in (3, 4) if len(w) > k]]


def coded(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the texts in ``data``: how many each has, the number of each token's word, and the distinct words.

    The same as ``TOKEN.findall``: bytes decide where all are ASCII, the pattern in other texts.
    """
    high = np.flatnonzero(data > 127)
    if len(high):
        other = set((np.searchsorted(offsets, high, side="right") - 1).tolist())
        parts = [data[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        for i in other:  # tokens parted by blanks; all bytes above 127 belong to one
            parts[i] = np.frombuffer(" ".join(TOKEN.findall(parts[i].tobytes().decode())).encode(), np.uint8)
        offsets, data = np.concatenate([[0], np.cumsum([len(x) for x in parts])]), np.concatenate(parts)
    starts, ends, first = word_bounds(offsets, data, BETWEEN)
    if not len(starts):
        return np.diff(first), np.zeros(0, np.int32), np.zeros(0, object)
    found = word_array(data[~BETWEEN[data]], ends - starts).dictionary_encode()
    return np.diff(first), found.indices.to_numpy(), found.dictionary.cast(pa.large_string()).to_numpy(zero_copy_only=False)


def between_lanes(hit, a, enter, begin, size, owner, number) -> tuple[np.ndarray, np.ndarray]:
    """Messages into the first and out of the last token of lanes, by products of the lanes' matrices.

    The lanes of rows that have several, the longest first; a message is the toxic part over the plain one.
    """
    product = np.tile(np.eye(2), (len(begin), 1, 1))
    for t in range(int(size[0])):
        k = int(np.searchsorted(-size, -t, side="left"))  # lanes longer than t
        m = np.empty((k, 2, 2))
        m[:] = a
        if t == 0:
            m[number == 0] = enter  # a row's first token comes from a fixed state
        m[:, :, 1] *= hit[begin[:k] + t][:, None]
        q = product[:k]
        p = q[:, :, :1] * m[:, :1, :] + q[:, :, 1:] * m[:, 1:, :]
        product[:k] = p / p.max(axis=(1, 2))[:, None, None]
    into, outof = np.zeros(len(begin)), np.ones(len(begin))
    order = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[order], np.arange(int(number.max()) + 2))
    lanes = [order[x:y] for x, y in zip(edges[:-1], edges[1:])]
    message = np.tile(np.array([1.0, 0.0]), (int(owner.max()) + 1, 1))
    for at in lanes:
        m = message[owner[at]]
        into[at] = m[:, 1] / m[:, 0]
        m = np.einsum("ri,rij->rj", m, product[at])
        message[owner[at]] = m / m.sum(axis=1)[:, None]
    message[:] = 1.0
    for at in reversed(lanes):
        m = message[owner[at]]
        outof[at] = m[:, 1] / m[:, 0]
        m = np.einsum("rij,rj->ri", product[at], m)
        message[owner[at]] = m / m.sum(axis=1)[:, None]
    return into, outof


def forward_backward(logits: np.ndarray, lengths: np.ndarray, steps: np.ndarray, start: float, with_pairs=True):
    """Marginals of the toxic state, sums over pairs if asked for, and log normalisers of all rows.

    ``logits``: how much a token speaks for the toxic state; ``steps[i, j]``: log weight of a
    step from state i to j, ``start``: of a toxic first token. A message between two tokens is
    one number, its toxic part over its plain one. Tokens lie by their place in the row, so that
    numpy takes a step of all rows at once; long rows are cut into lanes, whose products carry
    messages over them, so that they need few sequential steps too.
    """
    n = len(logits)
    if not n:
        return np.zeros(0), np.zeros((2, 2)), np.zeros(len(lengths))
    lanes = -(-lengths // LANE)
    owner = np.repeat(np.arange(len(lengths)), lanes)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    size = np.minimum(lengths[owner] - number * LANE, LANE)
    begin = np.cumsum(size) - size
    by = np.argsort(-size, kind="stable")  # so that the lanes that still run are always the first ones
    rank = np.empty(len(by), dtype=np.int64)
    rank[by] = np.arange(len(by))
    active = np.searchsorted(-size[by], -np.arange(int(size.max()) + 1), side="left")  # lanes longer than t
    place = np.concatenate([[0], np.cumsum(active)])
    at = place[np.arange(n) - np.repeat(begin, size)] + np.repeat(rank, size)
    hit = np.exp(np.clip(logits, -30, 30))
    a = np.exp(steps)
    (a00, a01), (a10, a11) = a.tolist()
    enter = float(np.exp(start))
    into, outof = np.zeros(len(by)), np.ones(len(by))
    cut = np.flatnonzero((lanes > 1)[owner[by]])
    if len(cut):
        x = by[cut]
        into[cut], outof[cut] = between_lanes(hit, a, np.array([1.0, enter]), begin[x], size[x], owner[x], number[x])
    moved = np.empty(n)
    moved[at] = hit
    # forward; a plain part grows by the factors in grown
    ahead, grown = np.empty(n), np.empty(n)
    before, k = into, len(by)
    for t in range(len(active) - 1):
        k, p = int(active[t]), int(place[t])
        f, g, m = ahead[p:p + k], grown[p:p + k], before[:k]
        np.multiply(m, a10, out=g)
        g += a00
        np.multiply(m, a11, out=f)
        f += a01
        f /= g
        if t == 0:
            opens = number[by] == 0
            f[opens], g[opens] = enter, 1.0
        f *= moved[p:p + k]
        before = f
    # backward
    back = np.empty(n)
    for t in range(len(active) - 2, -1, -1):
        k, p, more = int(active[t]), int(place[t]), int(active[t + 1])
        b = back[p:p + k]
        b[more:] = outof[more:k]
        if more:
            q = moved[p + k:p + k + more] * back[p + k:p + k + more]
            d = q * a01
            d += a00
            q *= a11
            q += a10
            np.divide(q, d, out=b[:more])
    ratio = (ahead * back)[at]
    marginal = ratio / (1.0 + ratio)
    first = np.cumsum(lengths) - lengths
    full = lengths > 0
    factor, after = np.log(grown)[at], ahead[at]
    norm = np.zeros(len(lengths))
    norm[full] = np.add.reduceat(factor, first[full]) + np.log1p(after[(first + lengths - 1)[full]])
    pairs = np.zeros((2, 2))
    if with_pairs:
        inner = np.ones(n, dtype=bool)
        inner[first[full]] = False
        inner = np.flatnonzero(inner)
        f, q = after[inner - 1], (moved * back)[at[inner]]
        parts = [np.full(len(inner), a00), a01 * q, a10 * f, a11 * f * q]
        total = sum(parts)
        pairs = np.array([(x / total).sum() for x in parts]).reshape(2, 2)
    return marginal, pairs, norm


@dataclass
class Field:
    """Weights of the features, log weights of the steps, and the document's logistic function."""

    weights: dict
    bias: float
    steps: np.ndarray
    start: float
    document: tuple = (0.0,) * 6


class Logits(dict):
    """What each word speaks for the toxic state, kept by word; empties itself when full."""

    def __init__(self, model: Field):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHE_WORDS:
            self.clear()
        get, out = self.model.weights.get, self.model.bias
        for f in features(word):
            out += get(f, 0.0)
        self[word] = out
        return out


def evidence(toxic: float, total: float, share: float) -> float:
    """Likelihood ratio of a feature's toxic share against the share of all documents."""
    p = toxic / total
    if p <= share:
        return 0.0
    rest = (1 - p) * log((1 - p) / (1 - share)) if p < 1 else 0.0
    return 2 * total * (p * log(p / share) + rest)


def count_features(rows: DataFrame) -> DataFrame:
    """``feature, toxic, total, toxic_tokens, tokens``: in how many documents each feature is.

    And on how many tokens, of which a document adds a few at most.
    """
    names = ("toxic", "total", "toxic_tokens", "tokens")

    def run(batches):
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for row, offsets, data in chunks(batch.column("text")):
                lengths, codes, words = coded(offsets, data)
                if not len(codes):
                    continue
                index: dict = {}
                column = [[index.setdefault(f, len(index)) for f in features(w)] for w in words]
                own = np.array([len(x) for x in column])
                flat, begin = np.array([i for x in column for i in x]), np.cumsum(own) - own
                # each text's words and how often it has them, then the same for features
                cell, n = np.unique(np.repeat(np.arange(len(lengths)), lengths) * len(words) + codes, return_counts=True)
                text, word = cell // len(words), cell % len(words)
                each = own[word]
                inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                key = np.repeat(text * len(index), each) + flat[np.repeat(begin[word], each) + inside]
                order = np.argsort(key)
                key = key[order]
                new = np.flatnonzero(np.diff(key, prepend=-1))
                tokens = np.minimum(np.add.reduceat(np.repeat(n, each)[order], new), BURST)
                text, feature = key[new] // len(index), key[new] % len(index)
                label = labels[row + text]
                sums = [np.bincount(feature, x, minlength=len(index)) for x in (label, np.ones(len(new)), tokens * label, tokens)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(index)), *[pa.array(x.astype(np.int64)) for x in sums]], names=["feature", *names]
                )

    counts = rows.select("text", "label").mapInArrow(run, "feature string, " + ", ".join(f"{n} long" for n in names))
    return counts.groupBy("feature").agg(*[F.sum(n).alias(n) for n in names])


def fit_field(rows: DataFrame, steps=STEPS, least_texts=LEAST_TEXTS, needed=EVIDENCE) -> Field | None:
    """The field from ``text, label`` rows; None without rows of both labels.

    Every feature of ``least_texts`` texts is kept, so the rows of the sample bound their number.
    """
    n, ones = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, n):
        return None
    share = ones / n
    chosen = count_features(rows).filter(F.col("total") >= least_texts).orderBy("feature").toArrow()
    names, *counts = (chosen.column(k).to_pylist() for k in ("feature", "toxic", "total", "toxic_tokens", "tokens"))
    index = {f: i for i, f in enumerate(names)}
    marks = {
        f for f, toxic, total, own, tokens_of in zip(names, *counts)
        if own >= MARKING * tokens_of and evidence(toxic, total, share) >= needed
    }
    del chosen, names, counts
    shared = rows.sparkSession.sparkContext.broadcast((index, marks))
    size = len(index) + 1  # and a bias

    def tokens(batches):
        """Each batch as arrays: words of its texts with their features, tokens, labels."""
        known, marked = shared.value
        for batch in batches:
            labels = batch.column("label").to_numpy()
            for row, offsets, data in chunks(batch.column("text"), TEXT_BYTES):
                lengths, ids, words = coded(offsets, data)
                of = [features(w) for w in words]
                column = [[known[f] for f in fs if f in known] for fs in of]
                is_marked = np.array([any(f in marked for f in fs) for fs in of], dtype=bool)
                label = np.repeat(labels[row:row + len(lengths)], lengths)
                gold = ((label > 0) & is_marked[ids]).astype(np.uint8)
                parts = [
                    lengths.astype(np.int64), ids.astype(np.int32), gold, np.array([len(x) for x in column], np.int32),
                    np.array([i for x in column for i in x], np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["lengths", "ids", "gold", "own", "features"])

    data = settle(rows.select("text", "label").mapInArrow(tokens, "lengths binary, ids binary, gold binary, own binary, features binary"), "tokens")
    shared.destroy()  # the arrays are written

    def gradient(theta):
        weights, trans, start = theta[:size], theta[size:size + 4].reshape(2, 2), theta[size + 4]
        sent = data.sparkSession.sparkContext.broadcast((weights, trans, start))

        def run(batches):
            weights, trans, start = sent.value
            total = np.zeros(size + 6)
            for batch in batches:
                for parts in zip(*(batch.column(k).to_pylist() for k in ("lengths", "ids", "gold", "own", "features"))):
                    lengths, ids, gold, own, feats = (np.frombuffer(p, t) for p, t in zip(parts, (np.int64, np.int32, np.uint8, np.int32, np.int32)))
                    word = np.repeat(np.arange(len(own)), own)
                    of_word = weights[-1] + np.bincount(word, weights[feats], minlength=len(own))
                    logits = of_word[ids]
                    marginal, pairs, norm = forward_backward(logits, lengths, trans, start)
                    first = np.zeros(len(ids), dtype=bool)
                    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
                    inner = np.flatnonzero(~first)
                    gold_pairs = np.bincount(2 * gold[inner - 1] + gold[inner], minlength=4).reshape(2, 2)
                    apart = gold - marginal
                    by_word = np.bincount(ids, apart, minlength=len(own))
                    total[:size - 1] += np.bincount(feats, by_word[word], minlength=size - 1)
                    total[size - 1] += apart.sum()
                    total[size:size + 4] += (gold_pairs - pairs).ravel()
                    total[size + 4] += apart[first].sum()
                    total[size + 5] += (logits * gold).sum() + (trans * gold_pairs).sum() + start * gold[first].sum() - norm.sum()
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])

        parts = data.mapInArrow(run, "g binary").toArrow().column("g")
        sent.destroy()
        return np.sum([np.frombuffer(g.as_buffer()) for g in parts], axis=0)

    theta = climb(gradient, size + 5, steps)
    return Field(
        {f: float(theta[i]) for f, i in index.items() if abs(theta[i]) > 1e-6}, float(theta[size - 1]),
        theta[size:size + 4].reshape(2, 2), float(theta[size + 4]),
    )


def climb(gradient, size: int, steps: int, decay=DECAY, memory=6) -> np.ndarray:
    """Limited-memory quasi-Newton ascent of the penalised likelihood, one job a step."""
    theta = np.zeros(size)

    def at(x):
        g = gradient(x)
        n = scale[0]
        return (g[-1] - decay * (x @ x) / 2) / n, (g[:-1] - decay * x) / n

    scale = [1.0]
    raw = gradient(theta)
    scale[0] = max(1.0, -raw[-1] / log(2))  # tokens: each costs log 2 at the start
    value, g = raw[-1] / scale[0], raw[:-1] / scale[0]
    pairs: list = []
    step = 1.0 / max(1e-12, float(np.abs(g).sum()))
    for turn in range(steps):
        q, saved = g.copy(), []
        for s, y, rho in reversed(pairs):
            alpha = rho * (s @ q)
            q -= alpha * y
            saved.append(alpha)
        if pairs:
            s, y, rho = pairs[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, rho), alpha in zip(pairs, reversed(saved)):
            q += s * (alpha - rho * (y @ q))
        size_of = step if turn == 0 else 1.0
        for _ in range(6):
            new = theta + size_of * q
            new_value, new_g = at(new)
            if new_value > value:
                break
            size_of *= 0.3
        else:
            break
        s, y = new - theta, g - new_g
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y, 1.0 / (s @ y))][-memory:]
        gain, theta, value, g = new_value - value, new, new_value, new_g
        if gain < 1e-7 * abs(value):
            break
    return theta


def tagged(rows: DataFrame, model: Field) -> DataFrame:
    """``rows`` without ``text``, with ``total, most, tokens, spans`` of its toxic marginals.

    ``spans``: ``begin, end`` in code points of neighbouring tokens whose marginal is above
    one half.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [x for x in rows.columns if x != "text"]
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        logits = Logits(shared.value)
        m = shared.value
        for batch in batches:
            for at, offsets, data in chunks(batch.column("text"), TEXT_BYTES):
                lengths, ids, words = coded(offsets, data)
                part = batch.slice(at, len(lengths))
                of_word = np.fromiter(map(logits.__getitem__, words), float, len(words))
                marginal, _, _ = forward_backward(of_word[ids], lengths, m.steps, m.start, with_pairs=False)
                total, most, spans = [], [], []
                for i, (b, n) in enumerate(zip((np.cumsum(lengths) - lengths).tolist(), lengths.tolist())):
                    own = marginal[b:b + n]
                    total.append(float(own.sum()))
                    most.append(float(own.max()) if n else 0.0)
                    spans.append(_spans(part.column("text")[i].as_py(), own) if n and most[-1] > 0.5 else [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in kept]
                    + [pa.array(total, pa.float64()), pa.array(most, pa.float64()), pa.array(lengths), pa.array(spans, kind)],
                    names=[*kept, "total", "most", "tokens", "spans"],
                )

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in kept)
    return rows.select(*kept, "text").mapInArrow(run, f"{schema}, total double, most double, tokens long, spans array<struct<begin:long,end:long>>")


def _spans(text: str, marginal: np.ndarray) -> list:
    out, before = [], -2
    hits = set(np.flatnonzero(marginal > 0.5).tolist())
    for i, m in enumerate(TOKEN.finditer(text)):
        if i in hits:
            if before == i - 1:
                out[-1]["end"] = m.end()
            else:
                out.append({"begin": m.start(), "end": m.end()})
            before = i
    return out


def summary():
    """What the document's logistic function looks at, all from the marginals."""
    one, two = F.least("total", F.lit(1.0)), F.least("total", F.lit(2.0))
    share = F.when(F.col("tokens") > 0, F.col("total") / F.col("tokens")).otherwise(F.lit(0.0))
    return F.array(F.log1p("total"), "most", one, two, F.log1p(1000.0 * share))


def fit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", fit_rows=FIT_ROWS, **options) -> Field:
    """A field with its document function, from labelled rows that are not held out.

    Fits on at most about ``fit_rows`` rows. Without rows of both labels every score is the
    smoothed share of label 1.
    """
    known = labels.select(c(doc_id).alias("_k"), c(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("_k").isNotNull() & ~held_out(F.col("_k"), HELD_OUT, AT)
    ).groupBy("_k").agg(F.max("label").alias("label"))
    known = settle(known, "labels")
    n, ones = known.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    sample = known.filter(place_hash(F.col("_k")) < float(1 << 52) * min(1.0, fit_rows / max(1, n)))
    rows = narrow(docs, doc_id=c(doc_id), text=text_of(text)).join(sample.hint("broadcast"), F.col("doc_id") == F.col("_k"))
    rows = settle(rows.select("text", "label").repartition(12), "sample")
    model = fit_field(rows, **options)
    if model is None:
        return Field({}, -30.0, np.zeros((2, 2)), -30.0, (log((ones + 1) / (n - ones + 1)), *[0.0] * 5))
    scored = tagged(rows, model).select("label", array_to_vector(summary()).alias("features")).persist()
    last = LogisticRegression(regParam=1e-4, maxIter=50).fit(scored)
    scored.unpersist()
    model.document = (float(last.intercept), *[float(x) for x in last.coefficients.toArray()])
    return model


def toxicity(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", cut=CUT, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` for each row of ``docs``.

    ``spans`` are the offending code points. A null text is an empty one and has a score too;
    repeated rows get one score each, the same. Only the text makes the score. Without labels of
    both kinds no span is marked and all scores are equal. An empty table gives an empty
    table. Other columns are not read.
    """
    model = fit(docs, labels, doc_id, text, label, **options)
    bias, *weights = model.document
    found = tagged(narrow(docs, doc_id=c(doc_id), text=text_of(text)), model)
    found = found.withColumn("looks", summary())
    total = add_up([F.lit(bias), *[F.col("looks")[i] * w for i, w in enumerate(weights)]])
    found = found.withColumn("score", 1 / (1 + F.exp(-total)))
    return found.select(
        "doc_id", held_out(F.col("doc_id"), HELD_OUT, AT).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"), "spans",
    )
