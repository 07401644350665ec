"""Quality scores from a sparse ensemble of rules.

Trees are fitted to statistics of labelled texts. Every path from a root to a node is a rule, a
conjunction of thresholds. A logistic model with an absolute penalty weighs the rules and
drops most of them; what is left is compiled into one column expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import exp, log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import SPACE, WORD, narrow, text_of
from lathework.llm.mixing import place_hash
from lathework.session import settle

FIT_ROWS = 20_000  # labelled rows at most that a model is fitted on, chosen by the hash of the id
TREES = 24
DEPTH = 3
PENALTY = 0.002
CUT = 0.3
HELD_OUT = 5


def statistics(text: Column) -> dict[str, Column]:
    """What the rules look at; shares of an empty text are 0."""
    size = F.char_length(text)
    words = F.regexp_count(text, F.lit(WORD))
    lines = F.split(text, "\n")

    def share(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def of(pattern):  # characters of a kind
        return F.char_length(F.regexp_replace(text, pattern, ""))

    tokens = F.split(text, f"{SPACE}+")
    return {
        "chars": size.cast("double"),
        "words": words.cast("double"),
        "word_size": share(of(f"{SPACE}+"), words),
        "letters": share(of(r"\P{L}+"), size),
        "capitals": share(of(r"\P{Lu}+"), size),
        "digits": share(of(r"[^0-9]+"), size),
        "shouts": share(of(r"[^!?]+"), size),
        "symbols": share(of(r"[^#$%&*|<>{}\[\]=_~^@+\\/]+"), size),
        "stops": share(of(r"[^.,;:]+"), size),
        "words_distinct": share(F.size(F.array_distinct(tokens)), F.size(tokens)),
        "lines_distinct": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "line_size": share(size, F.size(lines)),
    }


def with_statistics(df: DataFrame, text="text") -> DataFrame:
    """The statistics, each computed once, beside the other columns in ``stats``."""
    return df.withColumn("stats", F.struct(*[v.cast("double").alias(k) for k, v in statistics(c(text)).items()]))


def with_fixed_statistics(df: DataFrame, text="text") -> DataFrame:
    """Like :func:`with_statistics`, for a filter that follows.

    The optimizer moves a filter below what it looks at and puts the statistics in each place
    where one is named. It does not do so with a column that holds a row number.
    """
    values = [v.cast("double").alias(k) for k, v in statistics(c(text)).items()]
    return df.withColumn("stats", F.struct(*values, F.monotonically_increasing_id().alias("at")))


NAMES = (
    "chars", "words", "word_size", "letters", "capitals", "digits", "shouts", "symbols", "stops", "words_distinct",
    "lines_distinct", "line_size",
)


@dataclass
class RuleModel:
    """Weighted conjunctions ``((statistic, is_above, threshold), ...)`` and an intercept."""

    intercept: float
    rules: list = field(default_factory=list)

    def score(self, stats="stats") -> Column:
        """The probability of label 1 as a column expression."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(holds(rule, stats), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule, stats="stats") -> Column:
    tests = [(F.col(f"{stats}.{name}") > F.lit(t)) if above else (F.col(f"{stats}.{name}") <= F.lit(t)) for name, above, t in rule]
    return reduce(lambda a, b: a & b, tests)


def paths(node, names, rule=()):
    """All rules of a tree: the conjunction at each node below the root."""
    if rule:
        yield tightened(rule)
    if node.subtreeDepth() > 0:
        name, t = names[node.split().featureIndex()], node.split().threshold()
        yield from paths(node.leftChild(), names, (*rule, (name, False, t)))
        yield from paths(node.rightChild(), names, (*rule, (name, True, t)))


def tightened(rule) -> tuple:
    """A rule with one threshold for each statistic and side, in a fixed order."""
    best: dict = {}
    for name, above, t in rule:
        old = best.get((name, above), t)
        best[name, above] = max(old, t) if above else min(old, t)
    return tuple(sorted((name, above, t) for (name, above), t in best.items()))


def fit_rules(labelled: DataFrame, trees=TREES, depth=DEPTH, penalty=PENALTY, fit_rows=FIT_ROWS, seed=7) -> RuleModel:
    """A model from ``doc_id, stats, label`` (0 or 1).

    Fits on at most about ``fit_rows`` rows. With no rows the score is 0.5 for all, with
    one label it is that label's smoothed share.
    """
    count, ones = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if ones in (0, count):
        return RuleModel(log((ones + 1) / (count - ones + 1)))
    part = F.lit(1.0) if count <= fit_rows else F.lit(fit_rows / count)
    sample = labelled.filter(place_hash(F.col("doc_id")) < part * float(1 << 52)).select("doc_id", "stats.*", F.col("label").cast("double"))
    sample = sample.repartition(8, "doc_id").sortWithinPartitions("doc_id").persist()
    try:
        vectors = VectorAssembler(inputCols=list(NAMES), outputCol="features", handleInvalid="error").transform(sample)
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, subsamplingRate=0.5, maxBins=64,
            featureSubsetStrategy="0.5", seed=seed,
        ).fit(vectors)
        found = sorted({rule for i in range(trees) for rule in paths(forest._java_obj.trees()[i].rootNode(), NAMES)})
        if not found:
            return RuleModel(log((ones + 1) / (count - ones + 1)))
        # rows with the same bits count as one row with a weight
        bits = F.array(*[holds_flat(rule).cast("double") for rule in found])
        table = sample.select("label", bits.alias("bits")).groupBy("label", "bits").agg(F.count("*").cast("double").alias("rows"))
        table = table.select("label", "rows", array_to_vector("bits").alias("features")).coalesce(4).persist()
        lasso = LogisticRegression(
            elasticNetParam=1.0, regParam=penalty, maxIter=40, tol=1e-5, standardization=False, weightCol="rows"
        ).fit(table)
        table.unpersist()
        weights = lasso.coefficients.toArray()
        return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(found, weights) if abs(w) > 1e-9])
    finally:
        sample.unpersist()


def holds_flat(rule) -> Column:
    return reduce(lambda a, b: a & b, [(c(n) > F.lit(t)) if above else (c(n) <= F.lit(t)) for n, above, t in rule])


def held_out(doc_id: Column, every=HELD_OUT, at=0) -> Column:
    """Rows whose label is never learned from: crc32 of the id as text, modulo."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % every == at


def known_labels(labels: DataFrame, label="quality", doc_id="doc_id") -> DataFrame:
    """``doc_id, label`` of the ids that are not held out. A null label is no label; of several, 1 wins."""
    return labels.select(c(doc_id).alias("doc_id"), c(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.max("label").alias("label"))


def fit_on(stats: DataFrame, labels: DataFrame, label="quality", doc_id="doc_id", **options) -> RuleModel:
    """A model from the labelled rows of ``stats`` (``doc_id, stats``) that are not held out."""
    known = known_labels(labels, label, doc_id)
    return fit_rules(settle(stats.select("doc_id", "stats").join(known, "doc_id"), "labelled"), **options)


def fit_on_texts(rows: DataFrame, labels: DataFrame, label="quality", doc_id="doc_id", fit_rows=FIT_ROWS, **options) -> RuleModel:
    """Like :func:`fit_on` from ``rows`` (``doc_id, text``), with statistics of the rows of the fit only.

    Ids and labels decide which rows those are; the ids, about ``fit_rows`` at most, go to the texts.
    """
    met = settle(rows.select("doc_id").join(known_labels(labels, label, doc_id), "doc_id"), "met")
    count = met.count()
    part = 1.0 if count <= fit_rows else fit_rows / count
    chosen = met.filter(place_hash(F.col("doc_id")) < part * float(1 << 52)).distinct()
    fitted = with_statistics(rows.join(F.broadcast(chosen), "doc_id")).drop("text")
    return fit_rules(settle(fitted, "labelled"), fit_rows=fit_rows, **options)


def quality(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", cut=CUT, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    A null text is an empty one and has a score too; repeated rows get one score each, the same.
    Only the text makes the score. An empty table gives an empty table. Other columns are
    not read.
    """
    rows = narrow(docs, doc_id=c(doc_id), text=text_of(text))
    stats = settle(with_statistics(rows).drop("text"), "statistics")
    model = fit_on(stats, labels, label, **options)
    scored = stats.withColumn("score", model.score())
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted")
    )


def keep_quality(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", cut=CUT, **options) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``cut``, with their columns.

    The statistics of labelled rows fit the model; those of all rows are computed where the
    rows are read, so no text is shuffled. A null text counts as an empty one: blank rows have
    a score and stay or go by it. An empty table gives an empty table.
    """
    model = fit_on_texts(narrow(docs, doc_id=c(doc_id), text=text_of(text)), labels, label, **options)
    whole = docs.select(F.struct(*[c(x) for x in docs.columns]).alias("whole"), text_of(text).alias("text"))
    return with_fixed_statistics(whole).filter(model.score() >= cut).select("whole.*")
