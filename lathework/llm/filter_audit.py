"""How five document filters act on each other, in every order in which they can be applied.

Row sums and nonzero cells of the document-term matrix decide the filters on words; the others
look at characters and at equal texts. Documents are counted by the set of filters that they
fail; all orders and steps follow from those counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import text_of
from lathework.llm.hot import attach
from lathework.llm.term_matrix import row_totals, term_matrix
from lathework.session import settle

FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the characters
SYMBOLS = r"[#$%&*|]"


def failures(docs: DataFrame, doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """``doc_id, part, fails`` for each row of ``docs``; ``fails`` has the letters of the filters it fails.

    A: under 100 words. B: under 80 % of them distinct. C: over 10 % capitals. D: holds a symbol.
    E: the same text as a row with a smaller doc_id. A null text is an empty one, a null ``lang``
    the empty part. A row without doc_id neither fails E nor makes another fail. Repeated rows
    count one by one. Other columns are not read.
    """
    body = text_of(text)
    rows = docs.select(
        c(doc_id).alias("doc_id"), F.coalesce(c(lang).cast("string"), F.lit("")).alias("part"),
        (100 * F.regexp_count(body, F.lit("[A-Z]")) > MOST_CAPITALS * F.char_length(body)).alias("c"),
        body.rlike(SYMBOLS).alias("d"), F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("text"),
    )
    matrix, _ = term_matrix(rows)
    flags = settle(row_totals(matrix), "flags")
    copies = flags.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).filter("copies > 1")
    found = attach(flags, settle(copies, "copies"), "digest", "copies")
    tests = {
        "A": F.col("words") < LEAST_WORDS, "B": 100 * F.col("distinct") < LEAST_DISTINCT * F.col("words"), "C": F.col("c"),
        "D": F.col("d"), "E": F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)),
    }
    return found.select("doc_id", "part", F.concat(*[F.when(t, k).otherwise("") for k, t in tests.items()]).alias("fails"))


def audit(failed: DataFrame, labels: DataFrame, doc_id="doc_id", filters=FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, with counts of documents.

    ``failed``: ``doc_id, part, fails``. ``kept`` are left after the step, ``removed`` go in it,
    ``redundant`` fail its filter but went earlier, ``unique_fails`` fail no other filter,
    ``good_lost`` and ``toxic_lost`` are those of ``removed`` with label ``quality`` or ``toxic`` 1,
    ``shapley`` sums ``removed`` of the filter over all orders. Of several labels of an id, 1 wins;
    a row without doc_id has no labels. An empty table gives an empty table.
    """
    known = labels.filter(c(doc_id).isNotNull()).groupBy(c(doc_id).alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic")
    ).filter("good = 1 OR toxic = 1")
    counted = failed.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count("good").alias("good"), F.count("toxic").alias("toxic")
    )
    orders = ",".join("".join(p) for p in permutations(filters))
    steps = counted.select("*", F.explode(F.split(F.lit(orders), ",")).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step")
    )
    own = F.substr(F.col("filter_order"), F.col("step"), F.lit(1))
    earlier = F.substr(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    fails = F.contains(F.col("fails"), own)
    alive = F.col("fails") == F.call_function("translate", F.col("fails"), earlier, F.lit(""))

    def total(condition, what="n"):
        return F.sum(F.when(condition, F.col(what)).otherwise(F.lit(0))).cast("long")

    out = steps.groupBy("part", "filter_order", "step").agg(
        total(alive & ~fails).alias("kept"), total(alive & fails).alias("removed"), total(~alive & fails).alias("redundant"),
        total(F.col("fails") == own).alias("unique_fails"), total(alive & fails, "good").alias("good_lost"),
        total(alive & fails, "toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(W.partitionBy("part", own)))


def filter_audit(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", lang="lang") -> DataFrame:
    """:func:`audit` of the :func:`failures` of ``docs``."""
    return audit(failures(docs, doc_id, text, lang), labels, doc_id)
