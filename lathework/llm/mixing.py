"""Mixing sources to target weights along a training curriculum.

Each source gets a target in words. Its documents, in hashed order and repeated if need be,
fill the demand interval from 0 to the target. A source's weight changes over the training
time; the integral of its schedule says which share of the target is due by when, and the
inverse of that integral turns a document's place in the demand into its training position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import ROW, SPACE, WORD, free_shuffles, groups_of, numbered, packed_rows, text_of
from lathework.operators.ranks import ranked
from lathework.session import drop_tables, recorded, settle

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BUCKET_ROWS = 20_000
RANGE_WORDS = 2_000_000


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def place_hash(key: Column) -> Column:
    """A 52-bit number from the md5 of an id, the order of documents within a source."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """``source, source_size, rank, weight, target``; weights repeat over the sorted sources.

    All targets share ``share`` times the total by weight; none is above ``most`` times its
    source, and what that frees is shared again among the others until none is above.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the rank of a source: its code points in order, null last
    per = ranked(per.withColumn("_null", F.col("source").isNull()), "_null", "source").drop("_null")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    per = settle(per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size")), "sources")
    demand = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:  # the water level rises until no further source reaches its cap
        over = F.col("weight") * level >= F.col("cap")
        rest, given, count = per.agg(
            F.sum(F.when(~over, F.col("weight"))), F.sum(F.when(over, F.col("cap"))), F.count_if(over)
        ).first()
        if not rest or count == capped:
            break
        capped, level = count, max(level, (demand - (given or 0.0)) / rest)
    return per.withColumn("target", F.least(F.col("weight") * level, F.col("cap"))).drop("cap")


def default_knots(targets: DataFrame) -> DataFrame:
    """Schedules that fade odd-ranked sources in and even-ranked ones out, from 3:1 to 1:3.

    The ranks are those among the sources that have words, so that they can be told from the
    mixed documents too.
    """
    spoken = targets.filter("source_size > 0").select("source", F.col("source").isNull().alias("_null"))
    spoken = ranked(spoken, "_null", "source")
    sign = F.when(F.col("rank") % 2 == 0, 0.5).otherwise(-0.5)
    return spoken.select(
        "source", F.explode(F.array(
            F.struct(F.lit(0.0).alias("t"), (1 + sign).alias("w")), F.struct(F.lit(1.0).alias("t"), (1 - sign).alias("w"))
        )).alias("k")
    ).select("source", "k.t", "k.w")


def integrated(knots: DataFrame) -> DataFrame:
    """``source, segments``: the pieces of each normalised schedule with their integrals.

    ``knots``: ``source, t, w``, weights at times from 0 to 1, linear in between. A schedule
    without area is taken as flat.
    """
    by_time = W.partitionBy("source").orderBy("t", "w")
    ends = knots.select(
        "source", "t", "w", F.lead("t").over(by_time).alias("t1"), F.lead("w").over(by_time).alias("w1")
    ).filter(F.col("t1") > F.col("t"))
    area = (F.col("w") + F.col("w1")) / 2 * (F.col("t1") - F.col("t"))
    ends = ends.withColumn("area", area).withColumn("total", F.sum("area").over(W.partitionBy("source")))
    ends = ends.withColumn("upto", F.sum("area").over(by_time) / F.col("total"))
    piece = F.struct(
        "t", (F.col("w") / F.col("total")).alias("rate"),
        ((F.col("w1") - F.col("w")) / (F.col("t1") - F.col("t")) / F.col("total")).alias("slope"),
        (F.col("upto") - F.col("area") / F.col("total")).alias("f0"), F.col("upto").alias("f1"),
    )
    return ends.filter("total > 0").groupBy("source").agg(F.sort_array(F.collect_list(piece)).alias("segments"))


def inverse(segments: Column, due: Column) -> Column:
    """The time by which a share ``due`` of a source's demand has been served."""
    s = F.coalesce(F.get(F.filter(segments, lambda x: due < x["f1"]), F.lit(0)), F.element_at(segments, -1))
    left = F.greatest(due - s["f0"], F.lit(0.0))
    root = F.sqrt(F.greatest(s["rate"] * s["rate"] + 2 * s["slope"] * left, F.lit(0.0)))
    step = F.when(s["rate"] + root > 0, 2 * left / (s["rate"] + root)).otherwise(F.lit(0.0))
    return F.coalesce(F.least(s["t"] + step, F.lit(1.0)), due)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def running(sizes: DataFrame, bucket_rows=BUCKET_ROWS) -> DataFrame:
    """``sizes`` with ``begin``, the words before a row in its source, in the order of mixing.

    ``sizes``: ``_row, doc_id, source, size`` and, if there is one, ``copy``, which goes before
    the hash of the id.
    """
    n = groups_of(sizes.count(), bucket_rows)
    lap = F.col("copy") * n if "copy" in sizes.columns else F.lit(0)
    hashed = sizes.withColumn("h", place_hash(F.col("doc_id"))).withColumn(
        "bucket", lap + F.shiftright("h", 52 - n.bit_length() + 1)
    )
    totals = hashed.groupBy("source", "bucket").agg(F.sum("size").alias("_sum")).select(
        F.col("source").alias("_s"), F.col("bucket").alias("_b"),
        (F.sum("_sum").over(W.partitionBy("source").orderBy("bucket")) - F.col("_sum")).alias("_before"),
    )
    inside = W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size", ROW).rowsBetween(W.unboundedPreceding, 0)
    return hashed.withColumn("_upto", F.sum("size").over(inside)).join(
        totals, _same("source", "_s") & (F.col("bucket") == F.col("_b"))
    ).withColumn("begin", F.col("_before") + F.col("_upto") - F.col("size"))


def placements(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST, knots: DataFrame | None = None,
               bucket_rows=BUCKET_ROWS) -> tuple[DataFrame, DataFrame]:
    """Where each document goes: ``_row, copy, taken, position``, and the table of targets.

    ``sizes``: ``_row, doc_id, source, size`` of every row, a table that was written. A source
    may hold a third of all rows, so its running total is made of bucket totals and of
    running totals within buckets of about ``bucket_rows`` rows.
    """
    targets = settle(source_targets(sizes, weights, share, most), "targets")
    at = running(sizes, bucket_rows)
    segments = integrated(default_knots(targets) if knots is None else knots).withColumnRenamed("source", "_k")
    # written, so that the size of a few sources is known and no source meets in one task of a join
    plan = settle(targets.join(segments, _same("source", "_k"), "left").select(
        F.col("source").alias("_t"), "source_size", F.round("target").cast("long").alias("due"), "segments"
    ), "plan")
    copies = F.explode(F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1))).alias("copy")
    placed = at.join(plan, _same("source", "_t")).select(ROW, "size", "begin", "source_size", "due", "segments", copies)
    placed = placed.withColumn("begin", F.col("begin") + F.col("copy") * F.col("source_size"))
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("due") - F.col("begin"))).cast("long")
    placed = placed.withColumn("taken", taken).filter("taken > 0")
    middle = (F.col("begin") + F.col("taken") / 2) / F.col("due")
    return placed.select(ROW, "copy", "taken", inverse(F.col("segments"), middle).alias("position")), targets


def sizes_of(docs: DataFrame, doc_id, source, text) -> DataFrame:
    return numbered(docs.select(
        c(doc_id).alias("doc_id"), c(source).cast("string").alias("source"), count_words(text_of(text)).alias("size")
    ), "sizes")


def mix_summary(docs: DataFrame, doc_id="doc_id", source="source", text="text", **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken, positions`` for each row of ``docs``, in training order.

    ``positions`` has the training position of each copy that is due, from the first to the
    last. Rows are sorted by the first one over all partitions; those of which nothing is due
    have none and come last. A null text has size 0, a null source is a source of its own, sorted last. Repeated rows
    count one by one. A document at the end of its source's demand is taken in part. An empty
    table gives an empty table. Other columns are not read.
    """
    sizes = sizes_of(docs, doc_id, source, text)
    placed, targets = placements(sizes, **options)
    taken = placed.groupBy(ROW).agg(F.sum("taken").alias("taken"), F.sort_array(F.collect_list("position")).alias("positions"))
    named = targets.select(F.col("source").alias("_s"), "source_size", "target")
    out = sizes.join(taken, ROW, "left").join(named, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("positions", F.array().cast("array<double>")).alias("positions"), ROW,
    )
    order = F.get("positions", F.lit(0)).asc_nulls_last(), F.col(ROW)
    return out.repartitionByRange(*order).sortWithinPartitions(*order).drop(ROW)


def mix(docs: DataFrame, doc_id="doc_id", source="source", text="text", n_chars="n_chars", **options) -> DataFrame:
    """The mixed documents in training order, with the columns of ``docs``.

    A document that is due twice is there twice; one that is due in part has the words that
    are due, and its ``n_chars`` if there is such a column. Rows are sorted by position over
    all partitions. Rows without words (null, empty or blank texts) have nothing that could be due
    and are not mixed. An empty table gives an empty table.
    """
    rows = packed_rows(docs, doc_id=c(doc_id), source=c(source).cast("string"), size=count_words(text_of(text)))
    with recorded() as helpers:
        placed = settle(placements(rows.drop("whole"), **options)[0], "placed")
    drop_tables(docs.sparkSession, helpers[:-1])
    free_shuffles(docs.sparkSession)
    due = rows.select(ROW, "whole", "size").join(placed, ROW)
    words = F.split(F.regexp_replace(F.col("whole")[text], f"^{SPACE}+", ""), f"{SPACE}+")
    cut = F.when(F.col("taken") < F.col("size"), F.array_join(F.slice(words, 1, F.col("taken").cast("int")), " ")).otherwise(F.col("whole")[text])
    due = due.withColumn("_text", cut)
    columns = []
    for name in docs.columns:
        value = F.col("whole")[name]
        if name == text:
            value = F.col("_text")
        elif name == n_chars:
            value = F.when(F.col("taken") < F.col("size"), F.char_length("_text").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return due.repartitionByRange("position", ROW, "copy").sortWithinPartitions("position", ROW, "copy").select(*columns)


def in_order(mixed: DataFrame, doc_id="doc_id", source="source", text="text", knots: DataFrame | None = None,
             bucket_rows=BUCKET_ROWS, range_words=RANGE_WORDS) -> DataFrame:
    """``doc_id, text, position`` of documents that ``mix`` gave, in training order again.

    Tables that are written and read lose the order of their rows; here it is found anew from
    the rows alone. The words of a source fill its demand, so the same running total and the
    same schedules give the very positions of ``mix``. Rows of a source that share an id are
    copies, the longest first: ids are unique within a source before mixing. Each partition is
    a range of training time with about ``range_words`` words. Rows without words are not of
    ``mix`` and come last. An empty table gives an empty table.
    """
    rows = numbered(mixed.select(
        c(doc_id).alias("doc_id"), c(source).cast("string").alias("source"), c(text).alias("text"), count_words(text_of(text)).alias("size")
    ), "mixed")
    by_id = W.partitionBy("source", "doc_id").orderBy(F.col("size").desc(), ROW)
    sizes = rows.select(ROW, "doc_id", "source", "size").filter("size > 0").withColumn("copy", F.row_number().over(by_id) - 1)
    due = settle(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "due")
    total = due.agg(F.sum("source_size")).first()[0] or 0
    segments = integrated(default_knots(due) if knots is None else knots).withColumnRenamed("source", "_k")
    plan = settle(due.join(segments, _same("source", "_k"), "left").select(F.col("source").alias("_t"), "source_size", "segments"), "plan")
    middle = (F.col("begin") + F.col("size") / 2) / F.col("source_size")
    at = running(sizes, bucket_rows).join(plan, _same("source", "_t")).select(
        ROW, "copy", inverse(F.col("segments"), middle).alias("position")
    )
    order = F.col("position").asc_nulls_last(), F.col("doc_id"), F.col("copy")
    out = rows.select(ROW, "doc_id", "text").join(at, ROW, "left")
    return out.repartitionByRange(groups_of(total, range_words), *order).sortWithinPartitions(*order).select("doc_id", "text", "position")
