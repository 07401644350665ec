"""Grouped prefix join: documents whose sets of word shingles have a Jaccard of 0.8 or more.

Shingles are ordered by how common they are (a bounded table of counts) and then by hash, the
same order everywhere. Two sets that reach the threshold share a shingle among the first few
of each, the prefix. Equal sets count as one set; sets with the same prefix and size form one
group, and groups meet on the shingles of their prefixes. Pairs are verified on whole texts.

The result is classes, so not all pairs of a class are looked at: each set first meets the most
typical set of its lists (a star, linear in the lists), and only sets that are in different
classes afterwards meet each other, all that pass the size and the overlap filter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from lathework.functions.columns import c
from lathework.llm.common import ROW, free_shuffles, narrow, packed_rows, text_of, text_of_whole
from lathework.llm.components import components
from lathework.llm.textbytes import OTHER, chunks, distinct_by_row, mixed, shingles
from lathework.session import drop_tables, recorded, settle

WORDS = 5
PERCENT = 80
SLOT_BITS = 22  # the table of counts has 4 million slots, as bytes 4 MB: a fixed size
BLOCK = 1 << 16


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _merged_counts(batches):
    """Sum of the counts of each block, as the bit length of the count."""
    at, total = None, None

    def out():
        size = np.zeros(BLOCK, np.uint8)
        size[total > 0] = np.floor(np.log2(total[total > 0])).astype(np.uint8) + 1
        return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([size.tobytes()], pa.binary())], names=["block", "size"])

    for batch in batches:
        for block, offsets, counts in zip(*(batch.column(k).to_pylist() for k in ("block", "offsets", "counts"))):
            if block != at:
                if at is not None:
                    yield out()
                at, total = block, np.zeros(BLOCK, np.int64)
            counts = np.frombuffer(counts, np.uint32)
            if offsets:
                total[np.frombuffer(offsets, np.uint16)] += counts
            else:
                total += counts
    if at is not None:
        yield out()


def commonness(texts: DataFrame, words=WORDS) -> np.ndarray:
    """For each slot the bit length of the number of sets with a shingle in it.

    Every shingle of every text counts. The order it gives is only a matter of speed: any
    order that is the same everywhere gives the same links.
    """

    def count(batches):
        total = np.zeros(1 << SLOT_BITS, np.uint32)
        for batch in batches:
            for _, offsets, data in chunks(batch.column("text")):
                sets = distinct_by_row(*shingles(offsets, data, words))
                total += np.bincount(_slots(np.concatenate(sets)), minlength=1 << SLOT_BITS).astype(np.uint32)
        for block in range((1 << SLOT_BITS) // BLOCK):
            part = total[block * BLOCK:(block + 1) * BLOCK]
            used = np.flatnonzero(part)
            if len(used):
                dense = len(used) > BLOCK // 3
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]), pa.array([b"" if dense else used.astype(np.uint16).tobytes()], pa.binary()),
                        pa.array([(part if dense else part[used]).tobytes()], pa.binary()),
                    ],
                    names=["block", "offsets", "counts"],
                )

    blocks = (
        texts.select("text").mapInArrow(count, "block long, offsets binary, counts binary")
        .repartition(c("block")).sortWithinPartitions("block").mapInArrow(_merged_counts, "block long, size binary").toArrow()
    )
    out = np.zeros(1 << SLOT_BITS, np.uint8)
    for block, size in zip(blocks.column("block").to_pylist(), blocks.column("size").to_pylist()):
        out[block * BLOCK:(block + 1) * BLOCK] = np.frombuffer(size, np.uint8)
    return out


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set."""
    return int(found.sum(dtype=np.uint64).view(np.int64)), int(mixed(found * np.uint64(OTHER)).sum(dtype=np.uint64).view(np.int64))


def prefix_size(n: int, percent=PERCENT) -> int:
    """How many of a set's first shingles must hold one that is shared."""
    return n - -(-percent * n // 100) + 1 if n else 0


def set_table(texts: DataFrame, common: np.ndarray, words=WORDS, percent=PERCENT) -> DataFrame:
    """``doc_id, _row, n, f1, f2, tail, prefix``: size, fingerprint and prefix of each set.

    ``texts``: ``doc_id, text`` and perhaps ``_row``; ``tail`` names the prefix by a hash.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common)
    kept = [x for x in texts.columns if x != "text"]

    def run(batches):
        sizes = shared.value
        for batch in batches:
            for row, offsets, data in chunks(batch.column("text")):
                n, f1, f2, tail, prefix = [], [], [], [], []
                for x in distinct_by_row(*shingles(offsets, data, words)):
                    k = np.sort((sizes[_slots(x)].astype(np.uint64) << np.uint64(56)) | (x >> np.uint64(8)))
                    k = k[:prefix_size(len(x), percent)]
                    a, b = fingerprint(x)
                    n.append(len(x))
                    f1.append(a)
                    f2.append(b)
                    tail.append(int((mixed(k) * np.arange(1, 2 * len(k), 2, dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64)))
                    prefix.append(k.view(np.int64))
                lengths = np.concatenate([[0], np.cumsum([len(k) for k in prefix])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(row, len(n)) for k in kept] + [pa.array(x, pa.int64()) for x in (n, f1, f2, tail)] + [lists],
                    names=[*kept, "n", "f1", "f2", "tail", "prefix"],
                )

    schema = StructType([texts.schema[k] for k in kept] + [StructField(k, LongType()) for k in ("n", "f1", "f2", "tail")])
    return texts.select(*kept, "text").mapInArrow(run, schema.add("prefix", ArrayType(LongType())))


def texts_of(texts: DataFrame, wanted: DataFrame, words=WORDS) -> DataFrame:
    """``id, text`` of the wanted sets (``id, doc_id, n, f1, f2``): rows that have that very set."""
    found = texts.select("doc_id", "text").join(wanted.withColumnRenamed("doc_id", "_d"), c("doc_id").eqNullSafe(c("_d"))).select(
        "id", "n", "f1", "f2", "text"
    )

    def run(batches):
        for batch in batches:
            want = list(zip(*(batch.column(k).to_pylist() for k in ("n", "f1", "f2"))))
            own = []
            for _, offsets, data in chunks(batch.column("text")):
                own += [(len(x), *fingerprint(x)) for x in distinct_by_row(*shingles(offsets, data, words))]
            keep = pa.array([a == b for a, b in zip(want, own)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text")], names=["id", "text"]).filter(keep)

    return found.mapInArrow(run, "id long, text string")


def verified(pairs: DataFrame, texts: DataFrame, words=WORDS, percent=PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose whole texts reach the threshold."""

    def run(batches):
        for batch in batches:
            sides = []
            for name in ("left", "right"):
                sets = []
                for _, offsets, data in chunks(batch.column(name)):
                    sets += distinct_by_row(*shingles(offsets, data, words))
                sides.append(sets)
            keep = []
            for x, y in zip(*sides):
                shared = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(texts.select(c("id").alias("a"), c("text").alias("left")).hint("merge"), "a").join(
        texts.select(c("id").alias("b"), c("text").alias("right")).hint("merge"), "b"
    )
    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _close(a: str, b: str, percent: int):
    """Sizes from which the threshold can be reached."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _needed(n: str, last: str, n2: str, last2: str, percent: int):
    """How many prefix shingles a linked pair shares at least.

    The overlap is at least ``percent / (100 + percent)`` of both sizes together. All shared
    shingles up to the smaller of the two prefix ends are in both prefixes; of those beyond,
    the set whose prefix ends there has no more than what is not in its prefix.
    """
    overlap = F.ceil(F.lit(percent) * (F.col(n) + F.col(n2)) / F.lit(100.0 + percent))
    beyond = F.ceil(F.lit(percent) * F.when(F.col(last) <= F.col(last2), F.col(n)).otherwise(F.col(n2)) / F.lit(100.0)) - 1
    return overlap - beyond


def _lists(table: DataFrame, sets: DataFrame) -> DataFrame:
    """``shingle, id, n, last, rank, weight``: prefix shingles that two or more sets have.

    Sets with the same prefix and size are one group, whose prefix is read once. ``rank`` counts
    a set's listed shingles from the most frequent one, ``weight`` sums up their frequencies.
    """
    groups = settle(sets.groupBy("n", "tail").agg(F.min("id").alias("group"), F.count("*").alias("members")), "groups")
    entries = table.select(F.col("_at").alias("group"), "prefix").join(groups.select("group", "members"), "group").select(
        "group", "members", F.explode("prefix").alias("shingle")
    )
    many = entries.groupBy("shingle").agg(F.sum("members").alias("m")).filter("m > 1")
    listed = entries.join(many.hint("merge"), "shingle").select("shingle", "group", "m")
    members = sets.join(groups.select("n", "tail", "group"), ["n", "tail"]).select("group", "id", "n", "last")
    own = W.partitionBy("id")
    return settle(listed.join(members, "group").select(
        "shingle", "id", "n", "last", F.row_number().over(own.orderBy(F.desc("m"), "shingle")).alias("rank"),
        F.sum("m").over(own).alias("weight"),
    ), "lists")


def classes(texts: DataFrame, words=WORDS, percent=PERCENT) -> DataFrame:
    """``doc_id, [_row,] n, id, class``: the class of each row, named by the row's set.

    ``id`` numbers the distinct sets, ``class`` is the smallest id that links reach; both are
    null for an empty set.
    """
    spark = texts.sparkSession
    common = commonness(texts, words)
    free_shuffles(spark)
    with recorded() as prefixes:
        table = settle(set_table(texts, common, words, percent).withColumn("_at", F.monotonically_increasing_id()), "sets")
    key = ["n", "f1", "f2"]
    whole = table.withColumn("last", F.element_at("prefix", -1)).filter("n > 0")
    sets = settle(whole.groupBy(*key).agg(F.min(F.struct("_at", "doc_id", "tail", "last")).alias("first")).select(
        F.col("first._at").alias("id"), F.col("first.doc_id").alias("doc_id"), *key, "first.tail", "first.last"
    ), "distinct")
    lists = _lists(table, sets)
    # nothing reads the prefixes from here on, and they are the largest table but the texts
    rows = settle(table.select(*[x for x in table.columns if x not in ("tail", "prefix", "_at")]), "members")
    drop_tables(spark, prefixes)
    free_shuffles(spark)
    wanted = sets.join(lists.filter("rank = 1").select("id"), "id").select("id", "doc_id", *key)
    held = settle(texts_of(texts, wanted, words), "texts")
    free_shuffles(spark)
    # a star: each set meets the most typical set of its lists, by all of which it can be reached
    hubs = lists.groupBy("shingle").agg(F.max(F.struct("weight", (-F.col("id")).alias("id"), "n", "last")).alias("hub"))
    met = lists.join(hubs.hint("merge"), "shingle").select("id", "n", (-F.col("hub.id")).alias("hub"), F.col("hub.n").alias("hub_n"))
    met = met.filter((F.col("id") != F.col("hub")) & _close("n", "hub_n", percent)).groupBy("id", "hub").agg(F.count("*").alias("shared"))
    best = met.groupBy("id").agg(F.max(F.struct("shared", "hub")).alias("best")).select(F.col("id").alias("a"), F.col("best.hub").alias("b"))
    star = settle(verified(best, held, words, percent), "links")
    free_shuffles(spark)
    named = settle(components(star), "classes")
    # what is left: pairs in different classes that can share enough of their prefixes. A pair
    # that shares k shingles shares one whose rank is k or more on both sides.
    at = lists.join(named.withColumnRenamed("node", "id"), "id", "left").withColumn("cls", F.coalesce("component", "id"))
    at = settle(at.select("shingle", "id", "n", "last", "rank", "cls"), "open")
    mixed_lists = at.groupBy("shingle").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("shingle")
    at = at.join(mixed_lists.hint("merge"), "shingle")
    other = at.select("shingle", *[c(x).alias(f"{x}2") for x in ("id", "n", "last", "rank", "cls")])
    pairs = at.join(other.hint("merge"), "shingle").filter(
        (F.col("id") < F.col("id2")) & (F.col("cls") != F.col("cls2")) & _close("n", "n2", percent)
        & (F.least("rank", "rank2") >= _needed("n", "last", "n2", "last2", percent))
    )
    pairs = pairs.select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct()
    last = settle(verified(pairs, held, words, percent), "links")
    if last.head(1):
        named = settle(components(star.unionByName(last)), "classes")
    by_set = sets.select("id", *key).join(named.withColumnRenamed("node", "id"), "id", "left").select(
        *key, "id", F.coalesce("component", "id").alias("class")
    )
    return rows.filter("n > 0").join(by_set.hint("merge"), key).unionByName(
        rows.filter("n = 0").withColumns({"id": F.lit(None).cast("long"), "class": F.lit(None).cast("long")})
    )


def near_duplicates(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, percent=PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, its own included. A null or empty
    text has no shingles and links with nothing; a text with fewer words than a shingle has
    its whole sequence as one. Repeated rows and equal texts are in one component. An empty
    table gives an empty table. Other columns are not read.
    """
    found = settle(classes(narrow(docs, doc_id=c(doc_id), text=text_of(text)), words, percent), "classes")
    least = found.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    linked = found.filter("class IS NOT NULL").join(least.hint("merge"), "class")
    alone = found.filter("class IS NULL").withColumn("component_id", F.col("doc_id"))
    return linked.select("doc_id", c("n").alias("n_shingles"), "component_id").unionByName(
        alone.select("doc_id", c("n").alias("n_shingles"), "component_id")
    )


def keep_one(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, percent=PERCENT) -> DataFrame:
    """The rows of ``docs`` with one row of each class: the smallest doc_id, then the first row.

    Rows without words are no copies of anything and stay. Texts are written once; the tables of
    the join are removed before the rows are read again.
    """
    rows = packed_rows(docs, doc_id=c(doc_id))
    with recorded() as helpers:
        found = settle(classes(rows.select("doc_id", text_of_whole(text).alias("text"), ROW), words, percent), "classes").filter("class IS NOT NULL")
        first = found.groupBy("class").agg(F.min(F.struct(c("doc_id").isNull().alias("nameless"), "doc_id", ROW)).alias("first"))
        # written, so that the planner knows how short the list is
        gone = settle(found.join(first.hint("merge"), "class").filter(c(ROW) != F.col(f"first.{ROW}")).select(ROW), "gone")
    drop_tables(docs.sparkSession, helpers[:-1])
    free_shuffles(docs.sparkSession)
    return rows.join(gone, ROW, "left_anti").select("whole.*")
