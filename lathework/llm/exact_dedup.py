"""Exact deduplication behind a two-pass Bloom filter.

Pass one counts the hashes of all rows in the slots of a filter, each up to two. Pass two asks
the filter of slots that were hit twice: a row with such a slot at each of its probes may be
repeated and goes on to the exact comparison, by a shuffle of its digest. Every other row is
alone for certain and passes straight through. No text is ever shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from lathework.functions.columns import c
from lathework.llm.common import ROW, SPACE, numbered, packed_rows, text_of
from lathework.session import settle

BLOCK = 1 << 16  # slots of one filter block
BITS_PER_ROW = 16
MAX_BITS = 1 << 30  # 128 MB: the proven bound of what is broadcast


def filter_bits(rows: int, bits_per_row=BITS_PER_ROW, max_bits=MAX_BITS) -> int:
    """Slots for so many rows: a power of two, never above the bound.

    Above ``max_bits / bits_per_row`` rows the filter only gets denser: more unrepeated rows
    take the exact path, and the result stays the same.
    """
    return min(max_bits, max(BLOCK, 1 << max(0, rows * bits_per_row - 1).bit_length()))


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two slots of each 64-bit hash."""
    h = hashes.view(np.uint64)
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(33)) & mask]).astype(np.int64)


def repeated_slots(hashes: DataFrame, bits: int) -> np.ndarray:
    """Pass one: the packed bits of all slots that two or more hashes hit.

    ``hashes`` has one long column ``h``. A task first adds up its own hits, so a hash that a
    third of the rows share leaves a task as one number; blocks then meet by a shuffle of
    two bytes a slot. The driver receives one bit for each slot of the bounded filter.
    """

    def local(batches):
        seen = [b.column("h").to_numpy() for b in batches]
        if not seen:
            return
        found, hits = np.unique(slots(np.concatenate(seen), bits), return_counts=True)
        block = found // BLOCK
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        offsets, twice = (found % BLOCK).astype(np.uint16), hits > 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(block[edges[:-1]]),
                pa.array([offsets[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
                pa.array([offsets[a:b][twice[a:b]].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
            ],
            names=["block", "hit", "twice"],
        )

    def meet(batches):
        """Bits of a run of rows with one block after another."""
        at, count = None, None

        def bits_of():
            packed = np.packbits(count > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([packed], pa.binary())], names=["block", "bits"])

        for batch in batches:
            for block, hit, twice in zip(*(batch.column(k).to_pylist() for k in ("block", "hit", "twice"))):
                if block != at:
                    if at is not None:
                        yield bits_of()
                    at, count = block, np.zeros(BLOCK, dtype=np.uint8)
                # a slot is in a task's list once, so plain indexed writes see every slot
                hit = np.frombuffer(hit, np.uint16)
                count[hit] = np.minimum(count[hit] + 1, 2)
                count[np.frombuffer(twice, np.uint16)] = 2
        if at is not None:
            yield bits_of()

    blocks = (
        hashes.mapInArrow(local, "block long, hit binary, twice binary")
        .repartition(c("block")).sortWithinPartitions("block").mapInArrow(meet, "block long, bits binary").toArrow()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for block, packed in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        out[block * BLOCK // 8:(block + 1) * BLOCK // 8] = np.frombuffer(packed, np.uint8)
    return out


def flag_repeated(df: DataFrame, bits: int, found: np.ndarray) -> DataFrame:
    """Pass two: ``df`` with ``maybe``, false where the hash in ``h`` is alone for certain."""
    shared = df.sparkSession.sparkContext.broadcast(found)

    def ask(batches):
        table = shared.value
        for b in batches:
            at = slots(b.column("h").to_numpy(), bits)
            hit = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            yield b.append_column("maybe", pa.array(hit.min(axis=0).astype(bool)))

    return df.mapInArrow(ask, StructType([*df.schema.fields, StructField("maybe", BooleanType())]))


def resolve(digests: DataFrame, bits_per_row=BITS_PER_ROW, max_bits=MAX_BITS) -> DataFrame:
    """Which row of each group of equal texts stays.

    ``digests``: ``_row, doc_id, n_chars, digest`` of every row, a table that was written. Adds
    ``keep_id, keep_row, group_size``.
    """
    bits = filter_bits(digests.count(), bits_per_row, max_bits)
    hashed = digests.withColumn("h", F.xxhash64("digest"))
    flagged = settle(flag_repeated(hashed, bits, repeated_slots(hashed.select("h"), bits)).drop("h"), "flagged")
    alone = flagged.filter(~F.col("maybe")).withColumns(
        {"keep_id": F.col("doc_id"), "keep_row": F.col(ROW), "group_size": F.lit(1).cast("long")}
    )
    maybe = flagged.filter("maybe")
    first = F.min(F.struct((-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("nameless"), "doc_id", ROW))
    groups = maybe.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size")).select(
        "digest", F.col("first.doc_id").alias("keep_id"), F.col(f"first.{ROW}").alias("keep_row"), "group_size"
    )
    # One group may hold a third of all rows: a sort-merge join, whose large keys Spark splits.
    return alone.unionByName(maybe.join(groups.hint("merge"), "digest")).drop("maybe")


def digest_columns(text="text") -> dict:
    whole = text_of(text)
    return {
        "n_chars": F.char_length(whole).cast("long"),
        "digest": F.unhex(F.sha2(F.regexp_replace(whole, f"{SPACE}+", ""), 256)),
    }


def exact_duplicates(docs: DataFrame, doc_id="doc_id", text="text", **filter_options) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space; a null text is an empty one.
    Of equal texts the longest original stays, then the smallest id (null last), then one of
    the repeated rows: exactly one row of a group has ``kept``. An empty table gives an
    empty table. Other columns are not read.
    """
    digests = numbered(docs.select(c(doc_id).alias("doc_id"), *[v.alias(k) for k, v in digest_columns(text).items()]), "digests")
    return resolve(digests, **filter_options).select(
        "doc_id", "keep_id", "group_size", (F.col(ROW) == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, doc_id="doc_id", text="text", **filter_options) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with their columns."""
    rows = packed_rows(docs, doc_id=c(doc_id), **digest_columns(text))
    kept = resolve(rows.drop("whole"), **filter_options).filter(F.col(ROW) != F.col("keep_row")).select(ROW)
    return rows.join(kept, ROW, "left_anti").select("whole.*")
