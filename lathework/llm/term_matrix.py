"""Sparse document-term matrix over a dictionary of all words, in compressed row shards.

A task encodes its documents by the words it has met and writes shards of a few megabytes, each
with its own small vocabulary. Only vocabularies are shuffled: their words become one numbered
dictionary, and each shard gets the numbers of its words back and turns its columns into them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from lathework.llm.textbytes import _SPACE, chunks, prefix_sums, stretch_hash, word_array, word_bounds
from lathework.session import settle

SHARD_BYTES = 1 << 22
PIECE_BYTES = 1 << 19
SLICE_ROWS = 1 << 9  # rows of a batch that are copied at a time
HELD_WORDS = 1 << 20  # words of a bucket that a task looks up at a time


def pieces(column, most=PIECE_BYTES):
    """``(first row, offsets, bytes)`` like :func:`chunks`, with long texts cut between words."""
    found = ((begin, x) for begin in range(0, len(column), SLICE_ROWS) for x in chunks(column.slice(begin, SLICE_ROWS), most))
    for begin, (row, offsets, data) in found:
        row, at = begin + row, 0
        while len(data) - at > 2 * most:
            gaps = np.flatnonzero(_SPACE[data[at + most:at + 2 * most]])
            end = at + most + int(gaps[0]) if len(gaps) else None
            if end is None:  # a word of megabytes
                gaps = np.flatnonzero(_SPACE[data[at + 2 * most:]])
                if not len(gaps):
                    break
                end = at + 2 * most + int(gaps[0])
            yield row, np.array([0, end - at]), data[at:end]
            at = end
        yield row, (offsets if at == 0 else np.array([0, len(data) - at])), data[at:]


def encoded(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and word number of every word of a piece, and the distinct words."""
    starts, ends, first = word_bounds(offsets, data)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    if not len(starts):
        return rows, rows, np.zeros(0, object)
    found = word_array(data[~_SPACE[data]], ends - starts).dictionary_encode()
    return rows, found.indices.to_numpy(), found.dictionary.to_numpy(zero_copy_only=False)


def slim(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes as the largest needs, all first bytes first, then all second ones.

    The number of bytes goes before them. High bytes are mostly 0, which compression makes use of.
    """
    size = np.min_scalar_type(int(x.max()) if len(x) else 0).itemsize
    return bytes([size]) + x.astype(f"<u{size}").view(np.uint8).reshape(len(x), size).T.tobytes()


def wide(raw: bytes) -> np.ndarray:
    size = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{size}").ravel().astype(np.int64)


def steps(columns: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ascending columns of each row as the first one and the differences to the one before."""
    out = np.diff(columns, prepend=0).astype(np.int64)
    first = ends[:-1][ends[:-1] < ends[1:]]
    out[first] = columns[first]
    return out


def unstepped(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.cumsum(found)
    begin = np.concatenate([[0], total])[ends[:-1]]
    return total - np.repeat(begin, np.diff(ends))


def terms_of(ends: bytes, terms: bytes) -> np.ndarray:
    """The terms of all cells of a shard."""
    return unstepped(wide(terms), wide(ends))


def cell_order(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Order of cells by row, then column; cells are not that many that the two do not fit one number."""
    return np.argsort(rows.astype(np.int64) * (int(columns.max()) + 1 if len(columns) else 1) + columns)


def summed_cells(rows, columns, counts):
    """Distinct cells in row and column order, with their counts added up."""
    order = cell_order(rows, columns)
    rows, columns, counts = rows[order], columns[order], counts[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (columns[1:] != columns[:-1])
    at = np.flatnonzero(new)
    return rows[at], columns[at], np.add.reduceat(counts, at) if len(at) else counts


class Shard:
    """Documents, cells and words that a task has gathered."""

    def __init__(self):
        self.docs, self.cells, self.words, self.size, self.rows = [], [], [], 0, 0

    def add(self, row: int, offsets, data) -> None:
        """``row``: number of the piece's first document in the shard."""
        rows, codes, words = encoded(offsets, data)
        if len(words):
            cell, counts = np.unique(rows * len(words) + codes, return_counts=True)
            self.cells.append([x.astype(np.int32) for x in (row + cell // len(words), cell % len(words), counts)])
            self.words.append(pa.array(words, pa.large_binary()))
        self.size += len(data)

    def dealt(self, buckets: int):
        """The distinct words by bucket, ``(bucket, place of its first word, sizes, bytes)``, and the places of the pieces' words."""
        if not self.words:
            return [], []
        found = pa.concat_arrays(self.words).dictionary_encode()
        words = found.dictionary
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        bucket = stretch_hash(prefix_sums(np.frombuffer(words.buffers()[2], np.uint8)), bounds[:-1], bounds[1:]) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        words = words.take(pa.array(order))
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        raw, bucket = words.buffers()[2], bucket[order]
        begin = np.flatnonzero(np.diff(bucket.astype(np.int64), prepend=-1))
        parts = [
            (int(bucket[a]), a, slim(np.diff(bounds[a:b + 1])), raw[int(bounds[a]):int(bounds[b])].to_pybytes())
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)])
        ]
        own = place[found.indices.to_numpy()]
        return parts, np.split(own, np.cumsum([len(x) for x in self.words])[:-1])

    def row(self, number: int, schema: pa.Schema, buckets: int) -> pa.RecordBatch:
        parts, places = self.dealt(buckets)
        cells = [(rows, own[columns], counts) for (rows, columns, counts), own in zip(self.cells, places)]
        none = (np.zeros(0, np.int32),) * 3
        rows, columns, counts = summed_cells(*(np.concatenate(x) for x in zip(*cells))) if cells else none
        ends = np.searchsorted(rows, np.arange(self.rows + 1))
        docs = pa.concat_arrays(self.docs)
        entry = schema.field("words").type.value_type
        words = pa.array([dict(zip(("bucket", "at", "sizes", "raw"), x)) for x in parts], entry)
        cells = [
            pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
            *[pa.array([slim(x)], pa.binary()) for x in (ends, steps(columns, ends), counts)],
            pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
        ]
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(cells, schema)], schema=schema)


def local_shards(docs: DataFrame, buckets: int, text="text", shard_bytes=SHARD_BYTES) -> DataFrame:
    """``shard, docs, ends, columns, counts, words``: shards with columns of their own, not shuffled.

    ``docs`` has a text column (null counts as empty); its other columns go into the array ``docs``.
    Words are dealt to ``buckets`` by hash; ``words`` has an entry for each bucket, with the column of its first word.
    """
    kept = [f for f in docs.schema if f.name != text]
    schema = StructType([
        StructField("shard", LongType()), StructField("docs", ArrayType(StructType(kept))),
        *[StructField(k, BinaryType()) for k in ("ends", "columns", "counts")], StructField("words", ArrayType(StructType([
            StructField("bucket", IntegerType()), StructField("at", LongType()), StructField("sizes", BinaryType()), StructField("raw", BinaryType()),
        ]))),
    ])
    arrow = to_arrow_schema(schema)
    entry = arrow.field("docs").type.value_type

    def run(batches):
        number, shard = TaskContext.get().partitionId() << 32, Shard()
        for batch in batches:
            meta = pa.StructArray.from_arrays([batch.column(f.name).cast(f.type) for f in entry], fields=list(entry))
            base, done, last = shard.rows, 0, -1  # row r of the batch is row base + r of the shard
            for row, offsets, data in pieces(batch.column(text)):
                if shard.size >= shard_bytes and row > last >= 0:
                    shard.docs.append(meta.slice(done, row - done))
                    shard.rows = base + row
                    yield shard.row(number, arrow, buckets)
                    number, shard, base, done = number + 1, Shard(), -row, row
                shard.add(base + row, offsets, data)
                last = row + len(offsets) - 2
            shard.docs.append(meta.slice(done))
            shard.rows = base + batch.num_rows
        if shard.rows:
            yield shard.row(number, arrow, buckets)

    return docs.select(*[f.name for f in kept], text).mapInArrow(run, schema)


def numbered_words(shards: DataFrame, buckets: int, listed=False) -> DataFrame:
    """``owner, at, terms``: the numbers of the words of a shard, the same in all shards, in a few rows.

    A bucket's words meet in one task, by shard; the r-th new word of bucket b of B is number
    r * B + b, so the numbers have few gaps, and a word is shuffled once for each shard that
    has it. ``at`` is the column of the first word. With ``listed``, the dictionary ``word, term`` instead.
    """
    words = shards.select(F.col("shard").alias("owner"), F.explode("words").alias("x")).select("owner", "x.*")

    def numbered(batches):
        """Rows of one bucket with the numbers of their words and the words that are new."""
        bucket, known = None, {}
        for batch in batches:
            found = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(found)) + 1).tolist(), len(found)] if len(found) else [0]
            for first, last in zip(edges[:-1], edges[1:]):
                if found[first] != bucket:
                    bucket, known = int(found[first]), {}
                at = first
                while at < last:  # rows that have HELD_WORDS words together, or one row
                    sizes, raw, n, begin = [], [], 0, at
                    while at < last and (at == begin or n < HELD_WORDS):
                        sizes.append(wide(batch.column("sizes")[at].as_py()))
                        raw.append(np.frombuffer(batch.column("raw")[at].as_buffer(), np.uint8))
                        n, at = n + len(sizes[-1]), at + 1
                    coded = word_array(np.concatenate(raw), np.concatenate(sizes)).dictionary_encode()
                    before, own = len(known), coded.dictionary.to_numpy(zero_copy_only=False)
                    ranks = np.array([known.setdefault(w, len(known)) for w in own], np.int64)
                    terms = ranks[coded.indices.to_numpy()] * buckets + bucket
                    fresh = ranks >= before
                    yield batch.slice(begin, at - begin), [len(x) for x in sizes], terms, coded.dictionary.filter(pa.array(fresh)), ranks[fresh] * buckets + bucket

    def dictionary(batches):
        for _, _, _, new, terms in numbered(batches):
            yield pa.RecordBatch.from_arrays([new.cast(pa.binary()), pa.array(terms)], names=["word", "term"])

    def places(batches):
        for rows, sizes, terms, _, _ in numbered(batches):
            cells = [slim(x) for x in np.split(terms, np.cumsum(sizes)[:-1])]
            yield pa.RecordBatch.from_arrays([rows.column("owner"), rows.column("at"), pa.array(cells, pa.binary())], names=["owner", "at", "terms"])

    dealt = words.repartition(buckets, "bucket").sortWithinPartitions("bucket", "owner").select("owner", "bucket", "at", "sizes", "raw")
    return dealt.mapInArrow(dictionary, "word binary, term long") if listed else dealt.mapInArrow(places, "owner long, at long, terms binary")


def term_matrix(docs: DataFrame, text="text", shard_bytes=SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The matrix ``shard, docs, ends, terms, counts`` and its dictionary ``word, term``.

    One row is a shard: the documents' other columns, where each document's cells end, and the
    terms and counts of the cells, sorted by term within a document (read them with ``wide`` and
    ``terms_of``).
    A null, empty or blank text is a document without cells; long texts, repeated rows and
    words of any length count in full. An empty table gives an empty matrix.
    """
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = settle(local_shards(docs, buckets, text, shard_bytes), "shards")
    places = numbered_words(local, buckets)
    schema = StructType([*local.schema.fields[:3], StructField("terms", BinaryType()), StructField("counts", BinaryType())])
    arrow = to_arrow_schema(schema)

    def renumber(shard: pa.Table, places: pa.Table) -> pa.Table:
        found = [(a, wide(t)) for a, t in zip(places.column("at").to_pylist(), places.column("terms").to_pylist())]
        number = np.zeros(sum(len(t) for _, t in found), np.int64)
        for at, terms in found:
            number[at:at + len(terms)] = terms
        out = []
        for row in shard.to_batches():
            for i in range(row.num_rows):
                ends, columns, counts = (wide(row.column(k)[i].as_py()) for k in ("ends", "columns", "counts"))
                terms = number[unstepped(columns, ends)]
                order = cell_order(np.repeat(np.arange(len(ends) - 1), np.diff(ends)), terms)
                cells = [pa.array([slim(x)], pa.binary()) for x in (steps(terms[order], ends), counts[order])]
                parts = [row.column(k).slice(i, 1) for k in ("shard", "docs", "ends")] + cells
                out.append(pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(parts, arrow)], schema=arrow))
        return pa.Table.from_batches(out, schema=arrow)

    whole = local.drop("words")
    return whole.groupBy("shard").cogroup(places.groupBy("owner")).applyInArrow(renumber, schema), numbered_words(local, buckets, listed=True)


def row_totals(matrix: DataFrame) -> DataFrame:
    """The documents of a matrix with ``words``, the sum of a row, and ``distinct``, its nonzero cells."""
    kept = matrix.schema["docs"].dataType.elementType
    schema = StructType([*kept.fields, StructField("words", LongType()), StructField("distinct", LongType())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ends, counts = (wide(batch.column(k)[i].as_py()) for k in ("ends", "counts"))
                upto = np.concatenate([[0], np.cumsum(counts)])
                docs = batch.column("docs").slice(i, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [*docs.flatten(), pa.array(np.diff(upto[ends])), pa.array(np.diff(ends))], names=schema.names
                )

    return matrix.select("docs", "ends", "counts").mapInArrow(run, schema)
