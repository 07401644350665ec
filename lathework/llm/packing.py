"""Packing documents into windows of tokens by the sum-of-squares rule.

Each task packs its own partition in one pass. A level array counts the partly filled windows
at each fill level; a remainder goes to the level where the sum of the squared counts ends
up smallest. Windows still open at the end of the task are filled from the emptiest ones by
cutting, and the one that is left is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import narrow, text_of
from lathework.llm.tokens import chunk_ids

CAPACITY = 2048
END_ID = 1
STRETCH = 4 << 20  # bytes of text whose words are looked up together
PIECES = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class LevelPacker:
    """Online packer; ``place`` gives the windows that are full, ``close`` all others.

    A piece is ``(doc, start, ids, doc_tokens)`` and a window is a list of pieces. Open windows
    are as many as the level array counts; the rule keeps that small, whatever the number of
    documents.
    """

    def __init__(self, capacity=CAPACITY):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new window, that minimises the sum of squared counts."""
        n = self.counts
        left, after = n[1:self.capacity - size + 1], n[size + 1:]
        # n[h] loses one window and n[h + size] gains one; a full window leaves the array
        change = 2 * (after - left) + 2
        best, level = 2 * n[size] + 1, 0
        if len(change):
            change[-1] = 1 - 2 * left[-1]
            change[left == 0] = np.iinfo(np.int64).max
            at = len(change) - 1 - int(np.argmin(change[::-1]))  # of equals the fullest
            if change[at] <= best:
                level = at + 1
        return level

    def place(self, doc, ids: np.ndarray) -> list:
        """Put all ids of a document; full stretches of it are windows of their own."""
        full, total = [], len(ids)
        whole = total - total % self.capacity
        for a in range(0, whole, self.capacity):
            full.append([(doc, a, ids[a:a + self.capacity], total)])
        if whole == total:
            return full
        # a copy, as an open window must not hold the array of all texts of its stretch
        piece, size = (doc, whole, ids[whole:].copy(), total), total - whole
        level = self.level_for(size)
        window = self.open[level].pop() if level else []
        window.append(piece)
        self.counts[level] -= bool(level)
        if level + size == self.capacity:
            full.append(window)
        else:
            self.open[level + size].append(window)
            self.counts[level + size] += 1
        return full

    def close(self) -> list:
        """The windows left, without any padding."""
        left = [(level, w) for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.open.clear()
        self.counts[:] = 0
        whole, rest = divmod(sum(level for level, _ in left), self.capacity)
        spare = (piece for _, w in left[whole:] for piece in w)
        held = None
        out = []

        def take(room):
            nonlocal held
            got = []
            while room:
                doc, start, ids, total = held if held else next(spare)
                got.append((doc, start, ids[:room], total))
                held = (doc, start + room, ids[room:], total) if len(ids) > room else None
                room -= len(got[-1][2])
            return got

        for level, window in left[:whole]:
            out.append(window + take(self.capacity - level))
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                out.append(take(1 << bit))
        return out


def pieces_batch(windows, first: int, id_type) -> pa.RecordBatch:
    rows = [
        (doc, start, ids, total, first + k, offset)
        for k, window in enumerate(windows)
        for (doc, start, ids, total), offset in zip(window, np.cumsum([0, *[len(p[2]) for p in window]]))
    ]
    doc, start, ids, total, seq, offset = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc, id_type), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
            pa.array([x.tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()), pa.array(seq, pa.int64()),
            pa.array(offset, pa.int64()),
        ],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


def stretches(batch: pa.RecordBatch):
    """The rows of a batch, as many at a time as have about ``STRETCH`` bytes of text."""
    share = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64) // STRETCH
    cuts = [0, *np.flatnonzero(np.diff(share)) + 1, batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def pack(docs: DataFrame, tokenizer_path: str, doc_id="doc_id", text="text", capacity=CAPACITY, end_id=END_ID) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds unsigned 32-bit little-endian ids; a document's ids end with ``end_id``, so an
    empty or null text has that one id. Repeated rows are packed one by one. A sequence is
    full or has a power of two of ids, so none needs padding. ``capacity`` is a power of two.
    Sequence ids are the task's number in the high bits and a running number in the low ones:
    a task that is run again gives the same pieces. So sequence ids go with the order of the
    partitions of ``docs`` and, within one, with the order in which windows get full; those
    still open at its end come last. An empty table gives an empty table.
    Other columns are not read.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = narrow(docs, doc_id=c(doc_id), text=text_of(text))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        ids, packer = chunk_ids(tokenizer_path), LevelPacker(capacity)
        first, kind = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            kind = batch.column("doc_id").type
            for part in stretches(batch):
                full = []
                for doc, got in zip(part.column("doc_id").to_pylist(), ids.many(part.column("text").to_pylist(), [end_id])):
                    full += packer.place(doc, got)
                if full:
                    yield pieces_batch(full, first, kind)
                    first += len(full)
        rest = iter(packer.close())
        while some := list(islice(rest, 256)):
            yield pieces_batch(some, first, kind)
            first += len(some)

    return rows.mapInArrow(run, PIECES.format(id=id_type))


def ids_crc32(ids="ids"):
    return F.crc32(c(ids)).cast("long")
