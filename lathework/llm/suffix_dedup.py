"""Removal of repeated passages: suffixes sorted deep-shallow around content-defined anchors.

Every window of 200 bytes has an anchor, the 64-byte stretch in it with the smallest hash, and
equal windows have equal anchors at equal places. Consecutive windows with the same anchor
are one run, so a text is a few runs for each hundred bytes, not a suffix for each byte.
Anchors that occur once cannot hold a repeated window. Runs that are equal as a whole
collapse to one with a count, by partial sums before the shuffle. Where an anchor has
different runs, the suffixes that start at their windows are sorted: multikey quicksort
by words of eight bytes to a shallow depth, and blind tries for the groups that are
still equal there. Neighbours that share 200 bytes are repeated windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import ROW, narrow, text_of
from lathework.llm.exact_dedup import filter_bits, flag_repeated, repeated_slots
from lathework.llm.textbytes import BASE, OTHER, chunks, mixed, powers, prefix_sums, stretch_hash, word_array
from lathework.session import settle

WINDOW = 200
ANCHOR = 64
FILTER_BITS = 8  # a run, in the filter of anchors
RUN_BYTES = 1 << 16  # texts whose runs are found together; what numpy holds for them fits the cache
SHALLOW = 4  # words of eight bytes that the quicksort looks at
SORT_RUNS = 2048  # runs of one anchor that one sort takes; more are compared window by window


def window_anchors(sums: np.ndarray, n: int, window=WINDOW, anchor=ANCHOR) -> np.ndarray:
    """For each window start of ``n`` bytes the place of its anchor.

    The smallest hash in each stretch of anchor places, the first one of equals, by running
    minima from both ends of blocks.
    """
    width = window - anchor + 1
    places = n - anchor + 1
    # 32 bits of the hash above the place, so that a minimum names its place
    hashes = mixed((sums[anchor:] - sums[:places]) * powers(BASE, n + 1)[1][:places])
    padded = np.full(-(-places // width) * width, np.iinfo(np.uint64).max)
    padded[:places] = hashes >> np.uint64(32) << np.uint64(32) | np.arange(places, dtype=np.uint64)
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - window + 1
    least = np.minimum(back[:starts], ahead[width - 1:width - 1 + starts])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(offsets: np.ndarray, data: np.ndarray, window=WINDOW, anchor=ANCHOR):
    """``(text, first window, windows, place of the anchor in the first window, anchor hash, run hash)`` of some texts.

    Hashes and minima are taken over all texts at once; windows that cross the end of one are left out.
    """
    n = len(data)
    if (np.diff(offsets) < window).all():
        return None
    sums = prefix_sums(data)
    at = window_anchors(sums, n, window, anchor)
    new = np.zeros(n + 1, dtype=bool)
    new[1:len(at)] = at[1:] != at[:-1]
    new[offsets] = True
    first = np.flatnonzero(new[:len(at)])
    text = np.searchsorted(offsets, first, side="right") - 1
    last = offsets[text + 1] - window + 1  # behind the last window of the text
    inside = first < last
    first, text, last = first[inside], text[inside], last[inside]
    count = np.minimum(np.append(first[1:], n), last) - first
    place = at[first]
    h = stretch_hash(sums, place, place + anchor)
    end = first + count + window - 1
    # two hashes over other powers make the run's own name
    other = prefix_sums(data, OTHER)
    r = mixed(stretch_hash(sums, first, end) ^ (stretch_hash(other, first, end, OTHER) * np.uint64(BASE))) + (place - first).astype(np.uint64)
    return text, first - offsets[text], count, place - first, h.view(np.int64), r.view(np.int64)


def run_table(texts: DataFrame, window=WINDOW, anchor=ANCHOR) -> DataFrame:
    """``_row, h, r, first, windows, place`` of all runs of all texts (``_row, text``)."""

    def run(batches):
        for batch in batches:
            rows = batch.column(ROW).to_numpy()
            found = [(row, runs_of(o, d, window, anchor)) for row, o, d in chunks(batch.column("text"), RUN_BYTES)]
            found = [(rows[row + got[0]], *got[1:]) for row, got in found if got is not None]
            if found:
                owner, first, count, place, h, r = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (owner, h, r, first.astype(np.int32), count.astype(np.int32), place.astype(np.int32))],
                    names=[ROW, "h", "r", "first", "windows", "place"],
                )

    return texts.mapInArrow(run, f"{ROW} long, h long, r long, first int, windows int, place int")


class Windows:
    """Windows as rows of words: their name, then their bytes as big-endian words of eight, fetched when asked for."""

    def __init__(self, data: np.ndarray, at: np.ndarray, name: np.ndarray, window=WINDOW):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.every = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,)).astype(np.uint64)
        self.at, self.name, self.window = at, name, window
        self.width = 1 + -(-window // 8)

    def word(self, number: int, of: np.ndarray) -> np.ndarray:
        if number == 0:
            return self.name[of]
        out = self.every[self.at[of] + 8 * (number - 1)]
        over = 8 * number - self.window
        return out >> np.uint64(8 * over) if over > 0 else out

    def table(self, of: np.ndarray) -> np.ndarray:
        return np.column_stack([self.word(i, of) for i in range(self.width)])


def ranks(key: np.ndarray) -> np.ndarray:
    """The number of smaller distinct keys."""
    order = np.argsort(key)
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], np.diff(key[order]) != 0]))
    return out


def shallow_sort(windows: Windows, depth=SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort to a shallow depth: an order, and where groups of equals begin.

    All groups that are still equal are split together by the next word.
    """
    order = np.argsort(windows.name)
    key = windows.name[order]
    begin = np.concatenate([[True], key[1:] != key[:-1]])
    for d in range(1, min(depth + 1, windows.width)):
        group = np.cumsum(begin)
        size = np.bincount(group)
        tied = np.flatnonzero(size[group] > 1)
        if not len(tied):
            break
        key, own = ranks(windows.word(d, order[tied])), group[tied]
        both = own * (int(key.max()) + 1) + key
        again = np.argsort(both)
        order[tied] = order[tied][again]
        begin[tied[1:]] |= np.diff(both[again]) != 0
    return order, begin


class BlindTrie:
    """Orders members that agree up to a depth, and finds which of them are equal.

    An inner node holds only the number of the word at which its branches part. A member goes
    down by these words alone, is compared once with the leaf it reaches, and is put in
    where the first difference is.
    """

    __slots__ = ("words", "root")

    def __init__(self, words: np.ndarray, first: int):
        self.words, self.root = words, [first]

    def add(self, member: int) -> None:
        row = self.words[member]
        node, path = self.root, []
        while isinstance(node, tuple):
            path.append(node)
            word, branches = node
            node = branches.get(int(row[word])) or next(iter(branches.values()))
        leaf = self.words[node[0]]
        apart = np.flatnonzero(row != leaf)
        if not len(apart):
            node.append(member)
            return
        at = int(apart[0])
        parent = None
        below = self.root
        for step in path:
            if step[0] >= at:
                break
            parent, below = step, step[1].get(int(row[step[0]]))
        if isinstance(below, tuple) and below[0] == at:
            below[1][int(row[at])] = [member]
            return
        made = (at, {int(leaf[at]): below, int(row[at]): [member]})
        if parent is None:
            self.root = made
        else:
            parent[1][int(row[parent[0]])] = made

    def leaves(self):
        """Lists of equal members, in order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                yield node
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def repeated_windows(windows: Windows, weight: np.ndarray, depth=SHALLOW) -> np.ndarray:
    """Which windows are there twice or more, counting each by its weight."""
    order, begin = shallow_sort(windows, depth)
    out = weight > 1
    edges = np.flatnonzero(np.concatenate([begin, [True]]))
    size = np.diff(edges)
    # a trie of two is one comparison: all of them at once
    two = edges[:-1][size == 2]
    left, right = order[two], order[two + 1]
    for d in range(depth + 1, windows.width):
        same = windows.word(d, left) == windows.word(d, right)
        left, right = left[same], right[same]
    out[left] = True
    out[right] = True
    more, count = edges[:-1][size > 2], size[size > 2]
    if not len(more):
        return out
    members = order[np.repeat(more, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    table, ends = windows.table(members), np.cumsum(count)
    # a trie of equals is one leaf: these need no tries either
    equal = (table == np.repeat(table[ends - count], count, axis=0)).all(axis=1)
    alike = np.logical_and.reduceat(equal, ends - count)
    out[members[np.repeat(alike, count)]] = True
    for b, n in zip(ends[~alike].tolist(), count[~alike].tolist()):
        trie = BlindTrie(table, b - n)
        for m in range(b - n + 1, b):
            trie.add(m)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                out[members[leaf]] = True
    return out


def _sort_anchors(batches, window=WINDOW, depth=SHALLOW):
    """The first and last repeated window of each run that has any; runs of one anchor come one after another."""

    def sort(part):
        h, count, place, many = (part.column(k).to_numpy().astype(np.int64) for k in ("h", "windows", "place", "many"))
        (_, offsets, data), = chunks(part.column("stretch"), 1 << 62)
        owner = np.repeat(np.arange(len(h)), count)
        starts = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        # windows are equal only with the same anchor at the same place
        name = h[owner].view(np.uint64) + (place[owner] - starts).astype(np.uint64)
        hit = np.flatnonzero(repeated_windows(Windows(data, offsets[owner] + starts, name, window), many[owner], depth))
        own, low = np.unique(owner[hit], return_index=True)
        high = np.searchsorted(owner[hit], own, side="right") - 1
        return pa.RecordBatch.from_arrays(
            [part.column(k).take(pa.array(own)) for k in ("h", "r")] + [pa.array(starts[hit[x]].astype(np.int32)) for x in (low, high)],
            names=["h", "r", "low", "high"],
        )

    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        edges = np.flatnonzero(h[1:] != h[:-1]) + 1
        if held and held[-1].column("h")[-1].as_py() != h[0]:
            yield sort(pa.concat_batches(held))
            held = []
        at = 0
        while at < len(h):
            cut = edges[np.searchsorted(edges, at + (1 if held else SORT_RUNS // 2)):]
            if not len(cut):  # the last anchor may go on in the next batch
                held.append(batch.slice(at))
                break
            yield sort(pa.concat_batches([*held, batch.slice(at, int(cut[0]) - at)]))
            held, at = [], int(cut[0])
    if held:
        yield sort(pa.concat_batches(held))


def _stretches(texts: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``wanted`` with the bytes of each run, cut from its text."""
    by_row = wanted.groupBy(ROW).agg(F.collect_list(F.struct("h", "r", "first", "windows", "place", "many", "hot")).alias("runs"))
    found = texts.join(by_row.hint("merge"), ROW).select(F.encode("text", "utf-8").alias("raw"), F.explode("runs").alias("x"))
    return found.select("x.*", F.substring("raw", F.col("x.first") + 1, F.col("x.windows") + window - 1).alias("stretch"))


def _hot_windows(runs: DataFrame, window: int) -> DataFrame:
    """The first and last repeated window of runs of very frequent anchors.

    Each window is named by two hashes and its place, and counted by partial sums, so an
    anchor that a third of all rows hold never meets in one task.
    """

    def name(batches):
        for batch in batches:
            h, r, many, place = (batch.column(k).to_numpy() for k in ("h", "r", "many", "place"))
            for i, raw in enumerate(batch.column("stretch")):
                data = np.frombuffer(raw.as_py(), np.uint8)
                a = np.arange(len(data) - window + 1)
                one = stretch_hash(prefix_sums(data), a, a + window).view(np.int64)
                two = stretch_hash(prefix_sums(data, OTHER), a, a + window, OTHER).view(np.int64)
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, x)) for x in (h[i], r[i], many[i])] + [pa.array(x) for x in (a, one, two)],
                    names=["h", "r", "many", "at", "one", "two"],
                )

    named = settle(runs.mapInArrow(name, "h long, r long, many long, at long, one long, two long"), "hot")
    counts = named.groupBy("one", "two").agg(F.sum("many").alias("n")).filter("n > 1")
    return named.join(counts.hint("merge"), ["one", "two"]).groupBy("h", "r").agg(F.min("at").cast("int").alias("low"), F.max("at").cast("int").alias("high"))


def spans(texts: DataFrame, window=WINDOW, anchor=ANCHOR, sort_runs=SORT_RUNS) -> DataFrame:
    """``_row, begin, end`` of stretches of repeated windows (``end`` behind the last byte).

    ``texts``: ``_row, text``. Stretches of one text may overlap.
    """
    every = settle(run_table(texts, window, anchor), "runs")
    # anchors that are alone for certain leave before anything is shuffled
    bits = filter_bits(every.count(), FILTER_BITS)
    runs = flag_repeated(every, bits, repeated_slots(every.select("h"), bits)).filter("maybe").drop("maybe")
    runs = settle(runs, "repeated")
    # equal runs collapse; one of them lends its bytes
    one = F.min(F.struct(ROW, "first", "windows", "place")).alias("one")
    distinct = settle(runs.groupBy("h", "r").agg(F.count("*").alias("many"), one), "kinds")
    anchors = distinct.groupBy("h").agg(F.count("*").alias("kinds"), F.sum("many").alias("total")).filter("total > 1")
    live = settle(distinct.join(anchors.hint("merge"), "h").select("h", "r", "many", "one.*", "kinds"), "live")
    # a run has fewer windows than a window has bytes: its repeated windows overlap and are one stretch, from the first to the last
    whole = live.filter("kinds = 1").select("h", "r", F.lit(0).alias("low"), (F.col("windows") - 1).alias("high"))
    mixed_runs = live.filter("kinds > 1").withColumn("hot", F.col("kinds") > sort_runs)
    cut = settle(_stretches(texts, mixed_runs, window), "stretches")
    sorted_runs = (
        cut.filter("NOT hot").drop("hot", "first").repartition(c("h")).sortWithinPartitions("h", "r")
        .select("h", "r", "windows", "place", "many", "stretch")
        .mapInArrow(lambda b: _sort_anchors(b, window), "h long, r long, low int, high int")
    )
    hot = _hot_windows(cut.filter("hot"), window)
    answers = settle(whole.unionByName(sorted_runs).unionByName(hot), "answers")
    found = runs.select(ROW, "h", "r", "first").join(answers.hint("merge"), ["h", "r"])
    return found.select(ROW, (F.col("first") + F.col("low")).cast("long").alias("begin"), (F.col("first").cast("long") + F.col("high") + window).alias("end"))


def joined(stretches: DataFrame) -> DataFrame:
    """``_row, hits``: the stretches ``_row, begin, end`` of each text in order, those that touch joined into one."""

    def join(rows, begin, end):
        # in order of row and begin: where no earlier stretch of the row reaches, a new one begins
        number = np.cumsum(np.concatenate([[False], rows[1:] != rows[:-1]]))
        step = int(end.max()) + 1
        reach = np.maximum.accumulate(end + number * step) - number * step
        new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (begin[1:] > reach[:-1])]))
        last = np.append(new[1:], len(rows)) - 1
        first = np.flatnonzero(np.concatenate([[True], np.diff(rows[new]) != 0]))
        found = pa.StructArray.from_arrays([pa.array(begin[new]), pa.array(reach[last])], names=["begin", "end"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(new)).astype(np.int32)), found)
        return pa.RecordBatch.from_arrays([pa.array(rows[new][first]), lists], names=[ROW, "hits"])

    def run(batches):
        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([x, batch.column(k).to_numpy()]) for x, k in zip(held, (ROW, "begin", "end"))]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last row may go on
            if cut:
                yield join(*[x[:cut] for x in held])
                held = [x[cut:] for x in held]
        if len(held[0]):
            yield join(*held)

    dealt = stretches.repartition(c(ROW)).sortWithinPartitions(ROW, "begin")
    return dealt.mapInArrow(run, f"{ROW} long, hits array<struct<begin:long,end:long>>")


def keyed(texts: DataFrame) -> DataFrame:
    """``texts`` with ``_row``: the id where it names each row, else a number in a written copy."""
    ids = texts.select("doc_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    whole = dict(texts.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    if whole and not ids.filter("n > 1 OR doc_id IS NULL").head(1):
        return texts.withColumn(ROW, F.col("doc_id").cast("long"))
    return settle(texts.withColumn(ROW, F.monotonically_increasing_id()), "texts")


def remove_repeats(docs: DataFrame, doc_id="doc_id", text="text", window=WINDOW, anchor=ANCHOR, sort_runs=SORT_RUNS) -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` for each row of ``docs``.

    ``spans`` are the maximal removed runs as ``begin, end`` in bytes of the UTF-8 text, and
    ``kept`` is what is left, as bytes. A null text is empty; a text below the window's
    length keeps all. Repeated rows are each other's copies. An empty table gives an empty
    table. Other columns are not read.
    """
    texts = keyed(narrow(docs, doc_id=c(doc_id), text=text_of(text)))
    merged = joined(spans(texts.select(ROW, "text"), window, anchor, sort_runs))
    return texts.join(merged.hint("merge"), ROW, "left").select(
        "doc_id", F.col("text").cast("binary").alias("raw"), F.coalesce("hits", F.array().cast(merged.schema["hits"].dataType)).alias("hits")
    ).mapInArrow(_cut, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n_bytes long, kept binary, spans array<struct<begin:long,end:long>>")


def _cut(batches):
    for batch in batches:
        for row, offsets, data in chunks(batch.column("raw")):
            part = batch.slice(row, len(offsets) - 1)
            hits = part.column("hits")
            owner = np.repeat(np.arange(part.num_rows), hits.value_lengths().to_numpy())
            begin, end = (offsets[owner] + x.to_numpy() for x in hits.flatten().flatten())
            edge = np.zeros(len(data) + 1, np.int8)
            edge[begin] = 1
            edge[end] -= 1  # a text's last stretch may end where the next text's first begins
            stays = np.cumsum(edge[:-1], dtype=np.int8) == 0
            gone = np.bincount(owner, end - begin, minlength=part.num_rows).astype(np.int64)
            sizes = np.diff(offsets)
            kept = word_array(data[stays], sizes - gone).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), kept, hits], names=["doc_id", "n_bytes", "kept", "spans"],
            )
