"""Merkle fingerprints of documents, in DataFrame functions only.

A text is split into sections at empty lines, a section into paragraphs at line ends, and a
paragraph into pieces of a few words with the white space before them. Pieces are hashed;
paragraphs, sections and the root hash what is below them. Nothing of the text is lost in
the splits. :func:`differences` compares two versions of documents under whole digests: equal
roots end the comparison, and only branches that differ are followed down to the places of an edit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import narrow, text_of
from lathework.operators.ranks import ranked
from lathework.session import settle

PIECE_WORDS = 4
LEAF = 8  # hexadecimal digits of a piece's hash
PIECE = r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){1,%d}|[\x20\x09-\x0D]+\z"


def tree(text: Column, words=PIECE_WORDS) -> Column:
    """Array of sections, each an array of paragraphs, each the hashes of its pieces in one string."""

    def leaves(paragraph):
        pieces = F.regexp_extract_all(paragraph, F.lit(PIECE % words), F.lit(0))
        return F.array_join(F.transform(pieces, lambda p: F.substring(F.md5(p), 1, LEAF)), "")

    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(F.split(s, "\n"), leaves))


def branches(tree: Column) -> Column:
    """The sections as ``hash, paragraphs``, where a paragraph is its hash, a point, its pieces."""

    def section(paragraphs):
        named = F.transform(paragraphs, lambda p: F.concat(F.substring(F.md5(p), 1, LEAF), F.lit("."), p))
        below = F.array_join(F.transform(paragraphs, lambda p: F.substring(F.md5(p), 1, LEAF)), "")
        return F.struct(F.substring(F.md5(below), 1, 16).alias("hash"), F.array_join(named, ",").alias("paragraphs"))

    return F.transform(tree, section)


def fingerprint(branches: Column) -> Column:
    """``root:section=paragraph,paragraph;section=...``."""
    root = F.md5(F.array_join(F.transform(branches, lambda s: s["hash"]), ""))
    rest = F.array_join(F.transform(branches, lambda s: F.concat(s["hash"], F.lit("="), s["paragraphs"])), ";")
    return F.concat(root, F.lit(":"), rest)


# A clause with the white space before it: it ends behind a word's last stop, wherever that is in the text.
CLAUSE = r"(?s).*?[.!?;:,]+(?=[\x20\x09-\x0D]|\z)|.+\z"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _node(below: Column) -> Column:
    """A branch: its whole digest over those of the branches below it."""
    def node(x):
        return F.struct(F.sha2(F.array_join(F.transform(x, lambda b: b["hash"]), ""), 256).alias("hash"), x.alias("below"))

    return _let(below, node)


def whole_tree(text: Column) -> Column:
    """The tree of a text as ``hash, below`` down to clauses, which are ``hash, text``; hashes are SHA-256."""
    def paragraph(p):
        clauses = F.regexp_extract_all(p, F.lit(CLAUSE), F.lit(0))
        return _node(F.transform(clauses, lambda x: F.struct(F.sha2(x, 256).alias("hash"), x.alias("text"))))

    def section(s):
        return _node(F.transform(F.split(s, "\n"), paragraph))

    return _node(F.transform(F.split(text, "\n\n"), section))


def _unmatched(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows of ``_key, side, place, hash`` whose hash has no partner on the other side of its document.

    The n-th of equal branches on one side goes with the n-th on the other, so repeats count.
    """
    nth = F.row_number().over(W.partitionBy("_key", "hash", "side").orderBy("place"))
    rows = rows.withColumn("_nth", nth).withColumn("_n", F.count("*").over(W.partitionBy("_key", "hash", "_nth")))
    return rows.filter("_n = 1").select("_key", "side", "place", *keep)


def _below(rows: DataFrame) -> DataFrame:
    """The branches one level down, with their place behind that of the branch they hang on."""
    down = rows.select("_key", "side", F.col("place").alias("_place"), F.posexplode("below").alias("_at", "_branch"))
    place = F.concat("_place", F.array(F.col("_at") + 1))
    return down.select("_key", "side", place.alias("place"), "_branch.*")


def differences(before: DataFrame, after: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """Where two versions of documents differ: ``doc_id, side, section, paragraph, clause, text``.

    One row for each clause that one version has and the other has not; ``side`` is ``before`` or
    ``after``, and places count from 1 in their own version. A branch that only moved within its
    document differs nowhere below; where nothing but places or the splits between branches
    changed, there are no rows, although the roots differ. A document that one table lacks
    differs in all its clauses. A null text is an empty one, which has no clauses; a null id is
    an id; of repeated ids the smallest text counts. Empty tables give an empty table. Texts
    move once, by id, and beyond that only branches of documents whose roots differ.
    """
    sides = [narrow(df, _key=c(doc_id), side=F.lit(name), text=text_of(text)) for df, name in ((before, "before"), (after, "after"))]
    both = sides[0].unionByName(sides[1]).groupBy("_key").agg(
        *[F.min(F.when(F.col("side") == name, F.col("text"))).alias(name) for name in ("before", "after")]
    ).filter(~F.col("before").eqNullSafe(F.col("after")))
    both = both.select("_key", whole_tree(F.col("before")).alias("before"), whole_tree(F.col("after")).alias("after"))
    both = both.filter(~F.col("before.hash").eqNullSafe(F.col("after.hash")))
    roots = both.select("_key", F.explode(F.array(*[
        F.struct(F.lit(name).alias("side"), F.col(f"{name}.below").alias("below")) for name in ("before", "after")
    ])).alias("_side")).select("_key", "_side.side", F.array().cast("array<int>").alias("place"), "_side.below")
    sections = _unmatched(_below(roots), "below")
    paragraphs = _unmatched(_below(sections), "below")
    clauses = _unmatched(_below(paragraphs), "text")
    at = {name: F.col("place")[i] for i, name in enumerate(("section", "paragraph", "clause"))}
    return clauses.select(F.col("_key").alias("doc_id"), "side", *[v.alias(k) for k, v in at.items()], "text")


def leaf_string(tree: Column) -> Column:
    return F.array_join(F.flatten(tree), "")


def leaf_set(leaves: Column) -> Column:
    """The distinct piece hashes in a string of them."""
    return F.array_distinct(F.regexp_extract_all(leaves, F.lit(".{%d}" % LEAF), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """Dice's share of common pieces of two sets; 1 for two texts without pieces."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text", words=PIECE_WORDS) -> DataFrame:
    """``doc_id, n_chars, fingerprint, leaves`` for each row of ``docs``; ``leaves`` is a set.

    A null text is an empty one, which has a root and no pieces. Repeated rows are fingerprinted
    one by one. Other columns are not read.
    """
    rows = narrow(docs, doc_id=c(doc_id), text=text_of(text))
    trees = rows.withColumn("tree", tree(F.col("text"), words)).withColumn("branches", branches(F.col("tree")))
    return trees.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), fingerprint(F.col("branches")).alias("fingerprint"),
        leaf_set(leaf_string(F.col("tree"))).alias("leaves"),
    )


def following(rows: DataFrame) -> DataFrame:
    """``doc_id, next_id, most``: the id that comes next, from the largest to the smallest.

    After the smallest comes the largest; a null id comes last. ``most`` is how many code points
    of the next text can be asked for. Works on ids only.
    """
    ids = rows.groupBy("doc_id").agg(F.floor(F.max(F.char_length("text")) / 2).cast("int").alias("most"))
    ids = ranked(ids, F.col("doc_id").desc_nulls_last())
    ids = settle(ids, "order")
    n = ids.count()
    first = ids.select(F.col("doc_id").alias("next_id"), F.col("rank").alias("at"))
    return ids.withColumn("at", (F.col("rank") + 1) % max(1, n)).join(first, "at").select("doc_id", "next_id", "most")


def edit_likeness(docs: DataFrame, doc_id="doc_id", text="text", words=PIECE_WORDS) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how alike they are.

    The edited text has the last half of its code points (rounded down) replaced by as many of
    the first ones of the next document, by descending id, or by all if it is shorter. Columns:
    ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next``. Texts
    move once by their id, and of the next text only what the edit needs and its piece
    hashes. Of repeated ids the smallest text is the next document of others. The only
    document of a table is its own next one. An empty table gives an empty table.
    """
    rows = narrow(docs, doc_id=c(doc_id), text=text_of(text))
    order = following(rows)
    kind = rows.schema["doc_id"].dataType

    def key(name):  # two columns that are never null, so that one exchange serves sums and joins
        return F.coalesce(c(name), F.lit(0).cast(kind)), c(name).isNull()

    def keyed(df, name, a, b):
        return df.withColumns(dict(zip((a, b), key(name))))

    # both joins read the very same columns, so that the texts are shuffled once for the two
    rows = keyed(rows, "doc_id", "k", "k0").select("k", "k0", "text")
    order = keyed(keyed(order, "next_id", "k", "k0"), "doc_id", "f", "f0").select("k", "k0", "f", "f0", "most")
    heads = rows.join(order.hint("merge"), ["k", "k0"]).select(
        "f", "f0", F.substring("text", F.lit(1), F.col("most")).alias("head"), leaf_string(tree(F.col("text"), words)).alias("next_leaves")
    )
    heads = heads.groupBy("f", "f0").agg(F.min(F.struct("head", "next_leaves")).alias("next")).select(
        F.col("f").alias("k"), F.col("f0").alias("k0"), "next"
    )
    both = rows.join(heads.hint("merge"), ["k", "k0"]).select(
        F.when(~F.col("k0"), F.col("k")).alias("doc_id"), "text", F.char_length("text").alias("n"), "next"
    )
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n") - half), F.substring("next.head", F.lit(1), half))
    both = both.withColumn("edited", edited)
    both = both.withColumns({"tree": tree(F.col("text"), words), "edited_tree": tree(F.col("edited"), words)})
    both = both.withColumns({
        "branches": branches(F.col("tree")), "edited_branches": branches(F.col("edited_tree")),
        "own": leaf_set(leaf_string(F.col("tree"))), "other": leaf_set(leaf_string(F.col("edited_tree"))),
        "following": leaf_set(F.col("next.next_leaves")),
    })
    return both.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited", fingerprint(F.col("branches")).alias("fingerprint"),
        fingerprint(F.col("edited_branches")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
