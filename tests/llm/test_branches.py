"""Comparison of two Merkle trees, against sets of clauses counted in plain Python."""

import re
from collections import Counter

from lathework.llm import merkle

SCHEMA = "doc_id long, text string"
CLAUSE = re.compile(r".*?[.!?;:,]+(?=[\x20\x09-\x0D]|\Z)|.+\Z", re.S)


def places(text):
    return {
        (i + 1, j + 1, k + 1): x for i, s in enumerate((text or "").split("\n\n")) for j, p in enumerate(s.split("\n"))
        for k, x in enumerate(CLAUSE.findall(p))
    }


def found(spark, before, after):
    a, b = (spark.createDataFrame(x, SCHEMA).selectExpr("*", "1 AS side", "'x' AS hash") for x in (before, after))
    return [(r["doc_id"], r["side"], (r["section"], r["paragraph"], r["clause"]), r["text"]) for r in merkle.differences(a, b).collect()]


LONG = " ".join(f"Word{i} and more of it, then{i} again." for i in range(400))
PAIRS = {
    1: ("One, two. Three\nfour five.\n\nSix; seven!", "One, two. Three\nfour 5.\n\nSix; seven!"),
    2: ("same text.", "same text."),
    3: ("", None),
    4: (None, "new words, all"),
    5: ("a.\n\nb.\n\nc.", "c.\n\na.\n\nb."),
    6: ("x, x, x, y.", "x, y."),
    7: (LONG, LONG.replace("Word3 and", "Word3 inserted and", 1)),
    8: ("  \t\n\n\n  a.b, \x85c", "  \t\n\n\n  a.b, \x85c d"),
    None: ("null id, here.", "null id, there."),
}


def test_places_of_edits(spark):
    before = [(k, a) for k, (a, _) in PAIRS.items()] + [(20, "only, before."), (1, "zz a larger text of a repeated id")]
    after = [(k, b) for k, (_, b) in PAIRS.items()] + [(21, "only, after.")]
    got = found(spark, before, after)
    for k, (a, b) in (PAIRS | {20: ("only, before.", ""), 21: ("", "only, after.")}).items():
        a, b = places(a), places(b)
        mine = [r[1:] for r in got if r[0] == k]
        assert all({"before": a, "after": b}[side][at] == text for side, at, text in mine)  # places are right
        # what moved, or is in both versions elsewhere, may only be named where its branch differs
        for side, one, other in (("before", a, b), ("after", b, a)):
            lost = Counter(one.values()) - Counter(other.values())
            assert not lost - Counter(text for s, _, text in mine if s == side)
    assert [r for r in got if r[0] in (2, 3, 5)] == []
    assert sorted(r[1:3] for r in got if r[0] == 1) == [("after", (1, 2, 1)), ("before", (1, 2, 1))]
    assert [r[3] for r in got if r[0] == 6] == [" x,", " x,"]  # repeats count
    assert len([r for r in got if r[0] == 7]) == 2  # one inserted word is one clause on each side
    assert len([r for r in got if r[0] is None]) == 2


def test_nothing_to_compare(spark):
    assert found(spark, [], []) == []
    assert found(spark, [(1, "a")], []) == [(1, "before", (1, 1, 1), "a")]


def test_whole_digests_tell_short_texts_apart(spark):
    texts = spark.range(300_000).selectExpr("cast(id AS string) AS text")
    roots = texts.select(merkle.whole_tree(texts["text"])["hash"].alias("root"))
    assert roots.distinct().count() == 300_000


def test_no_python_worker_in_the_comparison(spark, capsys):
    df = spark.range(3).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    merkle.differences(df, df).explain("formatted")
    assert not any(x in capsys.readouterr().out for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
