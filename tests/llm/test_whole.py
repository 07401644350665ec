"""Whole results where a shorter way would lose some."""

import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lathework.llm import html_text, mixing, packing
from lathework.llm.registry import QUERIES
from lathework.llm.tokens import ChunkIds

PATH = public_tokenizers.path("word_bpe_49k.json")

# The weights that the given pages lead to, rounded.
WEIGHTS = {"word": 3.0, "link": -0.2, "tag": -3.25, "div": -4.0, "article": -4.0, "a": -4.0, "other": -4.0, "form": -4.0} | dict.fromkeys(
    ("h1", "p", "b", "br"), -0.2
)


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


@pytest.mark.parametrize("weights", [WEIGHTS, html_text.DEFAULTS])
def test_body_beside_article_cards_stays(weights):
    card = f"<article><p>{words('card', 12)}</p></article>"
    page = f"<body><div><h1>Title here</h1><p>{words('a', 80)}</p>{card}<p>{words('b', 80)}</p></div>{card}</body>"
    got = html_text.main_text(page, weights)
    assert got.startswith(f"Title here {words('a', 80)} ") and words("b", 80) in got


def test_mark_is_a_bounded_bonus():
    marked = f"<body><div>{words('x', 2)}</div><div></div><div></div><article><p>{words('a', 40)}</p></article></body>"
    assert html_text.main_text(marked, WEIGHTS) == words("a", 40)
    longer = f"<body><article><p>{words('c', 10)}</p></article><div>{words('x', 3)}</div>{'<hr>' * 40}<div><p>{words('a', 400)}</p></div></body>"
    assert words("a", 400) in html_text.main_text(longer, WEIGHTS)


BODY = f"<h1>Title here</h1><p>{words('a', 60)}</p><p>{words('b', 60)}</p>"
TEXT = f"Title here {words('a', 60)} {words('b', 60)}"
SIDES = f"<nav>{words('n', 30)}</nav><div class='sidebar'>{words('s', 20)}</div>"


@pytest.mark.parametrize("weights", [WEIGHTS, html_text.DEFAULTS])
@pytest.mark.parametrize("begin, end", [
    ("<form action='x'>", "</form>"), ("<div class='layout with-sidebar'>", "</div>"), ("<div class='content no-sidebar'>", "</div>"),
    ("<div class='page_has_sidebar'>", "</div>"), ("<div class='sidebar-layout'>", "</div>"), ("<div style='visibility:hidden'>", "</div>"),
    ("<form><div class='widget-wrapper'><fieldset>", "</fieldset></div></form>"), ("<form><article>", "</article></form>"),
])
def test_wrapped_pages_keep_their_text(begin, end, weights):
    assert html_text.main_text(f"<body>{begin}{SIDES}{BODY}{end}<footer>{words('f', 9)}</footer></body>", weights) == TEXT
    plain = f"<body>{begin}{SIDES}<p>{words('a', 60)}</p>{end}</body>"
    assert html_text.main_text(plain, weights) == words("a", 60)


def test_marked_articles_in_a_wrapper_are_labels():
    inside = [p[3] and not p[2] for p in html_text.pieces(f"<body><form>{SIDES}<article>{BODY}</article></form></body>") if p[0] == "text"]
    assert inside == [False, False, True, True, True]


@pytest.mark.parametrize("begin, end", [
    ("<div id='comments'>", "</div>"), ("<section class='related'>", "</section>"), ("<form>", "</form>"), ("<nav>", "</nav>"),
    ("<div class='is-hidden hidden'>", "</div>"),
])
def test_large_side_parts_stay_outside(begin, end):
    assert html_text.main_text(f"<body><div>{BODY}</div>{begin}<p>{words('c', 300)}</p>{end}</body>", WEIGHTS) == TEXT


def test_pages_of_side_parts_only_are_empty():
    assert html_text.main_text("<nav>Home About</nav><footer>c</footer>", WEIGHTS) == ""


def test_chunk_ids_of_letters_that_end_in_a_mark():
    ids, whole = ChunkIds(PATH), Tokenizer.from_file(PATH)
    letters = [chr(n) for n in range(0x80, 0x20000) if not 0xD800 <= n < 0xE000 and chr(n).isalpha()]
    marked = [x for x in letters if not whole.normalizer.normalize_str(x)[-1].isalpha()]
    assert {"\u0130", "\u0958", "\u09dc"} <= set(marked)
    for word in ["CUMHUR\u0130YET\u0130", *["a" + x for x in marked], *["a" + x for x in letters[::50]]]:
        for text in (word + ",", word + ".", f"b {word}, c"):
            assert ids.of(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


def served(even, t):
    """The share of a source's demand that is due by a time: weights from 3 to 1, or from 1 to 3."""
    return 1.5 * t - t * t / 2 if even else t / 2 + t * t / 2


def brute_positions(rows):
    """By ``doc_id``: the position of each copy, found by halving; ``rows`` are ``doc_id, source, size, target``."""
    by_source = defaultdict(list)
    for doc, source, size, target in rows:
        by_source[source].append((int(hashlib.md5(str(doc).encode()).hexdigest()[:13], 16), doc, size, target))
    out = defaultdict(list)
    spoken = sorted((s for s in by_source if s is not None and any(x[2] for x in by_source[s])), key=lambda s: s.encode())
    for rank, source in enumerate(spoken):
        due, at = round(by_source[source][0][3]), 0
        for _, doc, size, _ in sorted(by_source[source]) * 2:
            taken = max(0, min(size, due - at))
            if taken:
                low, high, share = 0.0, 1.0, (at + taken / 2) / due
                for _ in range(60):
                    half = (low + high) / 2
                    low, high = (half, high) if served(rank % 2 == 0, half) < share else (low, half)
                out[doc].append(low)
            at += size
    return out


def test_positions_of_mixed_documents(spark, docs):
    summary = mixing.mix_summary(docs)
    assert summary.columns == ["doc_id", "size", "source_size", "target", "taken", "positions"]
    rows = summary.collect()
    source = dict(docs.select("doc_id", "source").collect())
    want = brute_positions([(r["doc_id"], source[r["doc_id"]], r["size"], r["target"]) for r in rows])
    for r in rows:
        assert r["positions"] == pytest.approx(want[r["doc_id"]], abs=1e-9) and bool(r["positions"]) == (r["taken"] > 0)
    first = [r["positions"][0] if r["positions"] else 2.0 for r in rows]
    assert first == sorted(first) and len(set(first)) > 100


def test_mixed_rows_and_the_query_are_in_training_order(spark, data, docs):
    want = sorted((p, r["doc_id"]) for r in mixing.mix_summary(docs).collect() for p in r["positions"])
    assert [r["doc_id"] for r in mixing.mix(docs).collect()] == [d for _, d in want]
    got = [r["doc_id"] for r in QUERIES["op9_mixing"](spark, data).collect()]
    assert got[:len({d for _, d in want})] == list(dict.fromkeys(d for _, d in want))


def test_order_is_found_anew_and_packed(spark, data, docs):
    want = sorted((p, r["doc_id"]) for r in mixing.mix_summary(docs).collect() for p in r["positions"])
    mixed = mixing.mix(docs).cache()
    shuffled = mixed.repartition(7, F.rand(1))
    found = mixing.in_order(shuffled, bucket_rows=20, range_words=3_000).cache()
    assert [(r["position"], r["doc_id"]) for r in found.collect()] == want
    assert sorted(found.select("doc_id", "text").collect()) == sorted(mixed.select("doc_id", "text").collect())

    where = defaultdict(list)
    for p, d in want:
        where[d].append(p)
    last, ranges = defaultdict(list), defaultdict(list)
    for r in packing.pack(found, PATH).select("doc_id", "sequence_id").collect():
        if len(where[r["doc_id"]]) == 1:
            last[r["sequence_id"]].append(where[r["doc_id"]][0])
    for seq, at in last.items():
        ranges[seq >> 33] += at
    spans = [(min(ranges[k]), max(ranges[k])) for k in sorted(ranges)]
    assert len(spans) > 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_pack_stage_does_not_depend_on_the_order_of_rows(spark, data, docs):
    mixed = mixing.mix(docs).cache()
    stage = dict(corpus_pipeline.STAGES)["pack"]
    one, other = (
        sorted(tuple(r) for r in stage(spark, x, data).select("sequence_id", "offset", "doc_id", "start", "length").collect())
        for x in (mixed, mixed.repartition(7, F.rand(1)))
    )
    assert one == other
