"""Personal data: rules find the plain cases, and their contexts find others.

Spans that the rules find are seeds. The words around seeds are lexical patterns; whatever looks
like an identifier and stands in such a pattern is an instance that may be one too. Patterns and
instances make up a graph. A pattern is as good as the share of good instances among all that
it brings, an instance as good as its patterns together; the two are scored in turn, and
instances of good patterns become spans of their own.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from lathework.functions.columns import c
from lathework.llm.common import ROW, WORD, narrow, numbered, text_of
from lathework.session import settle

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SUPPORT = 3  # different seeds that a pattern needs
FLOOR = 0.5  # patterns below tell nothing about their instances
ACCEPT = 0.6
ROUNDS = 3

# Quantifiers that give nothing back keep each search linear in the text.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
ADDRESS = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
DIGITS = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
CALL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORDS = re.compile(WORD)
NOT_DIGITS, SOME_DIGITS = re.compile(r"[^0-9]+"), re.compile(r"[0-9]+")

# Looser shapes, for what only a pattern can confirm.
AT = re.compile(r"@|\[at\]|\(at\)")
HOST = re.compile(r"[A-Za-z0-9-]++(?:(?:\.|\[dot\]|\(dot\))[A-Za-z0-9-]++)*+")
NUMBER = re.compile(r"(?<![A-Za-z0-9.])\(?[0-9](?:[ ().\-/_]{0,2}[0-9])++(?![A-Za-z0-9])")
LONG_ADDRESS = re.compile(r"(?<![A-Za-z0-9:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![A-Za-z0-9:])")
HINT = r"[0-9@]|\[at\]|\(at\)"  # a text without it holds no span of any kind


def luhn(digits: str) -> bool:
    total = 0
    for i, v in enumerate(map(int, reversed(digits))):
        v = v * 2 if i % 2 else v
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _local_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the rules' spans, leftmost and not overlapping within a kind, sorted.

    A match that fails its check is dropped, and the search goes on behind it.
    """
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start, domain = _local_start(text, at, done), DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            out.append((start, EMAIL, done))
        at = text.find("@", max(at + 1, done))
    for m in ADDRESS.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append((m.start(), IP, m.end()))
    for m in DIGITS.finditer(text):
        digits = NOT_DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), CARD, m.end()))
    for m in CALL.finditer(text):
        if 9 <= len(NOT_DIGITS.sub("", m.group())) <= 15:
            out.append((m.start(), PHONE, m.end()))
    return sorted(out)


def loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, list[int]]]:
    """``(start, end, kinds)`` of what looks like an identifier and overlaps no span of ``taken``."""
    found = []
    for m in AT.finditer(text):
        start, host = _local_start(text, m.start(), 0), HOST.match(text, m.end())
        if start < m.start() and host:
            found.append((start, host.end(), [EMAIL]))
    for m in LONG_ADDRESS.finditer(text):
        found.append((m.start(), m.end(), [IP]))
    for m in NUMBER.finditer(text):
        digits = NOT_DIGITS.sub("", m.group())
        kinds = [CARD] if 12 <= len(digits) <= 19 and luhn(digits) else []
        if 7 <= len(digits) <= 15:
            kinds.append(PHONE)
        if kinds:
            found.append((m.start(), m.end(), kinds))
    out, ends, starts = [], [e for _, _, e in taken], [s for s, _, _ in taken]
    reach = 0
    upto = []  # the furthest end of the taken spans up to each
    for e in ends:
        reach = max(reach, e)
        upto.append(reach)
    done = 0
    for start, end, kinds in sorted(found):
        i = bisect_left(starts, end)
        if start >= done and (i == 0 or upto[i - 1] <= start):
            out.append((start, end, kinds))
            done = end
    return out


def value_of(text: str) -> str:
    """What names an instance: the digits of a number, else the text in small letters."""
    if any(ch.isalpha() or ch == ":" for ch in text):
        return text.lower()
    return NOT_DIGITS.sub("", text)


class Contexts:
    """The words of a text, from which the lexical patterns of its spans are made.

    Words are taken in small letters with numbers as 0. A word of over ``LONG`` characters is named
    by its digest, and of the word that a span is in its last ``LONG`` characters before the span count.
    """

    LONG = 64

    def __init__(self, text: str):
        self.text = text
        self.words = [m.span() for m in WORDS.finditer(text)]
        self.ends = [b for _, b in self.words]
        self.names: dict[int, str] = {}

    def name(self, i: int) -> str:
        if i < 0:
            return "^"
        if i >= len(self.words):
            return "$"
        if i not in self.names:
            word = self.text[slice(*self.words[i])]
            self.names[i] = self.plain(word) if len(word) <= self.LONG else hashlib.md5(word.encode()).hexdigest()
        return self.names[i]

    @staticmethod
    def plain(word: str) -> str:
        return SOME_DIGITS.sub("0", word.lower())

    def patterns(self, start: int, end: int) -> list[str]:
        """Two words before the span; a word on each side; a labelling word before it."""
        i = bisect_right(self.ends, start)  # the word that the span begins in
        begin = self.words[i][0] if i < len(self.words) else start
        own = self.plain(self.text[max(begin, start - self.LONG):start]) if begin < start else ""
        one = own or self.name(i - 1)
        out = [f"2 {self.name(i - 2)} {self.name(i - 1)} {own}", f"1 {one} {self.name(bisect_left(self.words, (end, end)))}"]
        if one[-1:] in (":", "=", "#"):
            out.append(f"0 {one}")
        return out


MENTION = StructType([
    StructField("kind", IntegerType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("value", StringType()), StructField("kinds", ArrayType(IntegerType())), StructField("patterns", ArrayType(StringType())),
])


def mentions_of(text: str) -> list[dict]:
    """Spans of the rules (with their kind) and open ones (kind is null), with value and patterns."""
    base = base_spans(text)
    every = [(s, e, k, [k]) for s, k, e in base] + [(s, e, None, ks) for s, e, ks in loose_spans(text, base)]
    if not every:
        return []
    around = Contexts(text)
    return [
        {"kind": k, "start": s, "end": e, "value": value_of(text[s:e]), "kinds": ks, "patterns": around.patterns(s, e)}
        for s, e, k, ks in every
    ]


def mentions(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) as ``doc_id, mentions``; no text is kept."""
    schema = StructType([docs.schema["doc_id"], StructField("mentions", ArrayType(MENTION))])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts = batch.column("text")
            some = pc.match_substring_regex(texts, HINT)
            found = [mentions_of(t.as_py()) if hint.as_py() else [] for t, hint in zip(texts, some)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, arrow.field("mentions").type)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def discovered(table: DataFrame, support=SUPPORT, floor=FLOOR, accept=ACCEPT, rounds=ROUNDS) -> DataFrame:
    """``value, kind, score``: open instances that the patterns of seeds confirm.

    A pattern counts for a kind if ``support`` different seeds of that kind stand in it. It is as
    good as the scores of its different instances (1 for a seed) over their number and one; an
    instance's score is the chance that not all its patterns from ``floor`` on are wrong.
    After ``rounds`` rounds, instances with ``accept`` or more count, each as its best kind.
    """
    each = table.select(F.explode("mentions").alias("m")).select("m.*")
    edges = settle(each.select("kind", "value", "kinds", F.explode("patterns").alias("pattern")).groupBy("pattern", "value").agg(
        F.min("kind").alias("kind"), F.min("kinds").alias("kinds")
    ), "edges")
    seeded = edges.filter("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= support)
    size = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    patterns = settle(seeded.join(size, "pattern"), "patterns")
    open_edges = edges.filter("kind IS NULL").select("pattern", "value", F.explode("kinds").alias("kind"))
    open_edges = settle(open_edges.join(patterns, ["pattern", "kind"]), "open")
    scores = open_edges.select("value", "kind").distinct().withColumn("score", F.lit(0.0))
    for k in range(rounds):
        gained = open_edges.join(scores, ["value", "kind"]).groupBy("pattern", "kind").agg(F.sum("score").alias("gained"))
        good = patterns.join(gained, ["pattern", "kind"]).select(
            "pattern", "kind", ((F.col("seeds") + F.col("gained")) / (F.col("n") + 1)).alias("good")
        ).filter(F.col("good") >= floor)
        wrong = F.sum(F.log(F.greatest(1 - F.col("good"), F.lit(1e-12))))
        told = open_edges.select("pattern", "kind", "value").join(good, ["pattern", "kind"]).groupBy("value", "kind").agg((1 - F.exp(wrong)).alias("score"))
        scores = settle(told, f"scores{k}")
    best = F.max(F.struct("score", (-F.col("kind")).alias("kind"))).alias("best")
    named = scores.filter(F.round("score", 9) >= accept).groupBy("value").agg(best).select(
        "value", (-F.col("best.kind")).alias("kind"), F.col("best.score").alias("score")
    )
    # a seed's value in another form needs no pattern
    known = each.filter("kind IS NOT NULL").groupBy("value").agg(F.min("kind").alias("kind")).withColumn("score", F.lit(1.0))
    known = known.join(each.filter("kind IS NULL").select("value").distinct().hint("merge"), "value", "left_semi")
    return known.unionByName(named.join(known, "value", "left_anti"))


def _listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda m: F.concat_ws(":", F.element_at(name, m["kind"] + 1), m["start"], m["end"])), ",")


def _number_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame, doc_id="doc_id", text="text", **options) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found`` for each row of ``docs``.

    The numbers and ``base_sha256`` are of the rules' spans, ``spans`` lists these and the ones that
    patterns found, ``found`` is how many those are. Offsets are code points, ends exclusive. A
    null, empty or blank text has no spans; long texts count in full; repeated rows get the
    same result each, and count once as instances. An empty table gives an empty table. Other
    columns are not read.
    """
    table = numbered(mentions(narrow(docs, doc_id=c(doc_id), text=text_of(text))), "mentions")
    known = settle(discovered(table, **options), "discovered")
    loose = table.select(ROW, F.explode("mentions").alias("m")).filter("m.kind IS NULL").select(
        ROW, F.col("m.value").alias("value"), F.col("m.start").alias("start"), F.col("m.end").alias("end"), F.col("m.kinds").alias("kinds")
    )
    spans = loose.join(known, "value").filter(F.array_contains("kinds", F.col("kind"))).groupBy(ROW).agg(
        F.collect_list(F.struct("start", "kind", "end")).alias("more")
    )
    base = F.transform(F.filter("mentions", lambda m: m["kind"].isNotNull()), lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    rows = table.select(ROW, "doc_id", base.alias("base")).join(spans, ROW, "left")
    counts = [_number_of(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    more = F.coalesce("more", F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return rows.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", more)).alias("spans"),
        F.size(more).cast("long").alias("found"),
    )
