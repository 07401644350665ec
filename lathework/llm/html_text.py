"""Main text of a web page by the maximum-scoring subsequence.

A page is a row of words and tags. Words score for the article and tags against it, with
weights that are log odds counted over labelled pages: pages that mark their article by an
``article`` or ``main`` element. One linear scan finds the contiguous region with the largest
sum. Elements that are never part of an article are left out of the region's text.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.llm.common import narrow

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li link main menu meta nav "
    "noframes noscript ol optgroup option p pre section select summary table tbody td template textarea tfoot th thead "
    "title tr ul video audio canvas object".split()
)
RAW = frozenset("script style textarea title noframes noembed iframe xmp".split())
# Elements that are never part of an article, whatever they hold.
NEVER = frozenset(
    "head title script style noscript template nav footer button select option textarea input label iframe noframes object svg "
    "canvas menu audio video noembed".split()
)
# Elements, roles and names that are not part of an article, unless they hold the page.
OUTSIDE = frozenset("aside form fieldset dialog".split())
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar alert".split())
# Names of elements that are not part of an article, by the word that a name is about.
OUTSIDE_NAMES = re.compile(
    r"ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|nav[A-Z]\w*|menu\w*|breadcrumb\w*|sidebar\w*|footer\w*|"
    r"masthead|topbar|toolbar|comment|comments|commentlist|respond|disqus\w*|replies|reply|cookie\w*|consent\w*|notice\w*|gdpr|popup\w*|"
    r"modal\w*|overlay\w*|newsletter\w*|subscri\w*|signup|login|search\w*|share\w*|sharing|social\w*|related\w*|recommend\w*|widget\w*|"
    r"pagination|pager|paging|tagcloud|copyright|disclaimer|side-bar|site-header|page-header|skip-link", re.I
)
# Words that say so only where they are the whole name, or follow one of the prefixes.
STATES = frozenset("hidden alert tags".split())
PREFIXES = frozenset("is js u visually".split())
# A name behind one of these says what a layout has or lacks, not what the element is.
MODIFIERS = frozenset("with without no has have".split())
# Words at the end of a name that say no more than that it is some part of the page.
PLAIN = frozenset(
    "area bar bars block body bottom box btn button buttons card cards close col column container content count cta desktop entries "
    "entry footer form group header heading holder icon icons image inner item items label law layout leaderboard left link links list "
    "lists main message mobile module news outer panel placeholder policy post posts primary products reading rectangle region results right "
    "row secondary section skyscraper slot stories story text title toggle top topics trail unit videos wrap wrapper zone articles".split()
)
COMMENTS = frozenset("comment comments commentlist respond replies reply".split())
ARTICLE = frozenset(("article", "main"))

# A tag whose quotes, if any, are those of values; all others are read by ``_tag_end``.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>"'=]++|=\s*+(?:"[^"<>]*+"|'[^'<>]*+')?)*+)>""")
BEGIN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
TAG_STOP = re.compile(r"""=\s*+(["'])|>""")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACES = re.compile(r"\s+")
LEAST, MOST = 0.2, 4.0  # bounds of a weight
MARKED = 2.0  # by how much an article mark raises a word's score and lowers a tag's cost
DEFAULTS = {"word": 1.0, "link": 0.2, "tag": -3.25, "item": -0.2}
# Parts of lists and tables: what they cost depends on whether they hold links or words.
ITEMS = frozenset("ul ol li dl dt dd table tbody thead tfoot tr td th".split())
LISTS = frozenset("li ul ol menu".split())


class Matches:
    """The elements of a page that look like none of an article's, as a tree in page order.

    Number 0 is the page. ``words`` are those of an element's own places first, and with all
    that is below it after ``outside``. Elements of ``NEVER`` and their words do not count.
    """

    def __init__(self):
        self.parent, self.kind, self.words, self.heading = [0], ["page"], [0], [False]

    def add(self, parent: int, kind: str) -> int:
        self.parent.append(parent)
        self.kind.append("never" if self.kind[parent] == "never" else kind)
        self.words.append(0)
        self.heading.append(False)
        return len(self.parent) - 1

    def outside(self) -> list[bool]:
        """For each match whether its places are outside; not so for those that hold the page.

        A match holds the page if it has more than half of the words, and a main heading or ten
        times the words that are left beside all matches. Comments hold it if no words are left.
        """
        below = [[] for _ in self.parent]
        beside = self.words[:]  # words that are in an element, but in no match below it
        for i in range(len(self.parent) - 1, 0, -1):
            if self.kind[i] == "never":
                self.words[i] = 0
                continue
            below[self.parent[i]].append(i)
            self.words[self.parent[i]] += self.words[i]
            self.heading[self.parent[i]] |= self.heading[i]
        out = [True] * len(self.parent)
        out[0], at, left = False, 0, beside[0]
        while True:
            at = next((i for i in below[at] if 2 * self.words[i] > self.words[0]), None)
            if at is None:
                return out
            few = left == 0 if self.kind[at] == "comments" else self.heading[at] or 10 * left < self.words[at]
            if not few:
                return out
            out[at] = False
            left += beside[at]


def pieces(html: str) -> list:
    """The page as ``(kind, value, outside, article, link)`` in order.

    ``kind`` is ``text``, ``open`` or ``close``. ``outside`` says that the place is within an
    element that no article holds, ``article`` that it is within an article element.
    """
    matches = Matches()
    found = list(_pieces(html, matches))
    outside = matches.outside()
    return [(kind, value, outside[match], article, link) for kind, value, match, article, link in found]


class Open:
    """The open elements, with the places of each name, so that no search walks over all of them."""

    def __init__(self):
        self.stack: list = []  # (name, match, article, link), the last three of the place before it
        self.places = defaultdict(list)  # by name; "*block" and "*list" have those of a kind

    def _kinds(self, name: str) -> list[str]:
        return [name] + ["*block"] * (name in BLOCK) + ["*list"] * (name in LISTS)

    def push(self, name: str, place: tuple) -> None:
        for kind in self._kinds(name):
            self.places[kind].append(len(self.stack))
        self.stack.append((name, *place))

    def last(self, kind: str) -> int | None:
        """The place of the innermost element of a name or kind."""
        return self.places[kind][-1] if self.places.get(kind) else None

    def cut(self, depth: int) -> tuple:
        """Close all from ``depth`` on; what holds behind them."""
        place = self.stack[depth][1:]
        while len(self.stack) > depth:
            for kind in self._kinds(self.stack.pop()[0]):
                self.places[kind].pop()
        return place


def _tag_end(html: str, at: int, last: dict) -> tuple[int, int]:
    """End of a tag's attributes, and of the tag, that begin at ``at``; the page's end if it has none.

    A quote counts behind ``=`` only. One that is never closed, or whose value holds a ``>`` and
    ends right before another word, was left open: such a tag ends at the first ``>``. ``last``
    has the last place of each quote, so that no quote is looked for in vain; a page is read once.
    """
    while True:
        m = TAG_STOP.search(html, at)
        if m is None:
            return len(html), len(html)
        if m.group(1) is None:
            return m.start(), m.end()
        quote, begin = m.group(1), m.end()
        end = html.find(quote, begin) if last[quote] >= begin else -1
        if end < 0 or ">" in html[begin:end] and html[end + 1:end + 2].strip() not in ("", "/", ">"):
            end = html.find(">", begin)
            return (end, end + 1) if end >= 0 else (len(html), len(html))
        at = end + 1


def tokens(html: str):
    """Texts as ``(text, None, None)`` and tags as ``(slash, name, attributes)``; comments are passed over.

    The reader of the tokens sends a name to have all up to that element's end passed over.
    Each place is read a fixed number of times, whatever is open or broken.
    """
    last = {q: html.rfind(q) for q in "\"'"}
    text, at = 0, html.find("<")
    while at >= 0:
        m, after = TAG.match(html, at), 0
        if m:
            tag, after = m.groups(), m.end()
        elif m := BEGIN.match(html, at):
            end, after = _tag_end(html, m.end(), last)
            tag = (m.group(1), m.group(2), html[m.end():end])
        elif html.startswith(("<!", "<?", "</"), at):
            tag = None
            if html.startswith(("<!-->", "<!--->"), at):
                after = html.index(">", at) + 1
            else:
                mark = "-->" if html.startswith("<!--", at) else ">"
                end = html.find(mark, at + 4 if mark == "-->" else at + 2)
                after = end + len(mark) if end >= 0 else len(html)
        if not after:  # a lone sign is text
            at = html.find("<", at + 1)
            continue
        if at > text:
            yield html[text:at], None, None
        if tag:
            raw = yield tag
            if raw:
                end = re.compile(rf"</{raw}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I).search(html, after)
                after = end.end() if end else len(html)
                yield  # what ``send`` gives back
        text, at = after, html.find("<", after)
    if text < len(html):
        yield html[text:], None, None


def _pieces(html: str, matches: Matches):
    """The pieces, with the number of the innermost match in place of ``outside``."""
    opened = Open()
    match, article, link = 0, False, False
    stream = tokens(html)
    for slash, name, attributes in stream:
        if name is None:
            matches.words[match] += len(slash.split())
            yield "text", slash, match, article, link
            continue
        name = name.lower()
        if slash:
            depth = opened.last(name)
            if depth is not None and not (name == "p" and opened.last("*block") != depth):
                match, article, link = opened.cut(depth)
            yield "close", name, match, article, link
            continue
        if name in BLOCK and name != "br" and opened.stack and opened.stack[-1][0] == "p":
            match, article, link = opened.cut(len(opened.stack) - 1)  # a block ends a paragraph
        if name == "li":  # an item ends the item before it
            depth = opened.last("*list")
            if depth is not None and opened.stack[depth][0] == "li":
                match, article, link = opened.cut(depth)
        leaves = _leaves(name, attributes, article)
        now = matches.add(match, leaves) if leaves else match
        if name in ("h1", "main"):
            matches.heading[match] = True
        if name in RAW:
            stream.send(name)
            yield "open", name, now, article, link
            continue
        if name not in VOID and not attributes.rstrip().endswith("/"):
            opened.push(name, (match, article, link))
            match, link, article = now, link or name == "a", article or name in ARTICLE
        yield "open", name, match if name not in VOID else now, article, link


def named(value: str) -> str:
    """What a class or id says: ``match`` for no part of an article, ``comments``, or nothing.

    A name counts by the word that it is about: ``nav-links`` is navigation, as links are any
    part of a page, but neither ``related-work`` nor ``overflow-hidden`` leave the article.
    """
    for name in value.split():
        words = [w for w in re.split("[-_]+", name) if w]
        words = words[:next((i for i, w in enumerate(words) if w.lower() in MODIFIERS and i + 1 < len(words)), len(words))]
        if not words:
            continue
        if words[0].lower() == "comment":
            return "comments"
        if words[-1].lower() in STATES and all(w.lower() in PREFIXES for w in words[:-1]):
            return "match"
        while words:
            if OUTSIDE_NAMES.fullmatch(words[-1]) or OUTSIDE_NAMES.fullmatch("-".join(words[-2:])):
                return "comments" if words[-1].lower() in COMMENTS or words[-1].lower().startswith("disqus") else "match"
            if words[-1].lower() not in PLAIN and not words[-1][0].isdigit():
                break
            words.pop()
    return ""


def _leaves(name: str, attributes: str, article: bool) -> str:
    """What begins here that is no part of an article: ``never``, ``match``, ``comments`` or nothing."""
    if name in NEVER:
        return "never"
    if name in OUTSIDE or name == "header" and not article:
        return "match"
    if name in ("html", "body") or name in ARTICLE or not attributes.strip():
        return ""
    for m in ATTRIBUTE.finditer(attributes):
        key = m.group(1).lower()
        value = m.group(2) or m.group(3) or m.group(4) or ""
        if key in ("class", "id") and (found := named(value)):
            return found
        if key == "role" and value.lower() in OUTSIDE_ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "match"
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return "match"
    return ""


def kind_of(kind: str, value: str, link: bool) -> str:
    """The name whose weight a piece has."""
    if kind == "text":
        return "link" if link else "word"
    return value if value in BLOCK or value in VOID or value in ("a", "b", "i", "em", "strong", "span", "u", "small", "img", "code") else "other"


def kinds_of(found: list) -> list[str]:
    """``kind_of`` each piece; parts of lists and tables whose words are no link are an ``item``."""
    names = [kind_of(kind, value, link) for kind, value, _, _, link in found]
    for step, side in ((-1, "open"), (1, "close")):  # the next words of a begin, the last ones of an end
        linked = False
        for i in range(len(found))[::step]:
            kind, value, _, _, link = found[i]
            if kind == "text":
                linked = link if value.strip() else linked
            elif kind == side and value in ITEMS and not linked:
                names[i] = "item"
    return names


def learned(pages: DataFrame) -> dict:
    """Weights from the pages that mark their article: log odds of being inside it.

    Counts are summed within tasks first; names of elements are a fixed list, so the result
    is as small for any number of pages.
    """

    def run(batches):
        inside, all_of = defaultdict(int), defaultdict(int)
        for batch in batches:
            for html in batch.column("html").to_pylist():
                if "<article" not in html.lower() and "<main" not in html.lower():
                    continue
                found = pieces(html)
                for (kind, value, outside, article, _), name in zip(found, kinds_of(found)):
                    n = len(value.split()) if kind == "text" else 1
                    if name == "item" and outside:
                        continue  # lists of menus say nothing of lists in a text
                    all_of[name] += n
                    if article and not outside:
                        inside[name] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(all_of), pa.string()), pa.array([inside[k] for k in all_of], pa.int64()), pa.array(list(all_of.values()), pa.int64())],
            names=["name", "inside", "total"],
        )

    counts = pages.select("html").mapInArrow(run, "name string, inside long, total long").groupBy("name").agg(
        F.sum("inside").alias("inside"), F.sum("total").alias("total")
    )
    rows = counts.collect()  # one row for each name of a fixed list
    words = sum(r["total"] for r in rows if r["name"] in ("word", "link"))
    tags = sum(r["total"] for r in rows) - words
    out = dict(DEFAULTS)
    if not words or not tags:
        return out
    # how many words go to a tag in an article: a tag must not cost more than the words it has
    inside_tags = sum(r["inside"] for r in rows if r["name"] not in ("word", "link"))
    inside_words = sum(r["inside"] for r in rows if r["name"] in ("word", "link"))
    density = max(1.0, inside_words / max(1, inside_tags))
    for r in rows:
        odds = log((r["inside"] + 0.5) / (r["total"] - r["inside"] + 0.5))
        if r["name"] in ("word", "link"):
            out[r["name"]] = max(LEAST, min(MOST, odds)) if odds > 0 else -LEAST
        else:
            out[r["name"]] = -max(LEAST, min(MOST, density / 4 - odds))
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous stretch with the largest sum; the first of equals."""
    best, begin, end, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, begin, end = total, start, i + 1
    return begin, end


def main_text(html: str, weights: dict) -> str:
    """The article of a page: blocks joined by one blank.

    The scan alone finds the region. An article mark adds to the scores of words and takes from
    the cost of tags within it, by the fixed factor ``MARKED``; no text of the region is dropped
    for being outside of a mark. What is outside is not part of the text whatever its length, so
    it costs no more than its own two tags.
    """
    found = pieces(html)
    weights = DEFAULTS | weights
    scores, before = [], False
    for (kind, value, outside, article, _), name in zip(found, kinds_of(found)):
        if kind == "text":
            score = 0.0 if outside else len(value.split()) * weights[name]
        else:
            score = 0.0 if outside and before else weights.get(name, weights["tag"])
        before = outside
        if article and not outside:
            score = score * MARKED if score > 0 else score / MARKED
        scores.append(score)
    begin, end = best_region(scores)
    if begin == end:
        begin, end = _any_text(found)
    begin = _heading_before(found, begin)
    blocks, part = [], []
    for kind, value, outside, _, _ in found[begin:end]:
        if kind == "text":
            if not outside:
                part.append(value)
        elif value in BLOCK:
            blocks.append("".join(part))
            part = []
    blocks.append("".join(part))
    clean = (SPACES.sub(" ", unescape(b)).strip() for b in blocks)
    return " ".join(b for b in clean if b)


def _any_text(found) -> tuple[int, int]:
    """All that is not outside, for a page whose few words do not outweigh any tag."""
    own = [i for i, p in enumerate(found) if p[0] == "text" and not p[2] and p[1].strip()]
    return (own[0], own[-1] + 1) if own else (0, 0)


def _heading_before(found, begin: int) -> int:
    """The begin of a heading whose text is the last one before the region."""
    i, absent = begin - 1, set()
    while i >= 0 and not (found[i][0] == "text" and found[i][1].strip()):
        if found[i][0] == "close" and found[i][1] in {"h1", "h2"} - absent:
            for j in range(i - 1, -1, -1):
                if found[j][0] == "open" and found[j][1] == found[i][1]:
                    return begin if found[j][2] else j
            absent.add(found[i][1])
        i -= 1
    return begin


def extract(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    A null or empty page, or one without an article, has an empty text. Repeated rows are
    extracted one by one. Without labelled pages the weights are fixed defaults. An empty
    table gives an empty table. Other columns are not read.
    """
    rows = narrow(pages, page_id=c(page_id), url=c(url), html=F.coalesce(c(html).cast("string"), F.lit("")))
    weights = learned(rows)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = pa.array([main_text(x, weights) if x else "" for x in part.column("html").to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], names=["page_id", "url", "text"])

    kind = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in ("page_id", "url"))
    return rows.mapInArrow(run, f"{kind}, text string").withColumn("n_chars", F.char_length("text").cast("long"))
