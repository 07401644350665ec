"""Broken pages, side parts and names that must not cost an article any of its text."""

import time

import pytest

from lathework.llm import html_text
from tests.llm.test_whole import WEIGHTS, words

BOTH = pytest.mark.parametrize("weights", [WEIGHTS, html_text.DEFAULTS])
BODY = f"<h1>Title here</h1><p>{words('a', 60)}</p>"
TEXT = f"Title here {words('a', 60)}"


def page(inner, begin="<article>", end="</article>"):
    return f"<html><body>{begin}{inner}{end}</body></html>"


@BOTH
@pytest.mark.parametrize("before", [
    "<script>var a='<!--';</script>", "<script>if (i<n) don't(\"</p>\");</script>", "<style>a:after{content:'<x \"'}</style>",
    "<SCRIPT>x</script >", "<!-- <p>x</p> -->", "<!-->", "<!--->", "<?php x ?>", "</ >", "<script/>var b='<p>';</script>",
])
def test_raw_text_and_comments_hide_no_markup(before, weights):
    assert html_text.main_text(page(before + BODY), weights) == TEXT
    assert html_text.main_text(before + page(BODY), weights) == TEXT


@BOTH
@pytest.mark.parametrize("tag", [
    '<p title="x>', "<p title='x>", '<p title="a > b">', "<p title='it\"s' class=\"b\">", "<p don't>", '<p title="x"class="y">', "<p title = 'a>b' >",
    '<p title=">', "<p a=b=c>", '<p title="">',
])
def test_open_and_odd_quotes_end_with_their_tag(tag, weights):
    rest = '<p class="z">last "quoted" words of the page</p>'
    got = html_text.main_text(page(f"{BODY}{tag}some more words</p>{rest}"), weights)
    assert got == f'{TEXT} some more words last "quoted" words of the page'


def test_lone_signs_are_text():
    assert html_text.main_text(page("<p>a < b and c > d, 1 <2 <3</p>"), WEIGHTS) == "a < b and c > d, 1 <2 <3"
    assert html_text.main_text("<article><p>one two three four five<b", WEIGHTS) == "one two three four five"


@BOTH
def test_a_long_side_part_costs_nothing_behind_it(weights):
    aside = f"<aside><ul>{'<li>x y</li>' * 40}</ul>{words('s', 300)}</aside>"
    assert html_text.main_text(page(f"{BODY}{aside}<p>{words('b', 10)}</p>"), weights) == f"{TEXT} {words('b', 10)}"
    plain = page(f"{BODY}{aside}<p>{words('b', 30)}</p>", "<div>", "</div>")
    assert html_text.main_text(plain, weights) == f"{TEXT} {words('b', 30)}"


@BOTH
@pytest.mark.parametrize("items, end", [
    ("<ul>{}</ul>", "<li>one two three</li>"), ("<ol>{}</ol>", "<li>one two"), ("<table>{}</table>", "<tr><td>one</td><td>two</td></tr>"),
    ("<dl>{}</dl>", "<dt>one<dd>two words"),
])
def test_a_list_in_an_unmarked_text_does_not_end_it(items, end, weights):
    inner = f"{BODY}{items.format(end * 25)}<p>{words('b', 30)}</p>"
    got = html_text.main_text(page(inner, "<div>", "</div>"), weights)
    assert got.startswith(TEXT) and got.endswith(words("b", 30)) and got.count("one") == 25


@BOTH
def test_lists_of_links_stay_outside(weights):
    links = "<ul>" + "".join(f"<li><a href='/{i}'>go there</a></li>" for i in range(25)) + "</ul>"
    assert html_text.main_text(page(f"{links}<div>{BODY}</div>{links}", "<div>", "</div>"), weights) == TEXT


@pytest.mark.parametrize("name", [
    "overflow-hidden", "related-work", "search-engine-history", "cookie-recipes", "ad-hoc", "share_price", "page no-sidebar", "alert-fatigue",
])
def test_names_about_something_else_keep_the_text(name):
    got = html_text.main_text(page(f"{BODY}<div class='{name}'><p>{words('b', 20)}</p></div>"), WEIGHTS)
    assert got == f"{TEXT} {words('b', 20)}" and html_text.named(name) == ""


@pytest.mark.parametrize("name", [
    "hidden", "is-hidden", "related-posts", "ad", "ad-slot-2", "nav-links", "sidebar-content", "post-comments", "comment-body", "cookie-banner",
    "newsletter_signup_form", "relatedPosts", "share-buttons", "skip-link", "site-header", "main side-bar", "footer", "menu-item-12",
])
def test_names_of_side_parts(name):
    assert html_text.named(name)
    assert html_text.main_text(page(f"{BODY}<div class='{name}'><p>{words('b', 20)}</p></div>"), WEIGHTS) == TEXT


@pytest.mark.parametrize("broken", [
    "<x " * 400_000, '<x <x "' * 150_000, "if a <b then c " * 60_000 + '"', "<x a='>" * 100_000 + '<x a=">' * 100_000, "<!--" * 300_000,
    "<p><i><div>" + "<i>" * 100_000 + "</p>" * 100_000, "<div>" * 100_000 + "</span>" * 100_000, "</h1>" * 150_000 + "<p>" + "w " * 50,
    "<script>" * 150_000, "<li>" * 150_000, "<x =" + " " * 1_000_000,
])
def test_broken_pages_take_linear_time(broken):
    begin = time.monotonic()
    html_text.main_text(broken, WEIGHTS)
    assert time.monotonic() - begin < 20
