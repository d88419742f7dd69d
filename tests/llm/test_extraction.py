"""Main text of hand-made and given pages."""

import html as html_module
import itertools
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamart.llm import extraction
from stratamart.llm.common import table

FOLDER = "/root/testdata/sf0.01"
LINE = "Some quiet words about a river that runs past the mill and on to the sea, told at length."


@pytest.fixture(scope="module")
def weights(spark):
    return extraction.train(table(spark, FOLDER, "pages"))


def page(body, head="<title>Not this</title><style>p{}</style><script>var a='<p>no</p>';</script>"):
    return f"<!DOCTYPE html><html><head><meta charset=utf-8>{head}</head><body>{body}</body></html>"


MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(12)) + "</ul></nav>"
FOOT = "<footer><p>Copyright of everybody, all rights reserved and so on.</p></footer>"
PAGES = {
    "article": (f"{MENU}<article><h1>Title</h1><p>{LINE}</p><p>{LINE}</p></article>{FOOT}", f"Title\n\n{LINE}\n\n{LINE}"),
    "no article": (f'{MENU}<div class="post"><h1>A title of words</h1><p>{LINE}</p><p>{LINE}</p></div>{FOOT}', f"A title of words\n\n{LINE}\n\n{LINE}"),
    "main": (f"<header><h2>Site</h2></header><main><p>{LINE}</p></main><aside><p>{LINE}</p></aside>", LINE),
    "inside": (
        f'<article><p>{LINE}</p><div class="ad">Buy now</div><div id="cookie-notice">We use</div><form><p>Your name</p></form>'
        f'<p>{LINE}</p><section class="comments"><p>First! {LINE}</p></section></article>',
        f"{LINE}\n\n{LINE}",
    ),
    "sidebar by class": (f'<div class="sidebar"><p>{LINE}</p><p>{LINE}</p></div><div class="content"><p>{LINE} End.</p></div>', f"{LINE} End."),
    "own header": (f"<article><header><h1>Head line</h1><p>By someone</p></header><p>{LINE}</p></article>", f"Head line\n\n{LINE}"),
    "references": (f"<article><p>a &lt; b &amp;amp; c&nbsp;&eacute;&#x41;  \n {LINE}</p></article>", f"a < b &amp; c éA {LINE}"),
    "inline": (f"<article><p>one<b>two</b> <i>three</i><br>four <a href=x>five</a> {LINE}</article>", f"onetwo three four five {LINE}"),
    "unclosed": (f"<article><p><b>First {LINE}<br><p>Second {LINE}</article>{FOOT}", f"First {LINE}\n\nSecond {LINE}"),
    "lone marks": (f"<article><p>1 < 2 and 3 > 2 </> {LINE}</p></article>", f"1 < 2 and 3 > 2 {LINE}"),
    "comment": (f"<!-- <article><p>no</p> --><article><p>{LINE}<!-- x --></p></article><!-- open", LINE),
}


@pytest.mark.parametrize("name", PAGES)
@pytest.mark.parametrize("learnt", [True, False])
def test_pages(name, learnt, weights):
    body, expected = PAGES[name]
    assert extraction.extract(page(body), weights if learnt else extraction.DEFAULT_WEIGHTS) == expected


def test_given_pages(spark, weights):
    """All given pages mark one article; its blocks start at p and h1, and br is white space."""
    pages = table(spark, FOLDER, "pages")
    got = {r.page_id: r for r in extraction.main_text(pages, weights).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.DOTALL)[1]
        article = re.sub(r'<div class="ad">.*?</div>|<!--.*?-->', "", article)
        blocks = [html_module.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?p>|</?h1>", article)]
        expected = "\n\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)
        assert got[r.page_id].text == expected
        assert (got[r.page_id].url, got[r.page_id].n_chars) == (r.url, len(expected))


def test_odd_rows(spark, weights):
    odd = [(1, None, None), (2, "u", ""), (3, "u", "   "), (4, "u", "<p>"), (5, "u", "<a href='x"), (6, "u", page("<article></article>")),
           (6, "u", page("<article></article>")), (None, "u", page(f"<article><p>{LINE}</article>")), (7, "u", page("<article>" + f"<p>{LINE}" * 20_000))]
    df = spark.createDataFrame([(*r, "x", 1) for r in odd], "page_id long, url string, html string, text string, n_chars int")
    got = sorted(((r.page_id, r.n_chars) for r in extraction.main_text(df, weights).collect()), key=repr)
    long = 20_000 * (len(LINE) + 2) - 2
    assert got == sorted([(1, 0), (2, 0), (3, 0), (4, 0), (5, 0), (6, 0), (6, 0), (None, len(LINE)), (7, long)], key=repr)
    assert extraction.main_text(df.limit(0), weights).count() == 0
    assert extraction.train(df.limit(0)) == extraction.DEFAULT_WEIGHTS


def test_deep_nesting_is_linear():
    deep = "<div><b>" * 40_000 + f"<p>{LINE}</p>"
    assert extraction.extract(page(deep), extraction.DEFAULT_WEIGHTS) == LINE


ARTICLE = f"<article><h1>Title</h1><p>{LINE}</p><p>{LINE}</p></article>"
TEXT = f"Title\n\n{LINE}\n\n{LINE}"
COMMENTS = "<section class='comments'>" + "<p>Well said, thank you all very much indeed.</p>" * 3 + "</section>"
WRAPPED = {
    "layout with a sidebar": (f'{MENU}<div class="layout has-sidebar">{ARTICLE}<div class="sidebar"><p>{LINE}</p></div></div>{FOOT}', TEXT),
    "content with comments": (f'{MENU}<div class="content with-comments">{ARTICLE}{COMMENTS}</div>{FOOT}', TEXT),
    "a form around the page": (f'<form id="aspnetForm">{MENU}<div id="page">{ARTICLE}</div>{FOOT}</form>', TEXT),
    "share prices": (f'{MENU}<article><h1>Title</h1><p class="share-price">{LINE}</p><p>{LINE}</p></article>{FOOT}', TEXT),
    "a header of the article": (f'{MENU}<article><div class="article-header"><h1>Title</h1></div><p>{LINE}</p><p>{LINE}</p></article>{FOOT}', TEXT),
    "a short main box": (
        f'{MENU}<div role="main"><p>Read on.</p></div><article class="post side-by-side"><h1>Title</h1><p>{LINE}</p><p>{LINE}</p></article>{FOOT}', TEXT),
    "cards in a sidebar": (f"{MENU}{ARTICLE}<aside><article><h3>Also</h3><p>Read this.</p></article></aside>{FOOT}", TEXT),
    "a menu without a name": (f"<ul>{'<li><a href=/x>Some item</a></li>' * 15}</ul><div><p>{LINE}</p><p>{LINE}</p></div>", f"{LINE}\n\n{LINE}"),
    "lists and links in the text": (
        f'{MENU}<article><p>{LINE}</p><ul><li>One thing</li><li>See <a href="/x">another</a></li></ul><p>{LINE}</p></article>{FOOT}',
        f"{LINE}\n\nOne thing\n\nSee another\n\n{LINE}"),
    "a short end behind adverts": (f'<article><p>{LINE}</p><div class="promo">{"<p>Buy this now.</p>" * 30}</div><p>The end.</p></article>', f"{LINE}\n\nThe end."),
}


@pytest.mark.parametrize("name", WRAPPED)
@pytest.mark.parametrize("learnt", [True, False])
def test_names_of_wrappers_are_no_verdict(name, learnt, weights):
    body, expected = WRAPPED[name]
    assert extraction.extract(page(body), weights if learnt else extraction.DEFAULT_WEIGHTS) == expected


def _texts(spark, weights):
    return [extraction.extract(r.html, weights) for r in table(spark, FOLDER, "pages").orderBy("page_id").collect()]


def test_the_scan_decides(spark, weights, monkeypatch):
    """Without it most given pages have another text; without the list of names hardly any does."""
    usual = _texts(spark, weights)
    with monkeypatch.context() as patch:
        patch.setattr(extraction, "best_region", lambda scores: (0, len(scores)))
        assert sum(a != b for a, b in zip(usual, _texts(spark, weights), strict=True)) > 0.9 * len(usual)
    with monkeypatch.context() as patch:
        patch.setattr(extraction, "NAMES", frozenset())
        learnt = extraction.train(table(spark, FOLDER, "pages"))
        assert sum(a != b for a, b in zip(usual, _texts(spark, learnt), strict=True)) < 0.05 * len(usual)


def test_names_are_learnt(spark):
    """A class that nothing is known of, on labelled pages outside the article."""
    text = "<p>Words of all kinds are here.</p>" * 5
    labelled = [(i, page(f'<div class="zorgblat"><p>{LINE}</p></div><article>{text}</article>')) for i in range(40)]
    learnt = extraction.train(spark.createDataFrame(labelled, "page_id long, html string"))
    assert learnt["name:zorgblat"] < -2
    other = page(f'<div class="post">{text}</div><div class="zorgblat"><p>{LINE}</p></div>')
    assert LINE not in extraction.extract(other, learnt)
    assert LINE in extraction.extract(other, extraction.DEFAULT_WEIGHTS)


DEEP = {
    "closed and followed by text": (f"<div><article><p>{LINE}</p>{'<div>' * 600}<p>B {LINE}</p>{'</div>' * 600}<p>C {LINE}</p></article></div>{FOOT}", f"{LINE}\n\nB {LINE}\n\nC {LINE}"),
    "advert below": (f"<article><p>{LINE}</p>{'<b>' * 600}<div class=ad>Buy now</div><form>Your name</form><p>C {LINE}</p></article>{FOOT}", f"{LINE}\n\nC {LINE}"),
    "own header below": (f"<article>{'<div>' * 600}<header><h1>Head line</h1><p>By someone</p></header>{'</div>' * 600}<p>{LINE}</p></article>", f"Head line\n\n{LINE}"),
}


@pytest.mark.parametrize("name", DEEP)
def test_deep_nesting_is_read_whole(name):
    body, expected = DEEP[name]
    assert extraction.extract(page(body), extraction.DEFAULT_WEIGHTS) == expected


def test_words_at_every_depth_are_linear():
    deep = "<article>" + "<div>note <b>" * 30_000 + "</b></div>" * 30_000 + f"<p>{LINE}</p></article>"
    got = extraction.extract(page(deep), extraction.DEFAULT_WEIGHTS | {"div": -0.01, "/div": -0.01, "/b": -0.01})
    assert got == "note\n\n" * 30_000 + LINE


@given(st.lists(st.integers(-5, 5).map(float), max_size=30))
def test_region_has_the_greatest_sum(scores):
    start, end = extraction.best_region(scores)
    best = max([0.0, *(sum(scores[a:b]) for a, b in itertools.combinations(range(len(scores) + 1), 2))])
    assert sum(scores[start:end]) == best


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<a href='", '"', ">", "<", "<!--", "-->", "<script>", "</script", "text", "&amp", "</", "<td>", "</table>", "\0"]), max_size=40))
def test_any_markup_is_survived(parts):
    extraction.extract("".join(parts), extraction.DEFAULT_WEIGHTS)
