"""Main text of pages: boilerplate goes, article text stays in order."""

import html
import re
import time

import pyarrow.parquet as pq
import pytest

from orderflow.llm.html_text import extract_main_text, main_text

PAGE = (
    '<html><head><title>x</title></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div id="main">'
    '<div class="sidebar">side, bar, text, long, enough</div><div class="content"><h1>T &amp; t</h1><p>Para one, with, commas &nbsp; and length.'
    '<p>Para two is here, ok<div class="cookie-notice">cookies, are, used</div><blockquote>Quote</blockquote><ul><li>one<li>two</ul></div>'
    '<div id="comments"><p>Great post, thanks, all, of, you</p></div></div><form><input><p>sub,scribe</p></form><footer>foot</footer>'
)


def test_boilerplate_goes():
    assert main_text(PAGE) == "T & t\nPara one, with, commas and length.\nPara two is here, ok\nQuote\none\ntwo"


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        (None, ""),
        ("plain text, no tags", "plain text, no tags"),
        ("<p>a<p>b", "a\nb"),
        ("<div><span>x</span> y</div>", "x y"),
        ("<p title='unclosed>text", "text"),
        ("</p></div>x", "x"),
        ("<p>a<br>b</p><script>if (1 < 2) '</p>'</script><!-- <p>c</p> --><p>d", "a b\nd"),
        ("<nav>only, menus</nav>", ""),
        ("<p>&lt;b&gt; &#65;&eacute;&unknown;", "<b> Aé&unknown;"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_every_article_of_the_table():
    block = re.compile(r"</?(?:p|h1)\b[^>]*>")
    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist():
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in block.split(article))
        assert main_text(page) == "\n".join(p for p in parts if p)


def test_odd_rows(spark):
    rows = [(1, "u", None, 1), (1, None, "", 2), (None, "v", PAGE, 3), (2, "w", "<p>" + "x, " * 100_000, 4)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert sorted(((r.page_id or 0), r.n_chars) for r in got.collect()) == [(0, len(main_text(PAGE))), (1, 0), (1, 0), (2, 299_999)]
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


LONG = "A paragraph of the article that is long enough, has commas, and says what the page is about in so many words."


@pytest.mark.parametrize(
    "page",
    [
        f'<article style="overflow:hidden" data-hidden="false" title="hidden gems"><p>{LONG}</article>',
        f'<p>{LONG[:50]}<a href="/hidden-valley">{LONG[50:]}</a>',
        f'<p>{LONG[:50]}<a href="/p?id=ad" data-class="nav">{LONG[50:]}</a>',
        f'<p>{LONG[:50]}<span class="ad-hoc">{LONG[50:]}</span>',
        f'<div class="has-sidebar"><div><p>{LONG}</div><div class="sidebar"><p>side</div></div>',
        f'<div class="banner"><article><p>{LONG}</article></div><div class="ad"><p>{LONG[:60]}</div>',
        f'<div class=hidden-valley aria-hidden=false><p>{LONG}</div>',
    ],
)
def test_words_inside_attributes_do_not_decide(page):
    assert main_text(page) == LONG


def test_sections_and_headings_named_by_their_subject():
    page = f'<article><p>{LONG}<h2 id="related-work">Related work</h2><p>Short.<section id="social-impact"><h3 id="comments">On comments</h3><p>Jobs</section></article>'
    assert main_text(page) == f"{LONG}\nRelated work\nShort.\nOn comments\nJobs"


@pytest.mark.parametrize(
    "extra",
    [
        f"<div hidden><p>{LONG}</div>",
        f"<div HIDDEN=''><p>{LONG}</div>",
        f"<div aria-hidden=true><p>{LONG}</div>",
        f"<div role='navigation'><p>{LONG}</div>",
        f"<div id=ad-slot-3><p>{LONG}</div>",
        f"<div class='x siteSidebar'><p>{LONG}</div>",
        f"<div id=comments>{f'<p>{LONG}' * 9}</div>",
        f"<div class='acme-related'><a href=/x>{LONG}</a></div>",
    ],
)
def test_marked_parts_still_go(extra):
    assert main_text(f"<div><p>{LONG}<p>{LONG}{extra}</div>") == f"{LONG}\n{LONG}"


def test_sections_without_article():
    part = "Words of a section, with two commas, " + "and more " * 12 + "to its end."  # about 150 characters
    many, two = "\n".join(f"{i} {part}" for i in range(7)), f"x {part}\ny {part}"
    as_paragraphs = lambda text: "".join(f"<p>{line}" for line in text.split("\n"))
    first, second = as_paragraphs(many), as_paragraphs(two)
    want = f"{many}\n{two}"
    assert main_text(f"<div><div>{first}</div><div>{second}</div></div>") == want
    assert main_text(f"<div><div>{second}</div><div>{first}</div></div>") == f"{two}\n{many}"
    assert main_text(f"<div><div>{second}</div><div>{second}</div></div>") == f"{two}\n{two}"  # equal sections
    nested = f"<section><div>{first}</div></section><section><h2>Next</h2><div>{second}<ul><li>one<li>two</ul></div></section>"
    assert main_text(f"<div>{nested}</div>") == f"{want[: len(many)]}\nNext\n{two}\none\ntwo"
    menu, ad = "<div><a href=/a>Home, sweet</a> <a href=/b>About, all, of, us</a></div>", f'<div class="ad">{second}</div>'
    assert main_text(f"<div>{menu}<div>{first}</div>{ad}<div>{second}</div>{menu}</div>") == want
    assert main_text(f"<div><div>{first}</div><div><a href=/c>{part}</a>{second}</div></div>") == want
    assert main_text(f"<div>{menu}<article>{first}</article></div><div>{second}</div>") == many


@pytest.mark.parametrize(
    "page, text",
    [
        ("See <span class='share'>the share</span> of votes.", "See the share of votes."),
        ("The <span class='ad'>ad</span> market grew.", "The ad market grew."),
        ("Kept <del hidden>gone</del> end", "Kept end"),
        (f"<p class=byline>By A. Writer, staff.</p><p>{LONG}", f"By A. Writer, staff.\n{LONG}"),
        (f"<p>{LONG}</p><div class='widget'><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
        (f"<div><span class=ad>Buy <b>now</b></span></div><p>{LONG}", LONG),
        (f"<p>{LONG}</p><x-slot class='advert'>Buy</x-slot><p>{LONG}", f"{LONG}\n{LONG}"),
    ],
)
def test_marks_inside_a_line(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, chars",
    [
        ("<div><p>text, here</p>" * 20_000, 20_000 * 11 - 1),
        ("x<b>" * 50_000, 50_000),
        ("<div class=ad>x" * 30_000, 0),
        ("<div>" * 100_000 + "text, here", 10),
        ("<p><i>a</i></b></q>" * 20_000, 39_999),
    ],
)
def test_time_does_not_grow_with_depth(page, chars):
    begun = time.monotonic()
    assert len(main_text(page)) == chars
    assert time.monotonic() - begun < 15
