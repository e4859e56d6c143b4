import html
import re
import time

import pytest

from tests.llm.helpers import SF
from tripcast.llm import html_main as hm
from tripcast.llm.queries import QUERIES

PAGE = """<html><body><header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class='sidebar'><p>side text long enough, to count, as a paragraph with commas, if it were one</p></div>
<div class="post-{n} content"><h2>Title &amp; more</h2><p>First para, with words, and more words here for length.
<p>Second <b>bold</b> a < b<br>after&nbsp;break<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>
<div class="ad">Buy</div><form>f<input></form><div id="comments"><p>reader comment here, long, long, long text</p></div>
<p hidden>no</p><script>x="</p><p>no"</script><!-- no <p>no --><p>Last &#8364; <span>one</span></div><footer>&copy; foot</footer>"""
TEXT = "\n".join(["Title & more", "First para, with words, and more words here for length.", "Second bold a < b after break", "one", "two",
                  "c1", "c2", "Last € one"])


def test_extraction_of_one_page():
    page = PAGE.replace("{n}", "12")
    assert hm.vote(page)[0] == "html>body>div.content.post-#"
    assert hm.main_text(page, None) == TEXT
    assert hm.main_text(page, "html>body>div.content.post-#") == TEXT
    assert hm.main_text(page, "html>body>article") == TEXT  # the page has no such path


BODY = "<div class=main><h2>Head</h2><p>" + "Words of the page, as many as it takes. " * 5 + "</p><p>More of it.</p></div>"
BODY_TEXT = "Head\n" + " ".join(["Words of the page, as many as it takes."] * 5) + "\nMore of it."


@pytest.mark.parametrize("wrap", ["form id=aspnetForm", *(f"div class='{c}'" for c in (
    "content-sidebar-wrap", "site has-sidebar", "page-with-header", "post category-social", "elementor-widget elementor-widget-text",
    "sidebar-right", "header"))])
def test_a_wrapper_of_the_page_is_not_boilerplate(wrap):
    rest = ("<div class=sidebar><p>Side text, beside the page.</p></div><form><p>Log in</p></form>"
            "<ul class=main-nav><li><a href=x>Menu</a></ul><div class='site-footer'>foot</div><div id=comments><p>"
            + "A reader says, at length, what they think. " * 30 + "</p></div>")
    page = f"<body><{wrap}>{BODY}{rest}</{wrap.split()[0]}></body>"
    assert hm.main_text(page, None) == BODY_TEXT
    assert hm.vote(page)[0].endswith("div.main")


def test_each_widget_of_a_page_is_kept():
    page = "<body>" + "".join(f"<div class='elementor-widget post-{i} category-social'><p>Paragraph {i}, of the page, in its own box.</p></div>"
                              for i in range(4)) + "<div class='widget'><p>Not this one, which is boilerplate.</p></div></body>"
    assert hm.main_text(page, "body") == "\n".join(f"Paragraph {i}, of the page, in its own box." for i in range(4))


def test_boilerplate_beside_an_article_stays_out():
    side = "<div class=sidebar><h1>Site</h1><p>" + "Side text, longer than the article. " * 20 + "</p></div>"
    cards = "<div class=related><article><p>Card one, of others.</p></article><article><p>Card two.</p></article></div>"
    page = f"<body>{side}<article><p>Short article text of the page.</p></article>{cards}</body>"
    assert hm.main_text(page, "body") == "Short article text of the page."


LINKS = "".join(f"<a href=x{i}>A link to another page {i}</a> " for i in range(5))


@pytest.mark.parametrize("kept", [
    "<header><h1>Social</h1></header>", "<h2 id=social>Social</h2>", "<h2 id=menu>Menu</h2>", "<h3 id='Share'>Share</h3>",
    "<p class=hidden-xs>Shown on large screens</p>", "<p class='related-work'>Related work</p>", "<p class=promo>A promo</p>",
    "<aside>A pull quote</aside>", "<p aria-hidden=true>Seen by all</p>", "<section id='comments-on-law'><p>Comments on law</p></section>",
    "<p>Press <button>Start</button> <label>now</label></p>", "<section id=menu><h2>Menu</h2><p>What there is to eat</p></section>",
    "<header class='entry-header'><h1>Title</h1></header>", "<footer>Written by the author</footer>", "<div class='social-sciences'>Sciences</div>",
    "<div class=entry-footer>Filed under history</div>", "<ul id=cookies-i-like><li>Ginger</ul>", "<span class=ad>span</span>"])
def test_article_text_is_kept(kept):
    page = f"<body><nav><a href=x>Menu</a></nav><article><p>{'Words of the page, as many as it takes. ' * 5}</p>{kept}<p>More of it.</p></article></body>"
    want = " ".join(re.sub("<[^>]*>", " ", kept).split())
    lines = hm.main_text(page, "body>article").split("\n")
    assert " ".join(" ".join(lines[1:-1]).split()) == want and lines[-1] == "More of it."


@pytest.mark.parametrize("dropped", [
    "<nav><a href=x>Menu</a></nav>", f"<aside>{LINKS}</aside>", "<div class=ad>Buy</div>", "<div class='advert-box'>Buy</div>", "<form><label>Name</label></form>",
    f"<div class='social-sciences'>{LINKS}</div>", "<div id=comments><p>A reader</p></div>", "<section class='comments-area'><h2>Comments</h2><p>x</p></section>",
    "<section id=comments><h2>Comments</h2><p>A reader says</p></section>", "<div class='cookie-notice'>We use</div>", "<ul class='share-buttons'><li>Mail</ul>",
    "<div style='display: none'>x</div>", "<p hidden>x</p>", "<div role=navigation>x</div>", "<div class='newsletter signup'>x</div>", "<script>x</script>",
    "<ol class=breadcrumb><li>Home</ol>", "<div class='left-sidebar'>x</div>"])
def test_boilerplate_in_an_article_goes(dropped):
    page = f"<body><article><p>{'Words of the page, as many as it takes. ' * 5}</p>{dropped}<p>More of it.</p></article></body>"
    assert len(hm.main_text(page, "body>article").split("\n")) == 2


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<div>" * 200_000, "<div><p>x y z, a paragraph of some length</p>" * 25_000, "<div>" * 100_000 + "</b></i>" * 60_000,
    "<b>" * 100_000 + "<div></div>" * 60_000, "<div>" * 100_000 + "<li>x" * 100_000, "<a \"" * 250_000 + ">", "<a '>" * 200_001, "<" * 1_000_000,
    "<!--" * 250_000, "<ul>" * 90_000 + "<li>" * 90_000, "<p " + "a " * 500_000 + ">", "</p>" * 250_000, "<table><tr><td>" * 60_000,
    "<p " + " " * 1_000_000 + ">x", "<i a='" * 150_000, "<title>" * 140_000, "&" * 1_000_000, "<p>&amp" * 140_000])
def test_long_odd_pages_take_time_in_proportion(page):
    began = time.perf_counter()
    hm.main_text(page, "body>article")
    hm.vote(page)
    assert time.perf_counter() - began < 12  # each parses once; a MB


def test_host_consensus_outvotes_a_page(spark):
    """A page whose sidebar looks better than its short article follows its host."""
    side = "<div class=extra><p>" + "many words, in a box, beside the article, of this page. " * 6 + "</p></div>"
    odd = f"<body><article><p>Short article text of the page.</p></article>{side}</body>"
    whole = "<body><article><p>" + "Words of a long article, as usual. " * 12 + "</p></article></body>"
    assert hm.vote(odd)[0] == "body>div.extra"
    rows = [(i, "http://h.example/a", whole) for i in range(5)] + [(9, "http://H.example/b", odd), (10, "http://other.example/", odd)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for most in (32 << 20, 0):  # broadcast, salted join
        got = {r["page_id"]: r for r in hm.extract(pages, broadcast_bytes=most).collect()}
        assert got[9]["text"] == "Short article text of the page." and got[9]["path"] == "body>article"
        assert got[10]["text"].startswith("many words")


def test_edge_cases(spark):
    rows = [(1, None, None), (2, "http://a.b/", ""), (3, "no url", "just text"), (4, "http://a.b/", "<p>a<p>b"), (4, "http://a.b/", "<p>a<p>b"),
            (None, "http://a.b/", "<div>unclosed <b>x"), (6, "http://[bad", "<p>" + "w, " * 200_000), (7, "http://a.b/", "<" * 2000 + "a"),
            (8, None, "<script>only")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    got = hm.extract(pages).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars", "host", "path"}
    by = {r["page_id"]: r for r in got}
    assert by[1]["text"] == by[2]["text"] == by[8]["text"] == "" and by[3]["text"] == "just text" and by[4]["text"] == "a\nb"
    assert by[None]["text"] == "unclosed x" and by[6]["n_chars"] == 200_000 * 3 - 1
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert hm.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op9_html_main_text"](spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        h = pages[r["page_id"]]["html"]
        body = re.sub("<br>", " ", re.sub("</?b>", "", h[h.index("<article>") + 9:h.index("</article>")]))
        parts = [" ".join(html.unescape(p).split()) for p in re.split("</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(p for p in parts if p) and r["url"] == pages[r["page_id"]]["url"]
