from __future__ import annotations

import html
import re
import time

import pytest
from pyspark.sql import functions as F

from lakeops.llm import pages
from lakeops.llm.queries import QUERIES

from .conftest import sentence

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, text string, host int, __a int"


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, "other", 1, 2) for i, u, h in rows], SCHEMA)


def text_of(source, templates=()):
    page = pages.Page(source)
    return page.text(lambda digest: digest in templates)


@pytest.mark.parametrize(
    "source, expected",
    [
        (None, ""),
        ("", ""),
        ("  \n ", ""),
        ("plain &lt;text&gt; &amp &#233;&nbsp;x", "plain <text> & é x"),
        ("<p>One<p>Two<br>three", "One Two three"),
        ("<p>in<b>li</b>ne and <i>more</i>\n\n words</p>", "inline and more words"),
        ('<body><nav>menu</nav><article><h1>T</h1><p>a</p></article><footer>f</footer>', "T a"),
        ('<script>var t="<p>no</p>";</script><style>p{}</style><p>yes</p>', "yes"),
        ("<p>kept</p><!-- <p>not</p> --><p>too</p><!-- open <p>lost", "kept too"),
        ('<p title="a > b">x</p><p data-x=\'">\'>y</p>', "x y"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table>", "one two a b c"),
        ('<main><p>m</p><section class="comments"><p>reader</p></section></main><p>out</p>', "m"),
        ("<article><p>a</p><article>reader</article></article>", "a"),
        ('<article class="comment">reader</article><article>real</article>', "real"),
        ('<div class="cookie-notice">we use cookies</div><p>text</p><form>go <input></form>', "text"),
        ("<header>site</header><article><header><h1>T</h1></header><p>a</p></article>", "T a"),
        ("<article><p>a < b and 1<2</p><aside>side</aside></article>", "a < b and 1<2"),
        ('<p>a</p><p class="x>b</p><p>c</p>', "a b c"),
        ("<TITLE>no &amp; no</TITLE><P>Yes</P><SCRIPT>no</script >", "Yes"),
        ("</div></p>stray<div>in</div>", "stray in"),
        ("<select><option>a<option>b</select><textarea><p>no</textarea>c", "c"),
    ],
)
def test_text_of_single_pages(source, expected):
    assert text_of(source) == expected


def site(host, n, chrome, body):
    return [(i, f"http://{host}/{i}", f"<title>{host} {i}</title>{chrome}{body(i)}") for i in range(n)]


CHROME = "<div><a href='/a'>first</a> <a href='/b'>second</a></div><div>Sign here for our letters</div>"


def plain(i):
    return f"<div><p>{sentence(i, 30)}</p><p>{sentence(i + 500, 9)}</p></div><div>All rights kept</div>"


def expected_plain(i):
    return f"{sentence(i, 30)} {sentence(i + 500, 9)}"


@pytest.mark.parametrize("most_broadcast", [1_000, 0])
def test_recurring_subtrees_go_by_host(spark, most_broadcast):
    rows = site("a.example", 6, CHROME, plain) + site("b.example", 2, CHROME, plain)
    shared = "<p>This line stands in many articles</p>"
    rows += [(20 + i, "https://C.example:80/x", f"{CHROME}<article>{shared}<p>{i}</p><ul><li><a>Share</a></ul></article>") for i in range(5)]
    # Copies of one article on one host are no template of it.
    copy = f"<title>copy</title>{CHROME}<p>{sentence(77, 25)}</p>"
    rows += [(40 + i, "http://d.example/", copy.replace("letters", f"letters {i}")) for i in range(9)]
    rows += [(60, None, None), (61, "no host", ""), (None, None, "<p>no id</p>"), (62, "", "<p>x</p>"), (0, *rows[0][1:])]
    got = {}
    for r in pages.main_text(table(spark, rows), most_broadcast=most_broadcast).collect():
        assert r["n_chars"] == len(r["text"])
        got.setdefault(r["page_id"], []).append(r["text"])
    assert sum(map(len, got.values())) == len(rows)
    chrome = "first second Sign here for our letters"
    for i in range(2, 6):
        assert got[i] == [expected_plain(i)]
    # Two pages are too few to know a template by.
    assert sorted(got[0]) == sorted([expected_plain(0)] * 2 + [f"{chrome} {expected_plain(0)} All rights kept"])
    for i in range(5):
        assert got[20 + i] == [f"This line stands in many articles {i}"]
    for i in range(9):
        assert got[40 + i] == [f"{chrome} {i} {sentence(77, 25)}"]
    assert got[60] == got[61] == [""] and got[None] == ["no id"] and got[62] == ["x"]


def test_empty_table_and_schema(spark):
    result = pages.main_text(table(spark, []))
    assert result.columns == ["page_id", "url", "text", "n_chars"] and result.collect() == []


@pytest.mark.parametrize("piece", ["<p>word ", "<b>x", "</i>", "<a '", '<a ">', "<div><p>", "&amp", "<!-- ", "<"])
def test_long_pages_take_time_in_proportion(piece):
    began = time.time()
    text_of(piece * 40_000)
    assert time.time() - began < 20


def test_query_keeps_articles_whole(spark):
    source = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in QUERIES["op11_html_text"](spark, FOLDER).collect()}
    assert len(got) == source.count()
    for r in source.collect():
        article = re.search("<article>(.*)</article>", r["html"], re.S)[1].replace("<b>", "")
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub("</?(?:p|h1|br)>", " ", article)).split())


def test_templates_are_found_without_the_rules(spark, monkeypatch):
    """Counting alone finds the menus of a large host, in the given pages, and nothing of their articles."""
    monkeypatch.setattr(pages, "FURNITURE", frozenset(("head", "script", "style")))
    monkeypatch.setattr(pages, "HINTS", frozenset())
    source = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").filter(
        F.col("url").contains("//blog.tionsh.example.com/")
    )
    marks = {r["mark"] for r in pages.recurring_subtrees(source).collect()}
    rows = source.collect()
    menus = []
    for r in rows:
        page, host = pages.Page(r["html"]), pages.host_of(r["url"])
        found = [pages._mark(host, d) in marks for d in page.digest]
        menus.append(any(known and tag == "nav" for known, tag in zip(found, page.tag)))
    assert len(rows) > 300 and sum(menus) > 0.9 * len(rows)
