"""Main text of pages: markup, differences of neighbours, edge pages."""

from __future__ import annotations

import html
import random
import re

import pytest

from flowgauge.llm import page_differencing as P
from flowgauge.llm.entry import QUERIES


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "t") for i, u, h in rows], "page_id long, url string, html string, at int, text string")


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in P.extract(pages_of(spark, rows)).collect()}


def alone(page):
    return P.main_text(P.page_lines(page), set())


def test_query(spark, sf_dir):
    rows = QUERIES["op3_page_differencing"].run(spark, sf_dir).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]]["html"], re.S)[1]
        blocks = [html.unescape(re.sub("</?b>", "", b)) for b in re.split("</?(?:p|h1)>|<br>", article)]
        lines = [" ".join(b.split()) for b in blocks]
        assert r["text"] == "\n".join(x for x in lines if x) and r["n_chars"] == len(r["text"])
        assert r["url"] == pages[r["page_id"]]["url"]


def test_lines_shared_with_the_nearest_page_go(spark):
    def page(body):
        return f"<html><body><div>Our site</div><div>{body}</div><div>Terms of use</div></body></html>"

    rows = [
        (1, "http://a.org/x/1", page("first story")), (2, "http://a.org/x/2", page("second story")),
        (3, "http://b.org/x/1", page("elsewhere")), (4, "http://c.org/1", page("copy")), (5, "http://c.org/1", page("copy")),
    ]
    whole = "Our site\n{}\nTerms of use"
    assert texts(spark, rows) == {
        1: "first story", 2: "second story", 3: whole.format("elsewhere"), 4: whole.format("copy"), 5: whole.format("copy"),
    }


def test_paragraphs_of_an_article_stay_though_shared(spark):
    def page(own):
        return f"<nav>menu {own}</nav><article><h1>{own}</h1><p>Said by all.</p><div>Follow us</div></article><footer>f</footer>"

    rows = [(1, "http://a.org/x/1", page("one")), (2, "http://a.org/x/2", page("two"))]
    assert texts(spark, rows) == {1: "one\nSaid by all.", 2: "two\nSaid by all."}


def test_edges(spark):
    rows = [
        (1, None, None), (2, "http://a.org/1", None), (3, "http://a.org/2", ""), (None, "http://a.org/3", "<p>a"), (5, "no address", "<p>b</p>"),
        (6, "", "plain text"), (7, "http://a.org/9", "<p>" + "long " * 50_000), (7, "http://a.org/9", "<p>" + "long " * 50_000),
    ]
    found = P.extract(pages_of(spark, rows)).collect()
    wanted = [(1, ""), (2, ""), (3, ""), (-1, "a"), (5, "b"), (6, "plain text"), (7, ("long " * 50_000).strip()), (7, ("long " * 50_000).strip())]
    assert sorted((r["page_id"] if r["page_id"] is not None else -1, r["text"]) for r in found) == sorted(wanted)
    assert P.extract(pages_of(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body>a &amp; b&nbsp;&lt;i&gt; &#65;&#x42; &amp c</body>", "a & b <i> AB & c"),
        ("<p>one<p>two<br>three<ul><li>x<li>y</ul>", "one\ntwo three\nx\ny"),
        ("<script>if (a<b) document.write('<p>no</p>')</script><style>p{}</style><p>yes", "yes"),
        ("<!-- <p>no</p> --><p title='a>b'>yes</p><!DOCTYPE html>", "yes"),
        ("<article><p>a</p><form><p>no</p><input></form><aside>no</aside><section class='comments'><p>no</p></section></article>x", "a"),
        ("<main><div id='cookie-notice'>no</div><header><h1>T</h1></header><p>a</p><footer>no</footer></main>", "T\na"),
        ("<div class='content no-sidebar'><p>a</p></div><div class='sidebar1'>no</div><div class='adBox'>no</div>", "a"),
        ("<p>reader<b>ship</b> and load, addition</p><div class='shadow header-free'>b</div>", "readership and load, addition\n"),
        ("<div role='navigation'>no</div><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>a", "a"),
        ("<p><b>open <i>tags<p>next</p></article>", "open tags\nnext"),
        ("<table><tr><td>a<td>b<tr><td>c</table><pre> x\n  y </pre>", "a\nb\nc\nx y"),
        ("text <", "text <"),
        ("<p>un&am; &quo</p><nav>never closed <p>no", "un&am; &quo"),
    ],
)
def test_markup(page, text):
    assert alone(page) == text.rstrip("\n")


def test_longest_common_lines():
    draw = random.Random(2)
    for _ in range(500):
        a = [draw.randint(0, 4) for _ in range(draw.randint(0, 9))]
        b = [draw.randint(0, 4) for _ in range(draw.randint(0, 9))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = P.common_lines(a, b)
        rest = iter(b)
        assert len(found) == best[-1][-1] and found == sorted(set(found)) and all(a[i] in rest for i in found)
