import random

import pytest
from conftest_llm import rows_of
from pyspark.sql import functions as F

from blotter.llm import html
from blotter.llm.common import table
from blotter.llm.queries import QUERIES

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='</p>';</script></head><body>"
    "<header>Site head</header><nav><ul><li><a href='/x'>menu</a></li></ul></nav><div class=\"ad\">Buy</div>{}"
    "<div class='cookie-notice'>We use cookies</div><aside>side</aside><form><p>Name</p></form>"
    "<section id=comments><p>first!</p></section><footer>&copy; host</footer></body></html>"
)


def test_regions_references_and_white_space():
    body = "<article><h1>Head &amp; line</h1><p>One\n <b>two</b>  th<i>ree</i>&nbsp;x<br>four<p>Five &lt;six&gt; &#233;</article>"
    found = html.lines(PAGE.format(body))
    assert found == [("Head & line", True), ("One two three x four", True), ("Five <six> é", True)]
    assert html.main_text(PAGE.format(body), [0, 1, 2]) == "Head & line\nOne two three x four\nFive <six> é"


def test_article_text_is_not_dropped_by_parts_of_names():
    body = (
        "<article><section id='related-work'><h2 id=\"share-prices\">Prices</h2><p class='notice'>Note</p></section>"
        "<h3 id=navigation>Finding the way</h3><p>Let <math><mi>x</mi></math> be <button>one</button></p>"
        "<div class='wide ad'>Buy</div><section id=comments><p>first!</p></section><div role=navigation>Next</div></article>"
    )
    want = ["Prices", "Note", "Finding the way", "Let x be one"]
    assert html.lines(PAGE.format(body)) == [(line, True) for line in want]


def test_comments_and_adverts_inside_an_article_go():
    for gone in (
        "<div class='comments-area'><p>first!</p></div>", "<div id='comment-list'><p>first!</p></div>",
        "<div class='ad-slot'>Buy</div>", "<p class='share-bar'>Share</p>", "<article class=comment><p>first!</p></article>",
        "<article class='wide comment'><p>first!</p></article>", "<ul class='social_links'><li>x</ul>",
    ):
        body = f"<article><p>One</p>{gone}<p>Two</p></article>"
        assert html.lines(PAGE.format(body)) == [("One", True), ("Two", True)], gone
    for kept in (
        "<div class='comment-on-law'>x</div>", "<article class=part><p>x</p></article>", "<h2 id='ad-list'>x</h2>",
        "<p class='share-prices'>x</p>", "<p class='adlist'>x</p>", "<div class='list-comments'>x</div>",
    ):
        assert html.lines(PAGE.format(f"<article><p>One</p>{kept}</article>")) == [("One", True), ("x", True)], kept


def test_broken_pages():
    for body in ("<article><p>cut &am", "<article><b>a<p>cut &am", "<article><p>cut &am<foo bar='", "<article><p>cut &am<!-- x"):
        assert html.lines("<nav>menu</nav>" + body)[-1][0].endswith("cut &am")
    assert html.lines("") == [] and html.lines("plain & simple") == [("plain & simple", False)]
    assert html.lines("<div class=ad><div>x</div>y</div><p>z") == [("z", False)]
    assert html.lines("<script>if (a<b) '</p>'") == []


def test_shared_lines_go_where_no_article_is(spark):
    def page(*paragraphs):
        return "<body><div>Home</div><div>Top offers today</div>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "<div>Imprint</div></body>"

    rows = [
        (1, "http://h.example/a/1", page("first text", "more of it")),
        (2, "http://h.example/a/2?q=1", page("second text")),
        (3, "http://other.example/a/1", page("first text")),
        (4, "http://copy.example/x", page("same")), (5, "http://copy.example/y", page("same")),
        (6, None, None), (7, "http://h.example/z", ""), (2, "http://h.example/a/2?q=1", page("second text")),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {(r["page_id"], r["url"]): r["text"] for r in html.extracted(frame).collect()}
    assert got[1, rows[0][1]] == "first text\nmore of it"
    assert got[2, rows[1][1]] == "second text"
    assert got[3, rows[2][1]] == "Home\nTop offers today\nfirst text\nImprint"
    assert got[4, rows[3][1]] == got[5, rows[4][1]] == "Home\nTop offers today\nsame\nImprint"
    assert got[6, None] == "" and got[7, rows[6][1]] == ""
    assert html.extracted(frame).count() == len(rows)
    assert rows_of(html.extracted(frame.limit(0))) == []


def test_pages_with_and_without_an_article_side_by_side(spark):
    template = "<div>Home</div><div>Offers</div>{}<div>Imprint</div>"
    rows = [
        (1, "http://h.example/a", template.format("<article><p>Own</p></article>")),
        (2, "http://h.example/b", template.format("<p>Bare</p>")),
        (3, "http://h.example/c", template.format("<article><p>Own</p></article>")),
        (4, "http://h.example/d", template.format("<article> </article>")),
        (4, "http://h.example/d", template.format("<article> </article>")),
        (None, None, None),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("row", F.lit("x")).withColumn("shared", F.lit(0))
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in html.extracted(frame).collect()), key=repr)
    assert got == [
        (0, None, "", 0), (1, rows[0][1], "Own", 3), (2, rows[1][1], "Bare", 4), (3, rows[2][1], "Own", 3),
        (4, rows[3][1], "Home\nOffers\nImprint", 19), (4, rows[3][1], "Home\nOffers\nImprint", 19),
    ]


def test_every_page_is_differenced_and_the_structure_checks_the_result(spark):
    template = "<div>Home</div>{}<article><p>Shared start</p><p>{}</p></article><div>Imprint</div>"
    rows = [
        (1, "http://h.example/a", template.format("<p>Lede of one</p>", "One")),
        (2, "http://h.example/b", template.format("<p>Lede of two</p>", "Two")),
        (3, "http://alone.example/a", template.format("<p>Lede</p>", "Alone")),
        (4, "http://other.example/a", template.format("", "Four")),
        (5, "http://other.example/b", "<div>Another</div><article><p>Five</p></article><div>Site</div>"),
    ]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    order = html.url_order(html.keyed(frame))
    row_of = {r["row"]: r["path"] for r in order.where("host = 'h.example'").collect()}
    shared = {row_of[r["row"]]: r["shared"] for r in html.shared_lines(order).collect() if r["row"] in row_of}
    assert shared == {"/a": [0, 2, 4], "/b": [0, 2, 4]}
    got = {r["page_id"]: r["text"] for r in html.extracted(frame).collect()}
    assert got == {
        1: "Lede of one\nShared start\nOne", 2: "Lede of two\nShared start\nTwo", 3: "Shared start\nAlone",
        4: "Shared start\nFour", 5: "Five",
    }


def test_many_equal_pages_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(html, "HOT_ROWS", 3)
    rows = [(i, "http://h.example/a", "<div>Home</div><p>Same</p>") for i in range(20)]
    rows += [(20, "http://h.example/b", "<div>Home</div><p>Other</p>"), (20, "http://h.example/b", "<div>Home</div><p>Other</p>")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = html.extracted(frame)
    assert sorted((r["page_id"], r["text"]) for r in got.collect()) == [(i, "Same") for i in range(20)] + [(20, "Other")] * 2


def test_common_lines_of_long_pages_in_bounded_memory():
    import tracemalloc

    rnd = random.Random(1)
    a = [rnd.randrange(40) for _ in range(9000)]
    b = [x for x in a if rnd.random() > 0.3] + [rnd.randrange(40) for _ in range(500)]
    tracemalloc.start()
    places = html.common_lines(a, b)
    assert tracemalloc.get_traced_memory()[1] < 12 << 20
    tracemalloc.stop()
    rest = iter(b)
    assert all(a[p] in rest for p in places) and len(places) >= len(b) - 500


@pytest.mark.parametrize("bits", [html.TABLE_BITS, 6])
def test_common_lines_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(html, "TABLE_BITS", bits)
    rnd = random.Random(0)
    for _ in range(300):
        a = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))]
        b = [rnd.randint(0, 4) for _ in range(rnd.randint(0, 12))]
        length = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                length[i + 1][j + 1] = length[i][j] + 1 if x == y else max(length[i][j + 1], length[i + 1][j])
        places = html.common_lines(a, b)
        assert places == sorted(set(places)) and len(places) == length[-1][-1]
        rest = iter(b)
        assert all(a[p] in rest for p in places)


def test_query_returns_every_page_with_the_article_alone(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r["page_id"]: r["html"] for r in table(spark, sf, "pages").collect()}
    rows = rows_of(QUERIES["op10_html_extraction"](spark, sf))
    assert {r["page_id"] for r in rows} == set(pages) and len(rows) == len(pages)
    for r in rows:
        inside = pages[r["page_id"]].split("<article>")[1].split("</article>")[0].split("<footer")[0]
        plain = " ".join(html.unescape(__import__("re").sub(r"<[^>]*>", " ", inside)).split())
        assert " ".join(r["text"].split()) == plain and r["n_chars"] == len(r["text"])
