"""Articles keep what only looks like page furniture, and hostile pages take linear time."""

import time

import pytest

from affinia.llm import html_text


def text_of(spark, *pages):
    rows = [(i, f"http://h{i}.example/", html, "t", 1) for i, html in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, host int")
    return {r["page_id"]: r["text"] for r in html_text.main_texts(frame).collect()}


BODY = "<p>The first paragraph of the article is long enough to be one.</p>"
PLAIN = "The first paragraph of the article is long enough to be one."


@pytest.mark.parametrize("inside, want", [
    ('<h2 id="related_work">Related work</h2>', "Related work"), ('<h2 id="search">Search</h2>', "Search"),
    ('<p class="form">A form of verse.</p>', "A form of verse."),
    ('<section id="responses"><p>Immune responses of cells.</p></section>', "Immune responses of cells."),
    ("<header><h1>Title</h1></header>", "Title"), ('<div class="notice-period"><p>Two months.</p></div>', "Two months."),
    ('<h3 class="share">Share of votes</h3>', "Share of votes"), ('<div id="menu"><p>Soup, fish, cake.</p></div>', "Soup, fish, cake."),
    ('<div class="comments"><p>First!</p></div>', ""), ('<aside>See also</aside>', ""), ('<div class="ad-slot">Buy it</div>', ""),
    ("<footer>Posted on Monday</footer>", ""), ("<form><label>Mail</label></form>", ""), ('<div hidden>None</div>', ""),
])
def test_what_stands_in_an_article(spark, inside, want):
    pages = [f"<body><nav><a href=/>Home</a></nav><div class=ad>Buy</div><article>{BODY}{inside}</article><div id=comments>Nice</div></body>"]
    assert text_of(spark, *pages)[0] == f"{PLAIN} {want}".strip()


def test_beside_an_article(spark):
    page = f'<div class="site-header">Site</div><div id="sidebar"><p>More</p></div><h1 id="search">Head</h1>{BODY}<ul class="pagination"><li>2</li></ul>'
    assert text_of(spark, f"<body>{page}</body>")[0] == f"Head {PLAIN}"


def test_deep_long_and_repeated_pages(spark):
    deep = "<div>" * 3000 + BODY + "<p>x</p>" + "</div>" * 3000
    long = "<article>" + "<p>many words of one long page</p>" * 40000 + "</article>"
    got = text_of(spark, deep, long, long, "<p", "<", "</div></div>", "&amp;<br>&#x41;")
    assert got[0] == f"{PLAIN} x" and got[1] == got[2] == " ".join(["many words of one long page"] * 40000)
    assert [got[k] for k in (3, 4, 5, 6)] == ["<p", "<", "", "& A"]


@pytest.mark.parametrize("part", ["<div>x", '<a "', "<!-- ", "<li>a<p>", "<b class=x><div>a</b>", "</i>", "<p><table><td>"])
def test_time_grows_with_the_length(part):
    def seconds(n):
        started = time.process_time()
        blocks = html_text.page_blocks(part * n)
        html_text.best_path(blocks)
        return time.process_time() - started

    seconds(500)
    assert seconds(16000) < 16 * max(seconds(2000), 0.02)
