import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from mesonlab.llm import html as H
from tests.llm.helpers import SF2, frame


def article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    parts = [" ".join(unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(p for p in parts if p)


def test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF2}/pages.parquet").collect()}
    got = H.op9_html(spark, SF2).collect()
    assert {r.page_id: r.text for r in got} == {i: article(p) for i, p in pages.items()}
    assert all(r.n_chars == len(r.text) for r in got)


def test_density_finds_unmarked_text(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF2}/pages.parquet").collect()]
    bare = [p.replace("<article>", '<div class="x">').replace("</article>", "</div>") for p in pages]
    assert [H.main_text(p) for p in bare] == [article(p) for p in pages]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<script>x", ""), ("<!-- only", ""), ("&lt;p&gt;", "<p>"), ("<div>" * 3000 + "x", "x"),
    ("<body><article><p>a<b>b</b> c&nbsp;d<br>e<p>q <script>n</script>r<ul><li>one<li>two</ul><div class=comments><p>no</div></article><aside>z</aside>", "ab c d e\nq r\none\ntwo"),
    ('<article><p title="a>b">x</p><form>f</form><footer>g</footer></article>', "x")])
def test_odd_pages(page, text):
    assert H.main_text(page) == text


def test_keeps_every_dense_subtree():
    parts = [[f"Paragraph {k} of part {n} says something that takes a line of text to say." for k in range(5)] for n in range(2)]
    first, second = ("".join(f"<p>{x}</p>" for x in part) for part in parts)
    links = "<ul>" + "".join(f'<li><a href="{k}">Some other page of the site {k}</a></li>' for k in range(8)) + "</ul>"
    text = "\n".join(parts[0] + parts[1])
    assert H.main_text(f"<body>{links}<div>{first}</div>{links}<div>{second}</div>{links}</body>") == text
    assert H.main_text(f"<body>{links}<article>{first}</article>{links}<article>{second}</article></body>") == text


LONG = ["The first paragraph of the article has enough words in it to be taken for text.", "A second one goes on about the same thing, at about the same length, as they do.",
        "The third one ends the article with a few remarks, and nothing comes after it here."]
ARTICLE = "".join(f"<p>{x}</p>" for x in LONG)


@pytest.mark.parametrize("page", [
    # readers' comments, whatever they are in
    f'<body><article>{ARTICLE}</article><section class="discussion"><article class="comment"><p>{LONG[0]} Says a reader.</p></article><article class="comment"><p>{LONG[1]} No.</p></article></section></body>',
    f'<body><article>{ARTICLE}<div class="reader-comments"><p>{LONG[0]} A reader.</p></div></article></body>',
    f'<body><main><article>{ARTICLE}</article><article id="comment-17"><p>{LONG[0]} A reader.</p></article></main></body>',
    f'<body><article>{ARTICLE}</article><div itemtype="https://schema.org/Comment"><p>{LONG[0]} A reader.</p></div></body>',
    # notices, teasers, shares
    f'<body><div class="gdpr"><p>We use cookies, and so do our partners, to show you what you want to see.</p></div><article>{ARTICLE}</article></body>',
    f'<body><div id="cookieConsent"><p>We use cookies, and so do our partners, to show you what you want.</p></div><article>{ARTICLE}</article></body>',
    f'<body><article>{ARTICLE}</article><article><p>Another story in a line.</p></article><article><p>One more in a line.</p></article></body>',
    f'<body><article>{ARTICLE}<div class="share-buttons">Share this on some network</div></article></body>',
    f'<body><article class="related-work">{ARTICLE}</article></body>'])
def test_article_without_what_stands_around_it(page):
    assert H.main_text(page) == "\n".join(LONG)


@pytest.mark.parametrize("name", ["post-header", "related-work", "legal-analysis", "menu-planning", "social-history", "ads-that-worked", "noticeable", "headerless"])
def test_names_that_only_hold_a_word_of_furniture(name):
    page = f'<body><article><div class="{name}"><h1>A title</h1></div>{ARTICLE}<section class="{name}"><p>{LONG[0]} Again.</p></section></article></body>'
    assert H.main_text(page) == "\n".join(["A title", *LONG, LONG[0] + " Again."])


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<b>" * 100_000 + "x" + "</i>" * 100_000, "<div><b>" * 50_000 + "x" + "</b></div>" * 50_000,
                                  "<p><b>" * 50_000 + "x", "<ul><li>" * 50_000 + "x", "<div>" * 50_000 + "<p>x" + "</section>" * 50_000])
def test_deep_pages_take_time_as_they_are_long(page):
    import time
    start = time.time()
    assert H.main_text(page) == "x" and time.time() - start < 20


def test_keeps_rows(spark):
    df = frame(spark, [(1, None), (1, None), (None, "<p>x")], "page_id long, html string").withColumn("text", F.lit(3)).withColumn("n_chars", F.lit(1))
    assert sorted(r.text for r in H.extract(df).collect()) == ["", "", "x"]
    assert H.extract(df.limit(0)).count() == 0
