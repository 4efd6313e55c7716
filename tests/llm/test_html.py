"""Main text of pages: labelled pages, odd markup, other layouts."""

import html
import re
from collections import Counter

from lakemart.llm.html_text import count_page, extract, labelled_weights, main_text, weights_from

PAGE = """<!DOCTYPE html><html lang="en"><head><title>Nothing</title><style>p{}</style><script>var t="</p>";</script>
</head><body class="has-sidebar"><div id="cookie-notice"><p>We use cookies and you must accept all of them.</p></div>
<header><h1>Site name</h1><p>The best news in town since nineteen hundred</p></header><nav><ul><li><a href="/a">Menu</a>
</li><li><a href="/b">Other</a></li></ul></nav><div class="sidebar"><h3>Popular</h3><p>Some text that is long, yes</p>
</div><div class="post-content"><h2 class="entry-header">Real &amp; true title</h2><p>First para&nbsp;with <a href=x>a
link</a> &lt;here&gt;. It goes on for a while.<div class="advert">Buy this now</div><p>Second   para<br>line two, and some
more words<script>if(a<b){}</script><!-- c --><form><label>Name</label><input></form><blockquote>A quote stands here
in the end</blockquote></div><section id="comments"><h3>3 comments</h3><article class="comment"><p>I really liked
this long article, it was so very good that I say so.</p></article></section><footer><p>Copyright, all rights
reserved</p></footer>"""
TEXT = ("Real & true title\n\nFirst para with a link <here>. It goes on for a while.\n\n"
        "Second para line two, and some more words\n\nA quote stands here in the end")


def test_layout_without_article_element():
    assert extract(PAGE, {}) == TEXT
    assert extract(PAGE, weights_from(Counter())) == TEXT


def brute(page):
    """The sample pages' article, by their one template."""
    body = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split())
              for b in re.split("</?(?:p|h1)>", body))
    return "\n\n".join(b for b in blocks if b)


def test_sample_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = labelled_weights(pages)
    want = {r["page_id"]: brute(r["html"]) for r in pages.collect()}
    got = main_text(pages, weights).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_held_out_pages(spark):
    """Weights of one half of the pages extract the other half exactly."""
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]
    counts = Counter()
    for page in pages[::2]:
        count_page(page, counts)
    weights = weights_from(counts)
    assert all(extract(p, weights) == brute(p) for p in pages[1::2])


def test_odd_pages(spark):
    long = "<article>" + "<p>many words in a paragraph of text</p>" * 5000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>just a paragraph"), (4, "u", long),
            (5, "u", "no markup < at all & more"), (6, "u", "<<<>>> </p></p><p"), (6, "u", "<!-- never closed <p>x"),
            (7, "u", "<nav><a href=x>only a menu</a></nav>"), (8, "u", "<script>alert('x')")]
    df = spark.createDataFrame([(i, u, h, "t", 3) for i, u, h in rows],
                               "page_id long, url string, html string, text string, n_chars int")
    got = {(r["page_id"], r["url"]): r["text"] for r in main_text(df, labelled_weights(df)).collect()}
    assert got[1, "u"] == got[2, None] == got[7, "u"] == got[8, "u"] == ""
    assert got[None, "u"] == "just a paragraph"
    assert got[4, "u"].count("many") == 5000
    assert got[5, "u"] == "no markup < at all & more"
    assert main_text(df.limit(0), labelled_weights(df.limit(0))).count() == 0


def test_listed_words_around_the_article():
    """Marks of wrappers, of what else a page has, and of sections lose no article."""
    long = "<p>" + "these are the words of the article itself " * 6 + "</p>"
    want = " ".join(["these are the words of the article itself"] * 6)
    side = '<div class="sidebar"><p>Some popular stories that stand beside</p></div>'
    for page in (f'<div class="content-sidebar-wrap"><main class="content">{long}</main>{side}</div>',
                 f'<div class="content-sidebar-wrap">{long}{side}</div>',
                 f'<div class="sidebar-wrap"><article>{long}</article></div>{side}',
                 f'<div class="entry-content no-sidebar">{long}{side}</div>',
                 f'<article class="post has-comments">{long}</article><section id="comments">'
                 '<article class="comment"><p>I liked it</p></article></section>'):
        assert extract(page, {}) == want, page
    assert extract(f'<article>{long}<section id="discussion">{long}</section></article>', {}) == f"{want}\n\n{want}"
