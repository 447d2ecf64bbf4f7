"""Main text of pages whose articles hold hidden, marked, anchored and mathematical pieces: exact texts."""

import pytest

from leadweave.llm.html import extract, main_text

LONG = "This sentence is long enough to be seen as a part of the article, surely and at once."
PAGES = {
    "hidden piece": (f'<article><p>{LONG} Before <span style="display:none">secret</span>after.</p></article>', f"{LONG} Before after."),
    "hidden attribute": (f"<article><p>{LONG} One <b hidden>no</b>two.</p></article>", f"{LONG} One two."),
    "share link": (f'<article><p>{LONG} <a class="share" href="/s">Share it</a></p></article>', LONG),
    "marked span alone": (f'<article><p>{LONG}</p><div><span class="advert">Buy now, it is good for you and yours.</span></div></article>', LONG),
    "marked blocks": (f'<article><p>{LONG}</p><div class="related"><p>Read this long text too, it is about something else.</p></div></article>', LONG),
    "section ids": (f'<article><p>{LONG}</p><section id="discussion"><h2 id="related-work">Related work</h2><p>{LONG}</p></section></article>', f"{LONG}\nRelated work\n{LONG}"),
    "paragraph ids": (f'<main><p id="comment-on-method">{LONG}</p><p id="search">{LONG}</p></main>', f"{LONG}\n{LONG}"),
    "reader comments": (f'<article><p>{LONG}</p><section id="comments"><p>I do not agree with this article at all, it is not good.</p></section></article>', LONG),
    "container ids": (f'<div id="site-nav"><p>Home and about us and all the other pages.</p></div><article><p>{LONG}</p></article><div id="footer-notice">All rights of ours.</div>', LONG),
    "data-id is no id": (f'<article><div data-id="comments"><p>{LONG}</p></div></article>', LONG),
    "formula": (f"<article><p>{LONG} Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>E=mc^2</annotation></math> as we know it.</p></article>",
                f"{LONG} Energy is E=mc2 as we know it."),
    "references by piece": (f"<article><p>{LONG} &am<b>p;</b> &amp; &#233;&eacute; &lt;b&gt;</p></article>", f"{LONG} &amp; & éé <b>"),
    "comments of markup": (f"<article><p>{LONG} a<!-- <p> gone -->b</p></article>", f"{LONG} ab"),
    "lists": (f"<article><p>{LONG}</p><ul><li>First thing<li>Second thing</ul></article>", f"{LONG}\nFirst thing\nSecond thing"),
    "tables": (f"<article><p>{LONG}</p><table><tr><td>One</td><td>Two</td></tr></table></article>", f"{LONG}\nOne\nTwo"),
    "scripts": (f"<article><script>var a = '<p>{LONG}</p>';</script><p>{LONG}</p><style>p{{}}</style></article>", LONG),
    "forms": (f"<article><p>{LONG}</p></article><form><p>Write to us what you think about all this today.</p></form>", LONG),
    "header and footer": (f"<header><p>Name of the site, its motto and its menu of pages.</p></header><article><h1>Title</h1><p>{LONG}</p></article><footer><p>{LONG}</p></footer>", f"Title\n{LONG}"),
    "white space": (f"<article><p>{LONG}\n\n two&nbsp;\tthree </p></article>", f"{LONG} two three"),
    "no content": ("<nav><ul><li><a href='/'>Home</a></ul></nav>", ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_exact_text(name):
    html, text = PAGES[name]
    assert main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{html}</body></html>")[0] == text


def test_long_pages_and_odd_rows(spark):
    page = "<article>" + f"<p>{LONG}</p>" * 20_000 + "</article>"
    rows = [(1, "u", page, 0, 0), (1, "u", page, 0, 0), (2, None, None, 0, 0), (None, "u", "", 0, 0)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int, n_blocks int")).orderBy("n_chars").collect()
    assert [r["n_chars"] for r in got] == [0, 0, *[20_000 * (len(LONG) + 1) - 1] * 2] and got[3]["n_blocks"] == 20_000
