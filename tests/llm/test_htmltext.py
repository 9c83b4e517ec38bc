import html
import os
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import htmltext

DATA = "/root/testdata/sf0.001"
LONG = "Some words that make a paragraph of the article long enough to be told from a menu, &amp; then some more of them."
SAID = LONG.replace("&amp;", "&")
MENU = "<ul><li><a href=/a>Home</a><li><a href=/b>News</a><li><a href=/c>Contact</a></ul>"

# (page, its main text)
CASES = {
    "article": (
        f"<title>T</title><nav>{MENU}</nav><article><h1>Title</h1><p>{LONG}<p>Short.<p>{LONG}</article><footer>&copy; x</footer>",
        f"Title\n{SAID}\nShort.\n{SAID}",
    ),
    "divs only": (
        f"<body><div id=top>{MENU}</div><div id=content><h1>Title</h1><p>Hm.</p><p>{LONG}</p><ul><li>one<li>two</ul><p>{LONG}</p>"
        f"<p>End.</p></div><div id=bottom>{MENU}<div>Legal</div></div>",
        f"Title\nHm.\n{SAID}\none\ntwo\n{SAID}\nEnd.",
    ),
    "bare body": (
        f"<body><div>{MENU}</div><h1>Title</h1><p>{LONG}</p><p>{LONG}</p><p>End.</p><div><a href=x>more</a> <a href=y>links</a></div>",
        f"Title\n{SAID}\n{SAID}\nEnd.",
    ),
    "main with asides": (
        f"<header><h1>Site</h1><p>{LONG}</p></header><main><h1>Title</h1><p>{LONG}</p><aside><p>{LONG}</p></aside>"
        f"<div class='ad-slot'><p>{LONG}</p></div><p>Last</p><form><p>Subscribe now, {LONG}</p><input></form></main>"
        f"<section id=comments><h2>3 comments</h2><article class='comment'><p>{LONG}</p><p>{LONG}</p></article></section>",
        f"Title\n{SAID}\nLast",
    ),
    "notices": (
        f"<div class='cookie-banner'><p>{LONG}</p></div><div role=alert>{LONG}</div><article><p>{LONG}</p>"
        f"<div class=newsletterSignup>{LONG}</div></article><ol class=commentlist><li><p>{LONG}</p></ol>",
        SAID,
    ),
    "wrapper called after the sidebar": (
        f"<div class='layout sidebar-right'><main><h1>A</h1><p>{LONG}</p></main><div class=sidebar><p>{LONG}</p></div></div>",
        f"A\n{SAID}",
    ),
    "page in a form": (f"<form id=aspnet><div>{MENU}</div><div><h1>A</h1><p>{LONG}</p><p>{LONG}</p></div></form>", f"A\n{SAID}\n{SAID}"),
    "no-comments is no comment": (f"<body class=no-sidebar><article class='post no-comments'><p>{LONG}</p></article>", SAID),
    "white space and references": (
        "<article><p> a\n\tb&nbsp;&#x63; <b>bo</b>ld<br>next </p>\n<p>&lt;p&gt; &euro; &amp;amp;</p></article>",
        "a b c bold next\n<p> € &amp;",
    ),
    "scripts and comments": (
        "<article><p>a<script>var x='</p><p>b';</script>c<!-- <p>d</p> --></p><style>p{}</style><![if x]><p>e<![endif]></article>",
        "ac\ne",
    ),
    "table in the article": (
        f"<article><p>{LONG}</p><table><tr><td>1<td>2<tr><td><p>3</div></table><p>z</p></article>", f"{SAID}\n1\n2\n3\nz",
    ),
    "unclosed": (f"<article><p><b>Bold<br><p>{LONG}<div>inner</article><footer>f", f"Bold\n{SAID}\ninner"),
    "inline advert": ("<article><p>a <span class=ad>buy</span> b</p></article>", "a b"),
    "short article, long others": (f"<article><p>Hi.</p></article><div><p>{LONG}</p><p>{LONG}</p></div>", "Hi."),
    "nothing": ("<nav>menu</nav><footer>f</footer>", ""),
    "no markup": (f"  {LONG}\n{LONG}", f"{SAID} {SAID}"),
    "empty": ("", ""),
    "unset": (None, ""),
    "broken": ("<![foo[ <p <a href='x <article>text</article>", "text"),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text_of(name):
    page, want = CASES[name]
    assert htmltext.main_text(page) == want


def test_given_pages_beside_a_plain_extraction(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    want = {}
    for r in pages:
        blocks = re.split(r"</?(?:p|h1)>", re.search("<article>(.*)</article>", r.html, re.S)[1])
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in blocks]
        want[r.page_id] = "\n".join(filter(None, lines))
    out = htmltext.op13_main_text(spark, DATA)
    assert [f"{n} {t}" for n, t in out.dtypes] == ["page_id bigint", "url string", "text string", "n_chars bigint"]
    got = {r.page_id: r.text for r in out.where("n_chars = length(text)").collect()}
    assert os.path.isdir(DATA) and got == want and len(got) == len(pages)


def test_awkward_tables(spark, tmp_path):
    path = str(tmp_path)
    page = f"<article><p>{LONG}</p></article>"
    rows = [(1, "u", page, 7), (1, "u", page, 8), (None, None, None, None), (2, None, "", 1), (3, "v", "<p>" * 30_000 + "x", 2)]
    kind = "page_id long, url string, html string, text int"
    for name, some in (("full", rows), ("none", [])):
        spark.createDataFrame(some, kind).write.parquet(f"{path}/{name}/pages.parquet")
    got = sorted((str(r.page_id), r.url, r.text, r.n_chars) for r in htmltext.op13_main_text(spark, f"{path}/full").collect())
    one = ("1", "u", SAID, len(SAID))
    assert got == [one, one, ("2", None, "", 0), ("3", "v", "x", 1), ("None", None, "", 0)]
    assert htmltext.op13_main_text(spark, f"{path}/none").count() == 0
    # the operator keeps the columns of its table
    full = htmltext.extracted(spark.read.parquet(f"{path}/full/pages.parquet"))
    assert full.columns == ["page_id", "url", "html", "text"]


def test_very_long_page_is_fed_in_pieces():
    words = " ".join(f"word{i}" for i in range(300_000))
    page = f"<nav>{MENU * 1000}</nav><article>" + f"<p>{words}</p>" * 2 + "<p>end</article>"
    assert htmltext.main_text(page) == f"{words}\n{words}\nend"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "<p>", "</p>", "<div>", "</div>", "<article>", "</article>", "<b>", "</b>", "<ul><li>", "</ul>", "<td>", "</table>", "<table>",
    "word ", "long words in a line. ", "<nav>", "</nav>", "&amp;", "<", "</", "<!--", "-->", "<![x[", "<script>", "</script>",
    "<form>", "</form>", "<h1>", "</h1>", "<br>", "<head>", "<title>", "</title>", "<p class=ad>", "<a href=x>", "</a>",
]), max_size=40))
def test_any_markup_is_read(parts):
    text = htmltext.main_text("".join(parts))
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n"))


def test_smoothing_and_threshold():
    values = np.array([0.0, 0, 0, 9, 9, 9, 9, 0, 0])
    even = htmltext.smoothed(values)
    kernel = [np.exp(-0.5 * (d / htmltext.SIGMA) ** 2) for d in range(9)]
    for i in range(9):
        near = [j for j in range(9) if abs(i - j) <= int(np.ceil(3 * htmltext.SIGMA))]
        weights = [kernel[abs(i - j)] for j in near]
        assert even[i] == pytest.approx(np.dot(weights, values[near]) / sum(weights))
    assert htmltext.threshold(values) == 4.5 and htmltext.threshold(np.full(3, 2.0)) == 2.0
