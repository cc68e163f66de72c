import html
import re
import time

import pytest

from tierline.llm.main_text import extract, main_texts

FOLDER = "/root/testdata/sf0.01"
BODY = "This is a sentence of the article, with commas, and enough words to count as text. " * 3
PAGE = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{x:y}}</style>
<script>var t = "<p>not, this, text</p>";</script></head><body class="has-sidebar no-comments">
<header><h1>Site name</h1><nav><a href="/">Home</a></nav></header>
<div id="cookie-notice"><p>We use cookies, on this site, to do things.</p></div>
<div class="wrapper"><div id="sidebar"><p>About me, and others, and more, and so on.</p></div>
<div id="content"><h2>The title</h2><!-- <p>no</p> --><p>{BODY}</p><div class="adBox">Buy, now</div>
<p>A &amp; B&nbsp;&lt;c&gt;<br>second &#x41; line <a href='x>y'>with a link</a>, and more.
<ul><li>one<li>two, <b>bold</b></ul><ul class=x><li><a>p</a><li><a>q</a><li><a>r</a></ul>
<table><tr><td>cell 1<td>cell 2</table><form><input value="v"><button>Go</button> form</form></div>
<section class="comments"><p>Reader says, this, that, and, so, on, and, on.</p></section></div>
<footer><p>Copyright, all rights reserved, by us.</p></footer>"""
TEXT = "\n".join(
    ["The title", " ".join(BODY.split()), "A & B <c> second A line with a link, and more.", "one"]
    + ["two, bold", "cell 1", "cell 2"]
)


def test_article_without_its_surroundings():
    assert extract(PAGE) == TEXT


def test_articles_are_whole():
    page = f"<nav>n</nav><article><header><h1>Head</h1></header><div><p>{BODY}</p></div><p>End.</article>"
    assert extract(page) == f"Head\n{' '.join(BODY.split())}\nEnd."


def test_wrappers_are_kept():
    """One word of a class, or a form around the page, says little about what holds all the text."""
    side = "<div class='sidebar'><p>About me, and others.</p></div>"
    for around in (
        "div class='content has-sidebar'",
        "div id='page' class='site no-sidebar'",
        "div class='post-with-comments'",
        "div class='popular-science'",
        "form method=post",
    ):
        end = around.split()[0]
        for inner in (f"<article><p>{BODY}</p></article>", f"<div><p>{BODY}</p><p>{BODY}</p></div>"):
            page = f"<body><nav>n</nav><{around}>{inner}{side}</{end}><footer>f</footer>"
            lines = extract(page).split("\n")
            assert set(lines) == {" ".join(BODY.split())}, around
    cards = "<div class=related><article><p>Another, one.</p></article></div>"
    assert extract(f"<article><p>{BODY}</p></article>{cards}") == " ".join(BODY.split())
    assert extract("<div class='cookie'><p>We use cookies, here.</p></div>") == ""


@pytest.mark.parametrize("name", ["id=comments", "class=cookie-consent", "class='ad box'", "class=notice"])
def test_comments_and_notices_never_win(name):
    """However much longer they are than the article, before it, after it or inside it."""
    post = "".join(f"<p>Paragraph {n} of the text, with its commas.</p>" for n in range(2))
    other = f"<div {name}>" + "".join(f"<p>I say, number {n}, that this, too, is long.</p>" for n in range(30)) + "</div>"
    text = "Paragraph 0 of the text, with its commas.\nParagraph 1 of the text, with its commas."
    assert extract(f"<body><div class=post>{post}</div>{other}") == text
    assert extract(f"<body>{other}<div>{post}</div>") == text
    assert extract(f"<body><article>{post}</article>{other}") == text
    assert extract(f"<body>{other}<main>{post}</main>") == text
    assert extract(f"<body><article>{post}{other}</article>") == text
    # Mirror images: the article in an element with such a name, and nothing but such an element.
    assert extract(f"<body><div {name}><article>{post}</article></div><p>More.") == text
    assert extract(f"<body><div {name}>{post * 4}</div>").startswith(text)


def test_comments_in_articles_of_their_own():
    post = f"<article class=post><p>{BODY}</p></article>"
    replies = "".join(f"<article class='comment-body'><p>{BODY}</p><p>{n}</p></article>" for n in range(9))
    page = f"<body>{post}<div id=comments>{replies}</div>"
    assert extract(page) == " ".join(BODY.split())


def test_odd_markup():
    assert extract("") == "" and extract("   ") == "" and extract("<nav>x</nav>") == ""
    assert extract("plain text &amp more") == "plain text & more"
    assert extract("<p>a<p>b</p>c") == "a\nb\nc"
    assert extract("<p>one<script>if (a < b) {}</script> two</p><script>unclosed <p>x") == "one two"
    assert extract("<a href='x>y</a><p>q") == "y\nq"
    assert extract("<<<p>z") == "<<\nz"
    for bad in ("<div>" * 5000 + "deep", '<a href="' * 5000 + "x", "<p>" * 20_000 + "y"):
        start = time.perf_counter()
        extract(bad)
        assert time.perf_counter() - start < 20
    long = "word, " * 200_000
    assert extract(f"<article><p>{long}</p></article>") == " ".join(long.split())


def test_rows(spark):
    rows = [(1, "u", PAGE, "a"), (1, "u", PAGE, "a"), (None, None, None, None), (2, "e", "", "b")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted((tuple(r) for r in main_texts(frame.repartition(2)).collect()), key=str)
    one = (1, "u", TEXT, len(TEXT))
    assert found == sorted([one, one, (None, None, "", 0), (2, "e", "", 0)], key=str)
    assert main_texts(frame.limit(0)).collect() == []


def test_sample_pages(spark):
    """These hold their text in one article of headings and paragraphs."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = {r.page_id: r.text for r in main_texts(pages).collect()}
    for row in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|<footer>|$)", row.html, re.S)[1]
        lines = re.sub(r"</?(p|h1)>", "\n", article).replace("<br>", " ")
        lines = [" ".join(html.unescape(re.sub("</?b>", "", x)).split()) for x in lines.split("\n")]
        assert found[row.page_id] == "\n".join(x for x in lines if x)
