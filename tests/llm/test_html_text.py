from __future__ import annotations

import random
import time
from collections import Counter
from html.parser import HTMLParser

import pytest

from siltworks.llm import html_text

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="sidebar-left">
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><div class="cookie-notice">We use cookies, many of them, all day long.</div>
<article><header><h1>The  headline</h1></header><p>First &amp; best&nbsp;paragraph of <b>bo</b>ld<br>text.</p><p>Tiny.<div class="ad">Buy now</div>
<ul><li>One point</li><li>Another</li></ul><aside>Aside</aside><table><tr><td>cell</td></tr></table><form><label>Mail</label><input></form>
<!-- <p>hidden</p> --><section id="comments"><article><p>A reader's remark that is quite long and goes on and on.</p></article></section></article>
<aside>Related <a href="x">stories</a></aside><footer>&copy; 2024 Someone</footer></body></html>"""


@pytest.fixture(scope="module")
def tree(spark):
    return html_text.fit_tree(spark)


def test_tree_learns_its_table(tree):
    rows = html_text.labelled_blocks()
    assert len(rows) > 200 and all(html_text._label(tree, r[:-1]) == r[-1] for r in rows)


class Reader(HTMLParser):
    """The blocks of a well-formed page by the standard library's parser, in its own way: text, words, and words in links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open, self.now = [], [], []

    def end(self):
        words = [(w, linked) for text, linked in self.now for w in [text]]
        text = " ".join("".join(t for t, _ in words).split())
        if text:
            self.found.append((text, len(text.split()), sum(len(t.split()) for t, linked in words if linked)))
        self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in html_text.BLOCKS:
            self.end()
        if tag == "br":
            self.now.append((" ", False))
        else:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag in html_text.BLOCKS:
            self.end()
        self.open.pop()

    def handle_data(self, data):
        if not {"script", "style"} & set(self.open):
            self.now.append((data, "a" in self.open))


def random_page(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 5)):
        kind = rng.choice(["text", "text", "inline", "block", "link", "script", "comment", "br"])
        words = " ".join(rng.choice(["word", "a&amp;b", "&lt;x&gt;", "é", "5 &#62; 4", "\n"]) for _ in range(rng.randint(1, 6)))
        if kind == "inline":
            out.append(f'<span title="a > b" data-x=\'"\'>{words}</span>')
        elif kind == "block" and depth < 4:
            tag = rng.choice(["div", "section", "ul", "table", "h2", "blockquote"])
            out.append(f"<{tag} class='x y'>{random_page(rng, depth + 1)}</{tag}>")
        elif kind == "link":
            out.append(f' <a href="/x?a=1&b=2">{words}</a> ')
        elif kind == "script":
            out.append("<script>if (a<b) { x = '<p>'; }</script>")
        elif kind == "comment":
            out.append("<!-- <p>no</p> -->")
        else:
            out.append("<br>" if kind == "br" else f" {words} ")
    return "".join(out)


def test_blocks_equal_another_parser():
    rng = random.Random(3)
    for _ in range(400):
        page = f"<html><body>{random_page(rng)}</body></html>"
        reader = Reader()
        reader.feed(page)
        reader.close()
        reader.end()
        assert [(b.text, b.words, b.linked) for b in html_text.blocks(page)] == reader.found


@pytest.mark.parametrize("unit", ['<a "', '<a href="', "<", "<!--", "<p a='", "<p ==", "</script ", "<![CDATA[", "<div class='x y'>word ", "<b><a>", "&", "<p>"])
def test_time_grows_with_the_page(tree, unit):
    """A page of a megabyte is a matter of seconds, whatever it is made of."""
    start = time.time()
    html_text.main_text(unit * (1_000_000 // len(unit)), tree)
    assert time.time() - start < 10


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<article class="post comment-enabled"><p>{}</p></article>', True), ('<div class="content has-sidebar"><p>{}</p></div>', True),
        ('<div class="page sidebar-left widget"><nav><a href=x>a</a></nav><article><p>{}</p></article></div>', True), ('<div id="banner-page"><p>{}</p><p>{}</p></div>', True),
        ('<article><p>x</p></article><div class="comments"><article><p>{}</p></article></div>', False), ('<article><p>' + "y " * 90 + '</p><div class="promo"><p>{}</p></div></article>', False),
        ('<p class="a"">{}', True), ("<p a=b>{}<p title='x>y'>z", True),
    ],
)
def test_names_silence_no_article(tree, page, text):
    words = " ".join(["word"] * 40)
    assert (words in html_text.main_text(page.replace("{}", words), tree)) == text


def test_without_an_article_words_and_links_decide(tree):
    """The same blocks are found with and without names of classes, and most blocks are told by no mark."""
    rng, decided = random.Random(9), Counter()
    for _ in range(60):
        main = [" ".join(["text"] * rng.randint(35, 120)) for _ in range(rng.randint(2, 6))]
        links = [f'<div class="CLASS"><a href="/{i}">' + "go " * rng.randint(1, 3) + "</a></div>" for i in range(rng.randint(2, 6))]
        page = "".join(links) + "".join(f"<p>{t}</p>" for t in main) + "".join(links)
        for name in ("x", "menu-item"):
            shown = page.replace("CLASS", name)
            assert html_text.main_text(shown, tree).split("\n") == main
            for x in html_text.features(html_text.blocks(shown)):
                decided["marked" if x[0] else "not"] += 1
    assert decided["not"] > decided["marked"] > 0


def test_article(tree):
    assert html_text.main_text(FULL, tree).split("\n") == [
        "The headline", "First & best paragraph of bold text.", "Tiny.", "One point", "Another", "cell",
    ]


def test_page_without_article(tree):
    words = lambda w, n: " ".join([w] * n)
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><h2>A heading here</h2><p>{words('one', 50)}<p>short one between<p>{words('two', 40)}"
    page += f"<ul><li><a href=3>{words('link', 6)}</a><li><a href=4>{words('link', 5)}</a></ul><div id=footer>{words('f', 30)}</div>"
    assert html_text.main_text(page, tree).split("\n") == ["A heading here", words("one", 50), "short one between", words("two", 40)]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""), ("<", "<"), ("a < b & c", "a < b & c"), ("<article>x", "x"), ("</p></div>lone words", "lone words"), ("<article>a<script>b", "a"),
        ("<article>a<!-- b", "a"), ("<main><p title='a>b'>c</p></main>", "c"), ("<article><p>a</p><div hidden><p>b</p></div><p>c</article>", "a\nc"),
        ("<article>&lt;b&gt; &#233;&eacute;&unknown; \x0b\x1c y</article>", "<b> éé&unknown; y"), ("<article><a href=x>all of it is a link but it is long enough text</article>", None),
        ("<article><p>x</p>" + "<b>" * 20_000 + "y</article>", "x\ny"),
    ],
)
def test_odd_pages(tree, page, text):
    found = html_text.main_text(page, tree)
    assert text is None or found == text


def test_awkward_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (3, "u", FULL, "t"), (3, "u", FULL, "t"), (None, "u", "<article>" + "<p>word word</p>" * 30_000, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = html_text.extract(df)
    assert out.columns == ["page_id", "url", "html", "text"]
    found = out.collect()
    assert [r["text"] for r in found[:2]] == ["", ""] and found[2] == found[3]
    assert found[4]["text"].count("\n") == 29_999
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<script>for(var i=0;i<n;i++){f(i)}</script><article>the text</article>", "<script>if(a<b)c();</SCRIPT ><article>the text</article>",
        "<script>x='<!--'</script><article>the text</article>", "<style>a<b</style><article>the text<script>y<z '</script></article>",
        "<head><title>T</title><meta charset=utf-8><article>the text</article>", "<head><script>i<n</script><body><article>the text</article>",
        "<head><title>T</title><body><main>the text", "<head><title>a<b</title></head><article>the text</article>",
    ],
)
def test_code_and_open_heads_silence_no_text(tree, page):
    assert html_text.main_text(page, tree) == "the text"
