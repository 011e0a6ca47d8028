"""Hand-written pages whose blocks are labelled: the table that the decision tree of main text is fitted to.

``PAGES`` holds pieces of pages in order: markup, and text blocks with their label, ``+`` for main text and ``-`` for all
else. ``w(n)`` stands for a sentence of n words; only numbers of words count, not which.
"""

from __future__ import annotations

from itertools import cycle

_SAID = cycle("the river rose again last night and by morning two bridges were closed while crews worked to clear a road that leads north".split())


def w(n: int) -> str:
    return " ".join(next(_SAID) for _ in range(n)).capitalize() + "."


def link(n: int) -> str:
    return f'<a href="/{n}">{w(n)}</a>'


def menu(tag: str, *sizes: int) -> list:
    """Links in a list, each a block that is not main text."""
    return [f"<{tag}><ul>", *(("li", "-", link(n)) for n in sizes), f"</ul></{tag}>"]


def paragraphs(*sizes: int, tag: str = "p") -> list:
    return [(tag, "+", w(n)) for n in sizes]


PAGES: tuple[list, ...] = (
    # a news page with an article
    ["<header>", ("div", "-", "Daily Paper"), *menu("nav", 1, 1, 2, 1), "</header><main><article>", ("h1", "+", w(8)), ("p", "+", w(3)),
     *paragraphs(42, 65, 12, 80, 5, 33), ("blockquote", "+", w(18)), ("figcaption", "+", w(9)), *paragraphs(51, 2, 90, 28),
     '<div class="share-box">', ("span", "-", "Share this"), "</div></article></main><aside>", ("h2", "-", w(2)), ("p", "-", w(14)), *menu("div", 7, 9, 6), "</aside>",
     "<footer>", ("p", "-", w(11)), ("p", "-", link(2)), "</footer>"],
    # an article of short blocks and a long notice above it
    ['<div class="cookie-banner">', ("p", "-", w(38)), ("p", "-", w(4)), "</div>", *menu("nav", 1, 2, 1), "<article>", ("h1", "+", w(4)), ("p", "+", w(2)), ("p", "+", w(7)),
     ("li", "+", w(3)), ("li", "+", w(1)), ("li", "+", w(5)), ("td", "+", w(1)), ("td", "+", w(2)), ("p", "+", w(11)), "</article>", ("p", "-", w(12)), ("p", "-", w(6)), "<footer>", ("p", "-", w(25)), "</footer>"],
    # a list of links is part of an article; adverts and remarks lie within and below it
    [*menu("nav", 2, 1, 1), ("div", "-", w(8)), "<article>", ("h1", "+", w(6)), *paragraphs(60, 24), ("li", "+", link(4)), ("li", "+", link(6)), ("p", "+", w(9) + " " + link(5)),
     '<div class="advert">', ("p", "-", w(16)), "</div>", *paragraphs(37, 48), '<section class="comments">', ("h3", "-", w(2)), ("p", "-", w(40)), ("p", "-", w(22)), ("p", "-", w(3)), "</section></article>",
     ("p", "-", w(20)), ("p", "-", w(31)), "<footer>", ("p", "-", w(9)), "</footer>"],
    # a web log without an article
    [("div", "-", link(1)), ("div", "-", link(1)), ("div", "-", link(2)), ("h1", "+", w(7)), *paragraphs(72, 45, 8, 66, 39, 54), ("h2", "+", w(4)), *paragraphs(58, 47, 81), ("p", "-", w(3)), ("p", "-", link(3)),
     ("p", "-", link(4)), ("div", "-", w(2)), ("div", "-", link(6))],
    # pages of plain paragraphs: headings of any length, and short paragraphs between long ones
    [("div", "-", link(1)), ("div", "-", link(3)), ("h1", "+", w(2)), ("p", "+", w(49)), ("p", "+", w(4)), ("p", "+", w(41)), ("h2", "+", w(3)), ("p", "+", w(58)), ("h3", "+", w(1)), ("p", "+", w(37)), ("p", "+", w(2)), ("p", "+", w(76)),
     ("li", "-", link(6)), ("li", "-", link(5)), ("footer", "-", w(30))],
    [("li", "-", link(2)), ("h2", "+", w(3)), ("p", "+", w(50)), ("p", "+", w(4)), ("p", "+", w(40)), ("p", "+", w(14)), ("p", "+", w(95)), ("h2", "+", w(6)), ("p", "+", w(36)), ("h2", "+", w(3)), ("p", "+", w(110)), ("p", "+", w(21)), ("p", "+", w(64)), ("li", "-", link(4))],
    [("h1", "+", w(3)), ("p", "+", w(36)), ("p", "+", w(3)), ("p", "+", w(88)), ("p", "+", w(18)), ("p", "+", w(34)), ("p", "+", w(7)), ("p", "+", w(55)), ("div", "-", link(2)), ("div", "-", w(2)), ("div", "-", link(1))],
    # a page of a handbook without an article
    [("li", "-", link(1)), ("li", "-", link(2)), ("li", "-", link(3)), ("li", "-", link(2)), ("h1", "+", w(3)), *paragraphs(35, 28), ("h2", "+", w(5)), *paragraphs(62, 10, 44), ("p", "+", w(30) + " " + link(4)), *paragraphs(25, 52),
     ("p", "-", link(2)), ("p", "-", link(2)), ("p", "-", w(5))],
    # a shop: a few long texts among many short and linked ones
    [("div", "-", link(2)), ("div", "-", w(1)), ("div", "-", link(1)), ("div", "-", link(2)), ("div", "-", link(3)), ("p", "+", w(64)), ("p", "+", w(38)), ("p", "+", w(41)), ("div", "-", link(3)), ("div", "-", w(2)), ("div", "-", w(4)),
     ("div", "-", link(5)), ("div", "-", w(1)), ("div", "-", link(24)), ("div", "-", link(18)), ("div", "-", w(4) + " " + link(20))],
    # a front page: only teasers in links
    [("div", "-", link(1)), ("div", "-", link(8)), ("div", "-", link(22)), ("div", "-", link(9)), ("div", "-", link(31)), ("div", "-", w(2)), ("div", "-", link(12)), ("div", "-", link(60)), ("div", "-", link(3))],
    # a forum without an article, and a notice of the site
    ['<div id="notice">', ("p", "-", w(30)), "</div>", ("div", "-", link(2)), ("h1", "+", w(9)), *paragraphs(55, 83, 9, 47), ("div", "-", w(2)), ("div", "-", link(1)), ("div", "-", link(2)), '<div class="replies">', ("p", "-", w(45)),
     ("p", "-", w(18)), ("p", "-", w(70)), "</div>"],
    # pages with one block, a heading and a text, or a line or two
    [("p", "+", w(5))], [("p", "+", w(1))], [("p", "+", w(3))], [("p", "+", w(8))], [("p", "+", w(11))], [("p", "+", w(14))], [("p", "+", w(22))], [("p", "+", w(40))], [("p", "+", w(130))], [("h1", "+", w(3))], [("h1", "+", w(4)), ("p", "+", w(60))], [("h1", "+", w(9)), ("p", "+", w(26))],
    # pages with nothing but a notice, a menu, a footer, or a text and one of these
    ['<div class="cookie-notice">', ("p", "-", w(12)), "</div>"], [*menu("nav", 1, 1, 2)], ["<footer>", ("p", "-", w(29)), "</footer>"], ["<footer>", ("p", "-", w(3)), "</footer>"], ["<aside>", ("h3", "-", w(2)), ("p", "-", w(55)), "</aside>"],
    [("h1", "+", w(5)), ("p", "+", w(45)), "<footer>", ("p", "-", w(28)), "</footer>"], ["<aside>", ("h3", "-", w(3)), ("p", "-", w(27)), ("p", "-", w(31)), "</aside>", ("p", "+", w(36)), ("p", "+", w(90))],
    # an article of one block, and one that is all links
    [*menu("nav", 1, 1), "<article>", ("p", "+", w(6)), "</article><footer>", ("p", "-", w(7)), "</footer>"],
    [*menu("nav", 1), "<article>", ("h2", "+", link(5)), ("p", "+", link(16)), ("p", "+", link(44)), "</article>", ("p", "-", w(45)), ("p", "-", link(4))],
    # a recipe, a poem and a list of names as articles: blocks of a word or two, alone and beside long ones
    [*menu("nav", 1, 2), "<article>", ("h1", "+", w(2)), ("p", "+", w(1)), ("p", "+", w(52)), ("p", "+", w(1)), ("p", "+", w(2)), ("p", "+", w(1)), ("li", "+", w(2)), ("li", "+", w(2)), ("li", "+", w(3)), ("li", "+", link(1)),
     ("li", "+", w(1)), ("p", "+", w(70)), ("p", "+", w(2)), ("p", "+", w(110)), ("p", "+", w(1)), "</article>", ("p", "-", w(2)), ("p", "-", w(1)), "<footer>", ("p", "-", w(3)), "</footer>"],
    [("p", "-", w(2)), "<main>", ("h1", "+", w(3)), *paragraphs(5, 6, 4, 7, 6, 5, 1, 6, 6, 2, 4, 5, 3, 3, 1), "</main>", ("p", "-", w(6)), ("p", "-", w(4)), ("div", "-", link(2))],
    [("div", "-", link(1)), "<article>", ("h2", "+", link(2)), ("td", "+", link(2)), ("td", "+", w(1)), ("td", "+", link(3)), ("td", "+", w(2)), ("td", "+", link(1)), ("td", "+", w(1)), ("p", "+", w(2)), ("p", "+", w(44)), ("p", "+", link(2)), ("p", "+", w(1)),
     ("p", "+", link(1)), ("p", "+", w(31)), "</article>", ("p", "-", w(33)), ("p", "-", w(2)), ("p", "-", w(1)), ("p", "-", w(17))],
    ["<article>", ("p", "+", w(1)), ("p", "+", w(1)), ("p", "+", w(1)), ("p", "+", w(2)), ("p", "+", w(2)), '<div class="promo">', ("p", "-", w(2)), ("p", "-", w(25)), "</div>", ("p", "+", w(2)), ("p", "+", w(48)), ("p", "+", w(3)), "</article>", '<div class="newsletter">', ("p", "-", w(21)), "</div>", ("p", "-", w(3))],
    # articles at the end of a page, below a menu
    [*menu("nav", 1, 2), "<article>", ("p", "+", w(40)), "</article>"], [*menu("nav", 1, 1), "<main>", ("p", "+", w(3)), "</main>"], [*menu("nav", 2, 1, 1), "<article>", ("h1", "+", w(5)), ("p", "+", w(12)), ("p", "+", w(12)), "</article>"],
    ["<article>", ("p", "+", w(9)), ("li", "+", link(3)), ("p", "+", w(2)), "</article>"], ["<main>", ("p", "+", w(4)), ("li", "+", link(2)), ("li", "+", link(5)), ("p", "+", w(13)), "</main>"], [*menu("nav", 1), "<article>", ("p", "+", w(7)), "</article>"],
    # articles with lists of links between short and long paragraphs
    ["<article>", ("li", "+", link(4)), ("p", "+", w(30)), ("p", "+", w(2)), ("li", "+", link(6)), ("p", "+", w(12)), ("p", "+", w(4)), ("li", "+", link(3)), ("p", "+", w(3)), ("p", "+", w(1)), "</article>", ("p", "-", w(3))],
    [*menu("nav", 1), "<main>", ("h1", "+", w(6)), ("li", "+", link(7)), ("li", "+", link(4)), ("p", "+", w(9)), ("p", "+", w(3)), ("td", "+", link(3)), ("td", "+", w(4)), ("td", "+", w(2)), ("td", "+", link(5)), ("p", "+", w(61)), ("p", "+", w(4)), "</main>",
     ("div", "-", link(4)), ("div", "-", w(4)), ("div", "-", w(2)), ("div", "-", link(1))],
    # long texts around an article: terms and a teaser outside of it
    [("p", "-", w(70)), "<article>", ("h1", "+", w(5)), *paragraphs(12, 30, 100, 260), "</article>", ("h2", "-", w(3)), ("p", "-", w(90)), ("p", "-", w(8)), '<form class="search">', ("label", "-", w(2)), "</form>"],
)


def html_and_labels(pieces: list) -> tuple[str, list[int]]:
    """A page's html, and the label of each of its blocks in order."""
    out, labels = [], []
    for piece in pieces:
        if isinstance(piece, str):
            out.append(piece)
        else:
            tag, label, text = piece
            out.append(f"<{tag}>{text}</{tag}>")
            labels.append(int(label == "+"))
    return "<html><body>" + "".join(out) + "</body></html>", labels
