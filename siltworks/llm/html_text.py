"""Main text of web pages: flat blocks of text, classified by a small decision tree.

A page is read as a flat list of blocks, the text between two block-level tags. Each has its number of words, its link
density (share of words inside links), the same of the block before and after it, whether it is a heading, whether it lies in the page's article or
beside it, and whether a container marks it: a menu, footer, advert, comment list and the like, told by tag name or by the
words of class, id and role. A word marks a container only if the container does not hold most of the page's text, and a name that
speaks of a state (``has-sidebar``, ``comments-enabled``) marks none, so no name of a class can silence an article. A decision tree that Spark ML
fits to the blocks of the hand-labelled pages of ``labelled_pages`` decides which
blocks are main text. The tree has a few nodes and is sent to the tasks as nested tuples; pages are independent rows.

Tags end as in browsers: at the first ``>`` outside of a quoted value, and quotes count only after an equals sign. The reader goes once
over a page, so its time grows with the page's length whatever is in it.

Defined results: null or empty html gives an empty text; unclosed and stray tags are tolerated; an unclosed tag, script,
style or comment reaches to the end of the page; an unclosed head ends where text or an element of the body begins; white space inside a block, including line breaks and no-break
spaces, becomes one space; repeated rows give equal texts; empty tables give empty results. A column of the input named
like the result is replaced.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.labelled_pages import PAGES, html_and_labels
from siltworks.llm.words import added_schema, by_value

ROWS_BACK = 512
FEATURES = ("marked", "inside", "outside", "heading", "words", "links", "words_before", "links_before", "words_after", "links_after")

#: Elements whose content is never text, elements that begin a block, and elements without content.
SILENT = frozenset("script style noscript template svg math iframe object title textarea select button canvas audio video".split())
#: Elements of a head; any other one, and text, end a head that is not closed.
OF_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that are not main text, by tag and by the words of class, id and role.
MARKED_TAGS = frozenset("nav footer aside form dialog menu search".split())
MARKED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "alert newsletter subscribe subscription signup login popup modal overlay paywall sidebar widget related recommended share sharing "
    "social breadcrumb breadcrumbs pagination pager menu menubar navbar navigation nav toolbar footer contentinfo masthead complementary "
    "comment comments commentlist disqus replies reply respond search hidden".split()
)
HEADERS = frozenset(("header", "banner", "hgroup"))

#: Words that mark what readers say, and words of names that tell a state of the page.
REMARKS = frozenset("comment comments commentlist disqus replies reply respond".split())
STATES = frozenset("has have with without no not is are can enabled disabled enable disable allow allows allowed open closed opened on off show shows hide js supports".split())

_MARKUP = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
#: An attribute: its name, and its value in quotes or without; or the end of the tag.
_ATTRIBUTE = re.compile(r"[\s/]*(?:(>)|([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([\"'])|([^\s>]*)))?)")
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in SILENT}
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")

Node = tuple  # (feature, threshold, left, right) or (label,)


def features(found: list[Block]) -> list[tuple]:
    """What the tree sees of each block of a page, in the order of ``FEATURES``."""
    marked = silenced(found)
    article = any(b.inside and not m for b, m in zip(found, marked, strict=True))
    sizes = [(0, 0.0), *((b.words, min(1.0, b.linked / b.words)) for b in found), (0, 0.0)]
    return [
        (int(m), int(b.inside), int(article and not b.inside), int(b.heading), *sizes[i + 1], *sizes[i], *sizes[i + 2])
        for i, (b, m) in enumerate(zip(found, marked, strict=True))
    ]


def labelled_blocks() -> list[tuple]:
    """Features and label of every block of the labelled pages."""
    rows = []
    for pieces in PAGES:
        page, labels = html_and_labels(pieces)
        rows += [(*x, y) for x, y in zip(features(blocks(page)), labels, strict=True)]
    return rows


def fit_tree(spark: SparkSession, labelled: Sequence[tuple] | None = None, depth: int = 12) -> Node:
    """The tree that Spark ML fits to the labelled table."""
    rows = labelled_blocks() if labelled is None else labelled
    table = spark.createDataFrame([(Vectors.dense([float(v) for v in r[:-1]]), float(r[-1])) for r in rows], ["features", "label"])
    model = DecisionTreeClassifier(maxDepth=depth, maxBins=64, seed=1).fit(table.coalesce(1))

    def node(n) -> Node:  # noqa: ANN001  a node of the JVM's tree
        if n.subtreeDepth() == 0:
            return (int(n.prediction()),)
        return (n.split().featureIndex(), n.split().threshold(), node(n.leftChild()), node(n.rightChild()))

    return node(model._java_obj.rootNode())


@dataclass(slots=True)
class Block:
    text: str
    #: Whether a tag marks it, or what readers say, or that it is hidden; and the containers around it that are marked by a word.
    marked: bool
    named: tuple[int, ...]
    inside: bool
    heading: bool
    words: int
    linked: int


def silenced(found: list[Block]) -> list[bool]:
    """Whether each block is marked. A container with at least half of the page's text is not marked by its name."""
    spoken = [b for b in found if not b.marked and b.inside] or [b for b in found if not b.marked and b.words >= 10 and 2 * b.linked <= b.words]
    held: Counter = Counter()
    for b in spoken:
        for c in b.named:
            held[c] += b.words
    most = sum(b.words for b in spoken)
    real = {c for b in found for c in b.named if 2 * held[c] < most or not most}
    return [b.marked or any(c in real for c in b.named) for b in found]


HARD, NAMED = 1, 2


def _mark(tag: str, attributes: dict[str, str], inside: bool) -> int:
    """0, ``HARD`` for what is never main text, ``NAMED`` if a word of class, id or role says so."""
    if tag in MARKED_TAGS or (tag in HEADERS and not inside):
        return HARD
    if not attributes:
        return 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _NO_DISPLAY.search(attributes.get("style", "")):
        return HARD
    if tag in ("body", "html", "main"):
        return 0
    found = 0
    for name in ("class", "id", "role"):
        for token in attributes.get(name, "").split():
            said = {x.lower() for x in _WORDS.findall(token)}
            if said & STATES:
                continue
            if said & REMARKS:
                return HARD
            if said & MARKED_WORDS or (not inside and said & HEADERS):
                found = NAMED
    return found


def markup(page: str) -> Iterator[tuple[int, int, str, bool, dict[str, str]]]:
    """Begin and end, name (empty for comments), whether it is an end tag, and attributes of each tag.

    The caller may send the place at which to go on.
    """
    at = 0
    while m := _MARKUP.search(page, at):
        begin, at = m.start(), m.end()
        if m[1] or m[3]:
            end = page.find("-->" if m[1] else ">", at - 2 if m[1] else at)  # <!--> is a whole comment
            at = len(page) if end < 0 else end + (3 if m[1] else 1)
            at = (yield begin, at, "", False, {}) or at
        elif m[2]:
            end = page.find("]]>", at)
            at = (yield begin, at, "[CDATA[", False, {}) or (len(page) if end < 0 else end + 3)
        else:
            attributes: dict[str, str] = {}
            while True:
                a = _ATTRIBUTE.match(page, at)
                if a is None or a[5]:  # the page ends within the tag
                    at = len(page)
                    break
                at = a.end()
                if a[1]:
                    break
                value = next((v for v in (a[3], a[4], a[6]) if v is not None), "")
                attributes.setdefault(a[2].lower(), value)
            closed = page.startswith("/>", max(at - 2, begin))
            if closed:
                attributes.setdefault("/", "")
            at = (yield begin, at, m[5].lower(), bool(m[4]), attributes) or at


def blocks(page: str) -> list[Block]:
    """The blocks with text, in page order."""
    out, stack, depth = [], [], Counter()  # stack of (tag, mark); depth: open tags by name, and marked ones
    pieces, linked, in_head = [], [], False
    named: list[int] = []
    heading, containers = False, 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                inside = depth["article"] + depth["main"] > 0
                out.append(Block(text, depth["*"] > 0, tuple(named), inside, heading, text.count(" ") + 1, sum(len(html.unescape(x).split()) for x in linked)))
        pieces, linked = [], []

    def say(raw: str) -> None:
        if raw:
            pieces.append(raw)
            if depth["a"]:
                linked.append(raw)

    def close(tag: str) -> None:
        nonlocal heading
        while stack:
            name, mark = stack.pop()
            depth[name] -= 1
            depth["*"] -= mark == HARD
            if mark == NAMED:
                named.pop()
            if name == tag:
                break
        heading = any(depth[h] for h in ("h1", "h2", "h3", "h4", "h5", "h6"))

    at, tags, go = 0, markup(page), None
    while True:
        try:
            begin, end, tag, ends, attributes = tags.send(go)
        except StopIteration:
            break
        go = None
        text, at = page[at:begin], end
        if in_head:
            in_head = not text.strip() and (not tag or ends or tag in OF_HEAD) and not (ends and tag in ("head", "body", "html"))
        if not in_head:
            say(text)
        if not tag:
            continue
        if tag == "[CDATA[":
            in_head = False
            stop = page.find("]]>", at)
            say(html.escape(page[at : stop if stop >= 0 else len(page)]))
            at = stop + 3 if stop >= 0 else len(page)
            continue
        if ends:
            if tag in BLOCKS:
                flush()
            if depth[tag] > 0:
                close(tag)
            continue
        if tag == "br":
            say(" ")
        if tag in BLOCKS:
            flush()
            for implied in ("p",) if tag not in ("li", "dd", "dt", "td", "th", "tr", "option") else ("p", tag):
                if stack and stack[-1][0] == implied:
                    close(implied)
        if tag in VOID:
            continue
        if tag in SILENT:  # only its own end counts, whatever else looks like a tag
            if "/" not in attributes:
                stop = _ENDS[tag].search(page, at)
                at = go = stop.end() if stop else len(page)
            continue
        if tag == "head":
            in_head = True
            continue
        if tag == "a" and depth["a"]:
            while depth["a"]:
                close("a")
        mark = _mark(tag, attributes, depth["article"] + depth["main"] > 0)
        stack.append((tag, mark))
        depth[tag] += 1
        depth["*"] += mark == HARD
        if mark == NAMED:
            containers += 1
            named.append(containers)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            heading = True
    say(page[at:])
    flush()
    return out


def _label(tree: Node, x: tuple) -> int:
    while len(tree) > 1:
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def main_text(page: str, tree: Node) -> str:
    found = blocks(page)
    return "\n".join(b.text for b, x in zip(found, features(found), strict=True) if _label(tree, x))


def extract(df: DataFrame, source: str = "html", result: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds the main text of ``source`` as ``result``; ``keep`` names the columns to pass on, all if it is not given."""
    rows = df.select(F.col(source).alias("_read"), *(F.col(f"`{c}`") for c in (df.columns if keep is None else keep) if c != result))
    tree = fit_tree(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_BACK):
                part = batch.slice(at, ROWS_BACK)
                texts = pa.array([main_text(x.as_py() or "", tree) for x in part.column(0)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], texts], [*part.schema.names[1:], result])

    return rows.mapInArrow(task, added_schema(rows.schema[1:], f"`{result}` string"))


by_value(sys.modules[__name__])
