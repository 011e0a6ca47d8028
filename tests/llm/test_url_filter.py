from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from siltworks.llm import queries, url_filter

SCHEMA = "page_id long, url string, html string, host string, trust string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "/?#" if c in rest]
    host = rest[: min(ends)] if ends else rest
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def ruled(host, path):
    best = None
    for r in queries.URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            text = r.host + r.path
            if best is None or len(text) > len(best[0]):
                best = (text, r.verdict)
    return best


def link(host):
    return f'<a href="http://{host}/p">x</a> <A class=b HREF=//{host.upper()}/q>y</A> <a href="/own">z</a>'


def pages():
    rows = [
        (1, "http://a.com/x", link("b.org") + link("c.org")), (2, "https://WWW.Example.com/en/1?q#f", ""), (3, "http://example.com/en/2", None),
        (4, "http://m.example.com/en/", link("b.org")), (5, "http://x.net/es/a", link("b.org")), (6, "http://x.net/fr/a", ""), (7, "http://x.net/en/a", ""),
        (8, "http://far.org/", link("x.net") + link("x.net")), (9, "http://farther.org/a", link("far.org")), (10, "http://b.org", link("c.org")),
        (11, "http://c.org/?u=http://x.net/es/", link("x.net") + link("b.org")), (12, None, link("x.net")), (13, "nothing", "<a href='http://'>"), (14, "http://", ""),
        (15, "HTTP://ÄB.Org/É", ""), (16, "http://far.org/", link("x.net")), (16, "http://far.org/", link("x.net")), (17, "http://net/es", ""), (18, "http://y.net", ""),
        (19, "http://evilnet/es/", ""), (20, "http://u@a.com:80/", ""), (21, "x" * 50_000 + "://h.com/" + "p" * 50_000, "y" * 100_000),
    ]
    return [(*r, "h", "t") for r in rows]


def expected(rows):
    at = {r[0]: split(r[1]) for r in rows}
    by, edges = defaultdict(list), Counter()
    for page_id, _, html, *_ in rows:
        host, path = at[page_id]
        if host:
            rule = ruled(host, path)
            by[host].append(rule and rule[1])
            targets = {t for t in ("b.org", "c.org", "x.net", "far.org") if html and f"http://{t}/" in html}
            edges.update((host, t) for t in targets if t != host)
    seed = {v: {h for h, found in by.items() if found.count(v) > len(found) / 2} for v in ("allow", "block")}
    out, into = Counter(), Counter()
    for (a, b), n in edges.items():
        out[a] += n
        into[b] += n
    d = url_filter.DAMPING
    base = [{h: 1 - d for h in seed["allow"]}, {h: 1 - d for h in seed["block"]}]
    score = [dict(b) for b in base]
    for _ in range(url_filter.STEPS):
        new = [defaultdict(float, base[0]), defaultdict(float, base[1])]
        for (a, b), n in edges.items():
            new[0][b] += d * n / out[a] * score[0].get(a, 0)
            new[1][a] += d * n / into[b] * score[1].get(b, 0)
        score = new
    result = []
    for page_id, *_ in rows:
        host, path = at[page_id]
        rule = ruled(host, path)
        t, u = score[0].get(host, 0), score[1].get(host, 0)
        method = "block" if u > t and u >= url_filter.THRESHOLD * (1 - d) else "allow"
        result.append((page_id, host, path, rule[0] if rule else None, rule[1] if rule else method))
    return result


def test_judgement_equals_brute_force(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA)
    found = url_filter.judge(df, queries.URL_RULES).select("page_id", "host", "path", "rule", "verdict")
    want = expected(rows)
    assert sorted(map(tuple, found.collect())) == sorted(want, key=lambda r: r[0])
    verdicts = {r[0]: r[4] for r in want if r[3] is None}
    assert verdicts[8] == "block" and verdicts[10] == "allow"  # links to a blocked host; is linked by a trusted one


def test_empty_and_without_rules(spark):
    assert url_filter.judge(spark.createDataFrame([], SCHEMA), queries.URL_RULES).count() == 0
    found = url_filter.judge(spark.createDataFrame(pages(), SCHEMA), []).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in found] == [(None, "allow")]


@pytest.mark.parametrize(("url", "host", "path"), [("a://b", "b", ""), ("a://b?c/d", "b", ""), ("a://B/c?d#e", "b", "/c"), ("//b/c", "", ""), ("a://b\n/c", "b\n", "/c")])
def test_parts(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(url_filter.host_of("url"), url_filter.path_of("url")).first()
    assert tuple(row) == (host, path) == split(url)


def test_many_linkers_and_targets_without_pages(spark):
    to = lambda *urls: "".join(f'<a href="http://{u}">x</a>' for u in urls)
    rows = [(0, "http://hub.net/es/", "")]
    rows += [(i, f"http://farm{i}.org/", to("hub.net/es/")) for i in range(1, 301)]
    rows += [(i, f"http://mixed{i}.org/", to("hub.net/es/", *(f"good{k}.org/a" for k in range(9)))) for i in range(301, 401)]
    rows += [(401, "http://one.org/", to("unseen.net/fr/x", "unseen.net/fr/y")), (402, "http://two.org/", to("free.net/en/x", "other.net/"))]
    df = spark.createDataFrame([(*r, "h", "t") for r in rows], SCHEMA)
    found = {r["page_id"]: r["verdict"] for r in url_filter.judge(df, queries.URL_RULES).collect()}
    assert {found[i] for i in range(1, 301)} == {"block"}  # however many link to it
    assert {found[i] for i in range(301, 401)} == {"allow"}  # one link of ten
    assert (found[401], found[402]) == ("block", "allow")
