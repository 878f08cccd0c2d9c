import base64
import gzip
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from llm_cases import ordered
from oracle_check import compare, duck

from tarmac.llm import html, neardup, urlfilter, warc

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, host int, payload_bytes string"
ODD_PAGES = [(1, "http://a.org/1", "", "x", 1, None), (1, "http://a.org/1", "", "x", 1, None),
             (2, None, None, None, None, None), (None, "http://a.org/2", "plain", None, None, None),
             (3, "no scheme", "<p>x", None, None, None), (4, "http://a.org/\n4", "plain", None, None, "y")]


def expected_records(pages, min_bytes=0):
    by = defaultdict(list)
    for page_id, payload in pages:
        by[(payload or "").encode()].append(page_id)
    out = []
    for payload, ids in by.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        ids.sort(key=lambda x: (x is not None, x), reverse=True)
        for k, i in enumerate(ids):
            alone = k == 0 or len(payload) < min_bytes
            out.append((i, len(payload), digest, "response" if alone else "revisit", None if alone else ids[0]))
    return Counter(out)


def test_archives_round_trip(spark, scratch):
    rng = random.Random(1)
    base = ["", "\r\n", "\r\n\r\n", "abc\r\n", "abc\r\n\r\n", "a\r\n\r\r\n\r\n\r\nb", "\r", "\n", "x\r\n\r", "é 𝒳",
            "WARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\n", "\r\n\r\n\r\n\r\n\r\n", None, "plain", "z" * 200_000]
    pages = [(i, f"http://x/{i}\r\nX: y", rng.choice(base)) for i in range(200)]
    pages += [(1000 + i, None, "".join(rng.choice("\r\na") for _ in range(rng.randrange(9)))) for i in range(300)]
    pages += [(5, "u", "plain"), (5, "v", "plain"), (None, None, "plain"), (None, "q", "only"), (None, "q", "only")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for least in (0, 4):
        path = scratch("warc-test")
        warc.write_archives(df, path, min_bytes=least)
        got = Counter(map(tuple, warc.read_archives(spark, path).collect()))
        assert got == expected_records([(i, h) for i, _, h in pages], least)


def test_archives_are_plain_warc(spark, scratch):
    path = scratch("warc-plain")
    warc.write_archives(spark.createDataFrame(ODD_PAGES, PAGES), path)
    whole = "".join(gzip.decompress(p.read_bytes()).decode() for p in Path(path).glob("*.gz"))
    assert whole.count("WARC/1.1\r\n") == len(ODD_PAGES)
    ids = re.findall(r"WARC-Record-ID: (\S+)", whole)
    assert len(set(ids)) == len(ids) and set(re.findall(r"WARC-Refers-To: (\S+)", whole)) <= set(ids)


def test_warc_odd_pages_and_query(spark, scratch):
    path = scratch("warc-odd")
    warc.write_archives(spark.createDataFrame(ODD_PAGES, PAGES), path)
    got = Counter(map(tuple, warc.read_archives(spark, path).collect()))
    assert got == expected_records([(p[0], p[2]) for p in ODD_PAGES])
    empty = scratch("warc-none")
    warc.write_archives(spark.createDataFrame([], PAGES), empty)
    assert warc.read_archives(spark, empty).count() == 0
    t = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "html"])
    expected = expected_records(zip(*[c.to_pylist() for c in t]))
    assert Counter(map(tuple, warc.query(spark, SF).collect())) == expected


def test_text_ids_round_trip(spark, scratch):
    ids = ["b", "a b", "*", "", None, "é\r\n%2A+", "10", "9", "null"]
    pages = [(i, "same" if k % 2 else f"own {k}") for k, i in enumerate(ids)]
    path = scratch("warc-text-ids")
    warc.write_archives(spark.createDataFrame(pages, "page_id string, html string").selectExpr("*", "null url"), path)
    assert Counter(map(tuple, warc.read_archives(spark, path, "string").collect())) == expected_records(pages)


@pytest.mark.parametrize("module", [warc, neardup], ids=lambda m: m.__name__)
def test_equals_sql(spark, module):
    found = compare(module.query(spark, SF), duck(SF), module.ORACLE)
    assert found["values_match"] and found["spark_rows"] > 0, found


CASES = [
    (1, "http://a.org/x", '<link rel="canonical" href="http://b.net/es/1">', "block"),
    (2, "http://c.org/y", "<META HTTP-EQUIV=Refresh content='0; url=http://a.org/x'>", "block"),
    (3, "http://d.org/z", "<link rel=canonical href=/w>", "block"),
    (4, "http://d.org/w", '<link rel="canonical" href="http://b.net/fr/2">', "block"),
    (5, "http://e.org/", '<link rel="canonical" href="http://b.net/fr/3"><link rel=canonical href="http://q.com/1">', "allow"),
    (6, None, "x", "allow"), (7, "nourl", None, "allow"),
    (8, "HTTP://WWW.Example.COM/en/1?x#y", None, "allow"), (9, "http://example.com/en/1", None, "block"),
    (10, "http://sub.example.com/en/", None, "block"), (11, "http://example.com/eN/", None, "allow"),
    (12, "http://notexample.com/en/1", None, "allow"), (13, "http://x.net/es", None, "allow"),
    (14, "http://x.net/es/", None, "block"), (15, "http://net/fr/", None, "block"),
    (16, "http://f.org/q", '<!-- <link rel="canonical" href="http://b.net/es/1"> -->', "allow"),
    (17, "HTTP://A.org:80/x#top", None, "block"), (18, "http://com", None, "allow"),
    (19, "a://b://net/es/", None, "allow"), (20, "http://g.org/a", '<script>"<link rel=canonical href=/x>"</script>', "allow"),
    *[(100 + i, f"http://chain.org/{i}", f'<link rel=canonical href="{i + 1}">', "block") for i in range(25)],
    (200, "http://chain.org/25", '<link rel="canonical" href="http://b.net/es/9">', "block"),
]


def test_url_verdicts(spark):
    df = spark.createDataFrame([(i, u, h) for i, u, h, _ in CASES], "page_id long, url string, html string")
    got = {r.page_id: r for r in urlfilter.judged(df).collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: v for i, _, _, v in CASES}
    assert (got[8].host, got[8].path, got[8].rule) == ("www.example.com", "/en/1", "www.example.com/en/")
    assert (got[19].host, got[19].path, got[19].rule) == ("b:", "//net/es/", None)
    assert (got[7].host, got[7].path, got[18].path) == ("", "", "")


def test_forms_of_a_url_are_one_node_on_request(spark):
    rows = [(1, "http://a.org/x", '<link rel="canonical" href="http://b.net/es/1">'),
            (2, "https://www.a.org/x#top", None), (3, "http://m.a.org/x?utm_source=q&gclid=1", None),
            (4, "http://a.org/x?page=2", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for forms, expected in ((True, {1, 2, 3}), (False, {1})):
        assert {r.page_id for r in urlfilter.judged(df, forms=forms).collect() if r.verdict == "block"} == expected


# Reference resolution examples of RFC 3986, 5.4, and further ones; base http://a/b/c/d;p?q.
RESOLVED = {
    "g:h": None, "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g",
    "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "g?y#s": "http://a/b/c/g?y#s",
    ";x": "http://a/b/c/;x", "g;x?y#s": "http://a/b/c/g;x?y#s", "": None, "#s": None, ".": "http://a/b/c/",
    "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/", "../g": "http://a/b/g", "../..": "http://a/",
    "../../g": "http://a/g", "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g",
    "g.": "http://a/b/c/g.", ".g": "http://a/b/c/.g", "g..": "http://a/b/c/g..", "./../g": "http://a/b/g",
    "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g;x=1/../y": "http://a/b/c/y", "g?y/./x": "http://a/b/c/g?y/./x", "g#s/../x": "http://a/b/c/g#s/../x",
    "mailto:x@y.z": None, "HTTPS://Q.org/a/../b": "HTTPS://Q.org/b", "http://q.org": "http://q.org", "a//b/..": "http://a/b/c/a//",
}


def test_links_are_resolved(spark):
    df = spark.createDataFrame([(link, "http://a/b/c/d;p?q") for link in RESOLVED], "link string, base string")
    assert {r.link: r.target for r in urlfilter.absolute(df, "link", "base", "target").collect()} == RESOLVED


def test_relative_and_based_links_spread_blocks(spark):
    block = "http://b.net/es/1"
    rows = [(1, "http://b.org/x?u=1", '<link rel=canonical href="?u=2">', "block"),
            (2, "http://b.org/x?u=2", f'<meta http-equiv=refresh content="0;url={block}">', "block"),
            (3, "http://x.net/es/7", '<link rel=canonical href="https://a.org/p/../q">', "block"),
            (4, "https://a.org:443/q", None, "block"), (5, "https://a.org/p/../q?z", None, "allow"),
            (6, "http://c.org/a/b", f'<base target=x><base href="http://d.org/e/"><link rel=canonical href="f">', "block"),
            (7, "http://d.org/e/f", f'<link rel=canonical href="{block}">', "block"),
            (8, "http://c.org/a/f", '<link rel=canonical href="javascript:void(0)">', "allow"),
            (9, "http://b.org/?u=2", None, "allow")]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in urlfilter.judged(df).collect()} == {r[0]: r[3] for r in rows}


def test_blocks_spread_as_in_a_plain_graph(spark):
    """Random links between pages, some of them relative, against a union of sets."""
    from urllib.parse import urldefrag, urljoin
    rng = random.Random(9)
    hosts = ["a.org", "b.org", "example.com", "www.example.com", "x.net", "y.com"]
    paths = ["/", "/en/1", "/es/2", "/p/q", "/p/r", "/p/q/../s", "/fr/3?x=1"]
    urls = [f"http://{h}{p}{q}" for h in hosts for p in paths for q in ("", "?k=1", "?k=2") if "?" not in p or not q]
    norm = lambda u: urljoin("http://z/", urldefrag(u)[0])
    for _ in range(2):
        pages, edges = [], []
        for i in range(120):
            url = rng.choice(urls)
            link = rng.choice([None, None, rng.choice(urls), rng.choice(["../s", "q", "?k=2", "/p/r", "./", "//a.org/p/q"])])
            tag = rng.choice(['<link rel="canonical" href="{}">', "<meta http-equiv='refresh' content='1; url={}'>"])
            pages.append((i, url, tag.format(link) if link else "<p>x"))
            if link:
                edges.append((norm(url), norm(urljoin(norm(url), link))))
        root = {norm(u): norm(u) for u in [p[1] for p in pages] + [e[1] for e in edges]}
        find = lambda u: u if root[u] == u else find(root[u])
        for a, b in edges:
            root[find(a)] = find(b)
        told = defaultdict(set)
        for u in [(p[1], norm(p[1])) for p in pages] + [(e[1], e[1]) for e in edges]:
            rule = plain_verdict(u[0])
            if rule[2]:
                told[find(u[1])].add(rule[3])
        expected = {}
        for i, url, _ in pages:
            rule, heard = plain_verdict(url), told[find(norm(url))]
            expected[i] = rule[3] if rule[2] else "block" if heard == {"block"} else "allow"
        df = spark.createDataFrame(pages, "page_id long, url string, html string")
        got = {r.page_id: r.verdict for r in urlfilter.judged(df).collect()}
        assert got == expected and set(got.values()) == {"allow", "block"}


def plain_verdict(url):
    host = path = ""
    if url and "://" in url:
        m = re.match(r"(?s)([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m[1]), m[2]
    fits = [(len(h + p), v == "allow", h + p, v) for h, p, v in urlfilter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_url_query_equals_plain_rules(spark):
    t = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "url"])
    expected = [(i, *plain_verdict(u)) for i, u in zip(*[c.to_pylist() for c in t])]
    assert ordered(map(tuple, urlfilter.query(spark, SF).collect())) == ordered(expected)
    odd = urlfilter.judged(spark.createDataFrame(ODD_PAGES, PAGES)).collect()
    assert ordered(map(tuple, odd)) == ordered((p[0], *plain_verdict(p[1])) for p in ODD_PAGES)
    assert urlfilter.judged(spark.createDataFrame([], PAGES)).count() == 0


def test_many_rules_are_joined(spark, monkeypatch):
    rng = random.Random(4)
    hosts = ["com", "a.com", "b.a.com", "", ".a", "net", "x.net", "a..com", "net."]
    paths = ["", "/", "/e", "/en/", "/en/1", "/é/", "/é/𝒳"]
    rules = [(rng.choice(hosts), rng.choice(paths), rng.choice(["allow", "block"])) for _ in range(25)]
    urls = [f"http://{h}{p}{q}" for h in [*hosts, "z.b.a.com", "aa.com"] for p in paths for q in ("", "x", "?k")]
    pages = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string")
    df = pages([(i, u, None) for i, u in enumerate([*urls, None, "x"])])
    few = ordered(map(tuple, urlfilter.judged(df, rules).collect()))
    monkeypatch.setattr(urlfilter, "IN_EXPRESSION", 0)
    assert ordered(map(tuple, urlfilter.judged(df, rules).collect())) == few
    assert len({r[3] for r in few}) > 8
    monkeypatch.setattr(urlfilter, "BROADCAST_ROWS", 0)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert ordered(map(tuple, urlfilter.judged(df, table).collect())) == few
    block = [(f"h{i}.org", "/", "block") for i in range(20_000)]
    got = urlfilter.judged(pages([(1, "http://q.h19999.org/a", None), (2, "http://h20000.org/", None)]), block).collect()
    assert {r.page_id: r.verdict for r in got} == {1: "block", 2: "allow"}
    monkeypatch.undo()
    assert {r.verdict for r in urlfilter.judged(df, []).collect()} == {"allow"}


def test_minimum_cut_is_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randrange(1, 9)
        score = [rng.choice([-3.0, -1.0, -0.5, 0.25, 0.75, 2.0]) for _ in range(n)]
        ties = [(a, b, rng.choice([0.25, 0.5, 1.0])) for a in range(n) for b in range(a + 1, n) if rng.random() < .4]

        def cost(side):
            return (sum(x for x, s in zip(score, side) if x > 0 and not s)
                    + sum(-x for x, s in zip(score, side) if x < 0 and s)
                    + sum(w for a, b, w in ties if side[a] != side[b]))

        best = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert abs(cost(html.minimum_cut(score, ties)) - best) < 1e-9


def test_main_text_of_pages(spark):
    import html as entities
    t = pq.read_table(f"{SF}/pages.parquet", columns=["page_id", "url", "html"])
    expected = []
    for i, u, h in zip(*[c.to_pylist() for c in t]):
        article = re.search(r"<article>(.*?)(</article>|$)", h, re.S).group(1)
        parts = [" ".join(entities.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split())
                 for p in re.split(r"</?(?:h1|p)>", article)]
        text = "\n\n".join(p for p in parts if p)
        expected.append((i, u, text, len(text)))
    assert ordered(map(tuple, html.query(spark, SF).collect())) == ordered(expected)


def test_main_text_leaves_out_boilerplate():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav>Menu</nav>
    <div class="cookie-notice"><p>We use cookies.</p></div><article><header><h1>Head&shy;line</h1></header>
    <p>First &amp; <i>best</i>&nbsp;part.<script>var x="<p>no</p>"</script></p><div class="ad">Buy!</div>
    <aside>See also</aside><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><form>Name <input></form>
    <p>Last<br>line &lt;end&gt;</article><section id="comments"><article class="comment">Nice!</article></section>
    <footer>&copy; me</footer></body></html>"""
    text = html.main_text(page, html.DEFAULT_WEIGHTS)
    assert text.split("\n\n") == ["Head\u00adline", "First & best part.", "one", "two", "a", "b", "Last line <end>"]


def test_html_odd_pages(spark):
    assert [html.main_text(p, html.DEFAULT_WEIGHTS) for p in (None, "", "<", "<p", "<!-- x", "<script>x")] == [""] * 6
    for bad in ["<a \"" * 3000, "<" * 9000, "<div>" * 3000 + "a" + "</span>" * 3000, "&#" * 5000, "</p></li>" * 3000]:
        html.main_text(bad, html.DEFAULT_WEIGHTS)
    got = html.extracted(spark.createDataFrame(ODD_PAGES, PAGES))
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == len(ODD_PAGES)
    assert html.extracted(spark.createDataFrame([], PAGES)).count() == 0
    assert np.array_equal(html.fit(np.zeros((0, 7)), np.zeros(0)), html.DEFAULT_WEIGHTS)


def test_comment_signs_in_scripts_open_nothing():
    for inner in ('var s="<!--";', 'if (a<b) { x = "<div>"; }', "<!-- a --> <b"):
        page = f"<script>{inner}</script><article><p>Hello there, this is the article.</p></article><div>more</div>"
        assert html.main_text(page, html.DEFAULT_WEIGHTS).startswith("Hello there, this is the article.")
        assert "<" not in html.main_text(page, html.DEFAULT_WEIGHTS)


def test_implied_closes_look_at_all_open_elements():
    deep = "<b>" + "<div>" * 12
    page = f"<main><table><tr><td>one{deep}<td>two</table></main>"
    assert "\n\n".join(html.main_text(page, html.DEFAULT_WEIGHTS).split("\n\n")) == "one\n\ntwo"


STORY = " ".join(f"The train left the town at {k} in the morning, and nobody was there to see it." for k in range(8))


def test_names_of_two_meanings_are_left_to_the_cut():
    for name in ("rail-trail-story", "legal-post", "header_entry x"):
        page = f'<article><h1>T</h1><div class="{name}"><p>{STORY}</p><p>{STORY}</p></div></article>'
        assert html.main_text(page, html.DEFAULT_WEIGHTS) == f"T\n\n{STORY}\n\n{STORY}"
    for name in ("related-story", "ad-post", "comment-entry", "sidebar-content", "rail-trail"):
        page = f'<article><h1>T</h1><p>{STORY}</p><div class="{name}"><p>{STORY}</p></div></article>'
        assert html.main_text(page, html.DEFAULT_WEIGHTS) == f"T\n\n{STORY}"
    # Of a doubtful name's blocks the cut keeps what reads as prose and drops lists of links.
    page = f"""<div class="rail-story"><p>{STORY}</p><p>Left at nine</p><p>{STORY}</p></div><div class="skip-entry">
    <ul><li><a href=1>Go</a><li><a href=2>Up</a><li><a href=3>Top</a><li><a href=4>More</a></ul></div>"""
    kept = html.main_text(page, html.DEFAULT_WEIGHTS).split("\n\n")
    assert kept == [STORY, "Left at nine", STORY]
    found = html.blocks(page)
    alone = np.clip(html.features(found) @ html.DEFAULT_WEIGHTS, -html.TEXT_LIMIT, html.TEXT_LIMIT) > 0
    assert all(b.side == 0 for b in found) and not alone[1]  # the cut changed its label


def test_training_looks_at_marked_pages_only(spark, monkeypatch):
    marked = f"<nav><a href=1>Menu</a></nav><main><p>{STORY}</p></main>"
    rows = [(k, "u", "<p>nothing here tells</p>") for k in range(400)] + [(1000 + k, "u", marked) for k in range(6)]
    rows += [(2000, "u", '<div class="x side-menu">a</div>'), (2001, "u", "<p hidden>b</p>"), (2002, "u", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    kept = {r[0] for r in df.filter(html._marked(df.html)).select("page_id").collect()}
    assert kept == {*range(1000, 1006), 2000, 2001}
    monkeypatch.setattr(html, "TRAIN_PAGES", 8)
    got = html.train(df)
    cut = [html.blocks(p) for _, _, p in rows if p]
    x = np.array([html.features(c)[k] for c in cut for k, b in enumerate(c) if b.side])
    y = np.array([float(b.side > 0) for c in cut for b in c if b.side])
    assert np.allclose(got, html.fit(x, y)) and not np.array_equal(got, html.DEFAULT_WEIGHTS)
