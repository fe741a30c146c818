import re
import time

import pytest
from pyspark.sql import functions as F

from opinio.llm import link_trust

SCHEMA = "page_id long, url string, html string"
RULES = [*link_trust.RULES]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    best = None
    for verdict, rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best or (None, None)


URLS = [
    None, "", "nothing", "http://", "HTTP://Example.ORG/es/1", "https://a.b.example.org/en/12?x#y", "https://example.org/en/2", "http://example.org",
    "http://example.org?q=/es/", "http://notexample.org/es/1", "http://x.com/fr/1", "http://x.com/de/1#a", "ftp://x.com/fr", "a://b://c.org/x", "http://org/", "http://ÀB.org/ü",
    "http://u:p@x.org:80/a\nb", "://x.net/a",
]


def test_urls_and_rules_by_hand(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[4], "")] * 2, SCHEMA)
    got = {(r.id, r.host, r.path, r.rule) for r in link_trust.judge(df, RULES).collect()}
    want = {(r.page_id, *parts(r.url), rule_of(*parts(r.url))[0]) for r in df.collect()}
    assert got == want
    assert link_trust.judge(df, RULES).count() == df.count()
    assert link_trust.judge(df.limit(0), RULES).count() == 0
    extra = df.select("*", *[F.lit(1).alias(c) for c in ("id", "host", "path", "rule", "verdict", "src", "rank")])
    assert {(r.id, r.host, r.path, r.rule) for r in link_trust.judge(extra, RULES).collect()} == want


def test_links_of_anchors(spark):
    html = """<a href="http://b.com/x">1</a><A class=x HREF='//C.com?y'>2</a><a href=https://b.com/z>3</a><a href="/local">4</a>
    <link href="http://d.com/"><a data-href="http://e.com/" href="#">5</a><a href="http://a.com/self">6</a>"""
    df = spark.createDataFrame([(1, "http://a.com/1", html), (2, "http://a.com/2", html), (3, None, html), (4, "http://b.com", None)], SCHEMA)
    assert sorted(map(tuple, link_trust.host_links(df).collect())) == [("a.com", "b.com", 4), ("a.com", "c.com", 2)]


def pagerank(seeds, links, damping=0.85):
    rank = {h: (1 - damping) * s for h, s in seeds.items()}
    out = {}
    for a, b, n in links:
        out[a] = out.get(a, 0) + n
    for _ in range(200):
        new = {h: (1 - damping) * s for h, s in seeds.items()}
        for a, b, n in links:
            new[b] = new.get(b, 0) + damping * rank.get(a, 0) * n / out[a]
        rank = new
    return rank


def test_spread_is_personalised_pagerank(spark):
    links = [("a", "b", 3), ("a", "c", 1), ("b", "c", 2), ("c", "a", 1), ("d", "a", 5), ("e", "f", 1)]
    seeds = {"a": 1.0, "d": 0.5, "z": 0.25, "e": 0.0}
    got = {r.host: r["rank"] for r in link_trust.spread(spark.createDataFrame(list(seeds.items()), "host string, seed double"), spark.createDataFrame(links, "src string, dst string, n long"), damping=0.4, tolerance=1e-6).collect()}
    want = {h: x for h, x in pagerank(seeds, links, 0.4).items() if x > 0}
    assert got == {h: pytest.approx(x, rel=1e-4) for h, x in want.items()}


def test_verdicts_follow_links(spark):
    page = lambda i, url, *targets: (i, url, "".join(f'<a href="{t}">x</a>' for t in targets))
    data = [
        page(1, "http://good.org/a", "http://friend.net/"), page(2, "http://bad.com/de/1"), page(3, "http://friend.net/a", "http://friend2.net/"),
        page(4, "http://farm.net/a", "http://bad.com/de/1"), page(5, "http://alone.net/a"), page(6, "http://both.net/", "http://bad.com/de/1"),
        page(7, "http://friend2.net/a"), page(8, "http://behind.net/", "http://farm.net/"), page(9, "http://good.org/b", "http://both.net/"),
    ]
    got = {r.id: r for r in link_trust.judge(spark.createDataFrame(data, SCHEMA), RULES).collect()}
    assert got[3].trust > got[7].trust > 0 == got[3].distrust
    assert got[4].distrust > got[8].distrust > 0 == got[4].trust
    assert {i: r.verdict for i, r in got.items()} == {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block", 9: "allow"}


def test_main_path_has_no_python(spark):
    sf = "/root/testdata/sf0.001"
    df = link_trust.op9(spark, sf)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in df.collect():
        assert (r.host, r.path) == parts(pages[r.page_id]) and r.rule == rule_of(r.host, r.path)[0]
        assert r.verdict == rule_of(r.host, r.path)[1] if r.rule else r.verdict in ("allow", "block")


def test_broken_markup_is_read_once(spark):
    long = ['<a "' * 1_300_000, "<a href" * 700_000, "<a " + "href = " * 700_000, "<a x" + " " * 5_000_000, '<a href="' * 500_000]
    df = spark.createDataFrame([(i, "http://a.com/1", h + '<a title="x" href="http://b.com/">') for i, h in enumerate(long)], SCHEMA).coalesce(1)
    link_trust.host_links(df.limit(0)).count()
    began = time.time()
    assert link_trust.host_links(df).first().dst == "b.com"
    assert time.time() - began < 25


def test_rounds_end_by_tolerance(spark):
    """A ring of hosts: what is left after t rounds is 0.85 ** t of the mass, which fifty rounds do not bring to the tolerance."""
    links = [(f"h{i}", f"h{(i + 1) % 100}", 1) for i in range(100)]
    got = {r.host: r["rank"] for r in link_trust.spread(spark.createDataFrame([("h0", 8.0)], "host string, seed double"), spark.createDataFrame(links, "src string, dst string, n long")).collect()}
    want = pagerank({"h0": 8.0}, links)
    assert sum(abs(got.get(h, 0.0) - x) for h, x in want.items()) < 1e-4 * 8 and abs(sum(got.values()) / 8 - 1) < 1e-5
