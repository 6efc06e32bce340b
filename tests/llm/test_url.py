import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import url_graph

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
URLS = [
    "http://EXAMPLE.net/en/a?q#f", "https://www.example.net/de", "http://notexample.net", "http://example.com/de/x",
    "http://example.com/dex", "ftp://a.b.org/fr/?x=/", "http://org", "http://x.org?/fr/", "http://net#a", "no scheme", None, "",
    "://", "http:///p", "http://ÄB.net/", "http://u:p@h.net:80/en/", "x://y://z.net/p",
]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    return host, tail[:min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]


def expected(url):
    host, path = plain(url)
    fits = []
    for verdict, rule in RULES:
        name, _, prefix = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + prefix):
            fits.append((-len(rule), rule, verdict))
    return (host, path, *(min(fits)[1:] if fits else (None, "allow")))


def test_rules(spark):
    rows = [(i, u, None, "clash") for i, u in enumerate(URLS)] + [(0, URLS[0], None, None), (None, URLS[4], "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = url_graph.judge(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == expected(r["url"])
    assert url_graph.judge(pages.limit(0), RULES).count() == 0


def test_ranks_equal_a_loop(spark):
    links = {"good.org": ["a.test", "b.test"], "a.test": ["b.test", "bad.net"], "b.test": ["a.test"], "c.test": ["bad.net", "BAD.net", "c.test"],
             "bad.net": ["d.test"], "d.test": []}
    rows = []
    for i, (host, to) in enumerate(links.items()):
        page = " ".join(f"<a class=x href=\"https://{t}/p\">x</a>" for t in to) + "<a href='/own'>y</a><a href=//good.org/>z</a>" * (host == "d.test")
        rows.append((i, f"http://{host}/" + ("fr/" if host == "good.org" else "x"), page))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["host"]: r for r in url_graph.judge(pages, RULES, rounds=6).collect()}
    edges = {}
    for a, to in {**links, "d.test": ["good.org"]}.items():
        for b in map(str.lower, to):
            if a != b:
                edges[a, b] = edges.get((a, b), 0) + 1

    def rank(edges, seed):
        out = {}
        for (a, _), w in edges.items():
            out[a] = out.get(a, 0) + w
        mass = {seed: 0.15}
        for _ in range(6):
            new = {seed: 0.15}
            for (a, b), w in edges.items():
                new[b] = new.get(b, 0) + 0.85 * mass.get(a, 0) * w / out[a]
            mass = new
        return mass

    trust = rank(edges, "good.org")
    distrust = rank({(b, a): w for (a, b), w in edges.items()}, "bad.net")
    for host, r in got.items():
        assert r["trust"] == pytest.approx(trust.get(host, 0)) and r["distrust"] == pytest.approx(distrust.get(host, 0))
    assert got["c.test"]["verdict"] == "block" and got["good.org"]["verdict"] == "allow" and got["bad.net"]["verdict"] == "block"
    assert got["b.test"]["verdict"] == "allow"


def test_verdicts_do_not_fade_with_the_input(spark):
    copies, linkers = 1000, 130
    many = spark.range(copies * (linkers + 1)).selectExpr(
        "id AS page_id", f"id % {copies} AS c", f"id DIV {copies} AS n").selectExpr(
        "page_id", f"if(n = {linkers}, concat('http://bad', c, '.net/x'), concat('http://from', c, '-', n, '.test/x')) AS url",
        f"if(n = {linkers}, '', concat('<a href=\"http://bad', c, '.net/\">x</a>')) AS html")
    chain = [(-1 - i, f"http://hop{i}.test/", f"<a href='http://{f'hop{i - 1}.test' if i else 'bad0.net'}/'>x</a>") for i in range(12)]
    pages = many.unionByName(spark.createDataFrame([*chain, (-99, "http://apart.test/", "")], many.schema))
    got = {r["verdict"]: r["n"] for r in url_graph.judge(pages, RULES).groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    assert got == {"block": copies * (linkers + 1) + 12, "allow": 1}


def test_ranks_of_a_cycle_are_iterated_out(spark):
    rows = [(0, "http://bad.net/x", '<a href="http://a.test/">x</a>'), (1, "http://a.test/x", '<a href="http://bad.net/">x</a>')]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["host"]: r["distrust"] for r in url_graph.judge(pages, RULES, threshold=1.0).collect()}
    assert got["bad.net"] == pytest.approx(0.15 / (1 - 0.85**2), abs=1e-2) and got["a.test"] == pytest.approx(0.1275 / (1 - 0.85**2), abs=1e-2)
