import random

from pyspark.sql import functions as F

from ledgerline.llm.components import connected_components
from ledgerline.llm.urls import RULES, judge_urls, resolve, url_node


def rule_by_hand(host, path):
    fits = [(len(h + p), v == "allow", h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    return host, rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]


def test_rules_hosts_and_paths(spark):
    urls = [None, "", "no scheme", "http://", "https://A.Example.COM/en/x", "http://www.example.com/en/1", "http://www.example.com/en", "http://example.com/en/?q=1#f",
            "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/es", "http://net/fr/", "ftp://x.org#frag", "http://x.com?a=/en/", "http://x.com/#", "a://b://c/d",
            "http://É.com/x", "http://x.com:80/en/"]
    out = judge_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")).collect()
    for r in out:
        host, path = split(urls[r["page_id"]])
        rule, verdict = rule_by_hand(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), urls[r["page_id"]]
        assert r["verdict"] == (verdict or "allow")


def test_links_resolve(spark):
    base, cases = "http://h.org/a/b?q=1", {"http://x.org/1": "x.org/1", "//y.org/z/": "y.org/z", "/root": "h.org/root", "c": "h.org/a/c", "?p=2": "h.org/a/b?p=2",
                                          "https://X.org:443/q/?utm_source=a&b=1&a=2#f": "x.org/q?a=2&b=1", "#top": "h.org/a/b?q=1"}
    for link, node in cases.items():
        assert spark.range(1).select(url_node(resolve(F.lit(base), F.lit(link)))).first()[0] == node, link


def test_aliases_share_verdicts(spark):
    link = '<html><head><link href="{}" rel="canonical"></head></html>'.format
    go = '<meta content="0; url={}" http-equiv="Refresh">'.format
    pages = [(1, "http://a.org/1", link("http://b.org/1")), (2, "http://b.org/1", go("https://x.net/es/5")), (3, "https://x.net/es/5", None),
             (4, "http://c.org/1", link("http://www.example.com/en/9")), (5, "http://d.org/1", "".join([link("http://c.org/1"), go("http://x.net/fr/1")])),
             (6, "http://e.org/1?utm_source=q#f", ""), (7, "http://e.org/1", link("http://y.net/fr/2")), (8, "http://z.org/", "<p>no</p>"), (3, "https://x.net/es/5", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("node", F.lit("clash"))
    got = sorted((r["page_id"], r["verdict"]) for r in judge_urls(df).collect())
    assert got == [(1, "block"), (2, "block"), (3, "block"), (3, "block"), (4, "allow"), (5, "allow"), (6, "block"), (7, "block"), (8, "allow")]
    assert judge_urls(df.limit(0)).count() == 0
    log = spark.createDataFrame([("http://z.org/", "http://q.net/es/")], "u string, v string")
    assert {r["verdict"] for r in judge_urls(df.where("page_id = 8"), links=log).collect()} == {"block"}


def test_components_against_brute_force(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5001 + i) for i in range(200)]
    edges += [(7, 7), (None, 3), (4, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in root} and len(got) == len(root)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_the_sql_statement_follows_links_alike(spark):
    import duckdb

    from ledgerline.llm.registry import ORACLE

    link, go = '<link href="{}" rel="canonical">'.format, '<meta http-equiv="refresh" content="0; url={}">'.format
    pages = [(1, "http://a.org/1", link("http://b.org/1")), (2, "http://b.org/1", go("https://x.net/es/5?utm_a=1")), (3, "https://X.net:443/es/5/", None),
             (4, "http://c.org/d/1", link("2")), (5, "http://c.org/d/2", go("//www.example.com/en/1")), (6, "http://e.org", link("/q?b=1&amp;a=2")),
             (7, "http://e.org/q?a=2&b=1#z", link("http://y.net/fr/2")), (8, None, None), (9, "x", link("http://y.net/fr/2"))]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = sorted(con.execute(ORACLE["op9_url_filter"]).fetchall())
    got = sorted(tuple(r) for r in judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    assert got == want
    assert [r[4] for r in want] == ["block", "block", "block", "allow", "allow", "block", "block", "allow", "allow"]
