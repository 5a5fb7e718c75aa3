"""URL filters: rules and aliases against plain Python and SQL; made links on the given pages."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from lakecraft.llm import urls as U
from tests.conftest import SF_MID, SF_SMALL

SHAPE = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    h = re.match(r"[^/?#]*", rest).group()
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
    return lower, re.match(r"[^?#]*", rest[len(h):]).group()


def name(url):
    if url is None or "://" not in url:
        return None
    rest = url.split("://", 1)[1]
    h, _ = split(url)
    return h + rest[len(h):].split("#", 1)[0]


def ruled(url, rules=U.RULES):
    h, p = split(url)
    fits = [(-len(rh + rp), v, rh + rp) for v, rh, rp in rules if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
    return (min(fits)[2], min(fits)[1]) if fits else (None, None)


def expected(urls, edges, rules=U.RULES):
    """verdict per url; edges are pairs of urls."""
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    of = {}
    for a, b in edges:
        x, y = name(a), name(b)
        if x is None or y is None:
            continue
        for n in (x, y):
            of[n] = ruled("x://" + n, rules)[1]
        root[find(x)] = find(y)
    said = {}
    for n, v in of.items():
        said.setdefault(find(n), set()).add(v)
    out = []
    for u in urls:
        rule, v = ruled(u, rules)
        alias = said.get(find(name(u)), set()) if name(u) in of else set()
        out.append((rule, v or ("block" if "block" in alias and "allow" not in alias else "allow")))
    return out


def canonical(target):
    return f'<html><head><title>x</title><LINK media="all" rel="canonical" href="{target}"></head><body>a</body>'


PAGES = [
    ("https://Sub.Example.NET/en/1", None), ("https://a.example.net/fr/2", ""), ("http://net/x", "x"), ("http://net", "x"), ("http://planet/x", "x"),
    ("https://x.org/fr/1", canonical("https://a.net/1")),                              # allowed by rule, linked to a blocked one
    ("https://y.org/en/1", canonical("https://x.org/fr/1")),                           # its component has an allow
    ("https://q.com/1", canonical("https://q.net/1")),                                 # blocked through an address that is no page
    ("https://r.com/1", "<meta http-equiv='refresh' content='0; URL=https://q.com/1#top'>"),
    ("http://r.com/1#part", None), ("https://s.com/dir/page?x=1", "<link rel=canonical href=/dir/other>"),
    ("https://s.com/dir/other", "<link href='third' rel='canonical'>"), ("https://s.com/dir/third", '<link rel="canonical" href="//t.example.com/de/9">'),
    ("https://u.com/", canonical("https://u.com/")), ("https://v.com/", canonical("mailto:a@b")), ("https://w.com", canonical("#top")),
    (None, canonical("https://q.net/1")), ("no scheme", canonical("https://q.net/1")), ("", None), ("https://", "<"), ("a://b://net/x", None),
    ("https://EXAMPLE.com/de/ü?q#f", None), ("https://example.com:80/de/", None), ("https://net./x", None), ("https://z.com/a?b=1", canonical("?c=2")),
    ("https://z.com/a?c=2", canonical("https://z.net/")), ("https://k.com/" + "p/" * 40_000, "<p>" * 50_000),
]
EDGES = [("https://x.org/fr/1", "https://a.net/1"), ("https://y.org/en/1", "https://x.org/fr/1"), ("https://q.com/1", "https://q.net/1"),
         ("https://r.com/1", "https://q.com/1"), ("https://s.com/dir/page?x=1", "https://s.com/dir/other"), ("https://s.com/dir/other", "https://s.com/dir/third"),
         ("https://s.com/dir/third", "https://t.example.com/de/9"), ("https://z.com/a?b=1", "https://z.com/a?c=2"), ("https://z.com/a?c=2", "https://z.net/")]


def _verdicts(df):
    return {r.page_id: (r.rule, r.verdict) for r in df.collect()}


def test_rules_aliases_and_odd_urls(spark):
    rows = [(i, u, h) for i, (u, h) in enumerate(PAGES)]
    got = U.judge(spark.createDataFrame(rows, SHAPE), U.RULES)
    want = expected([u for _, u, _ in rows], EDGES)
    found = _verdicts(got)
    assert [found[i] for i in range(len(rows))] == want
    assert {(r.host, r.path) for r in got.collect()} == {split(u) for _, u, _ in rows}
    assert found[6] == (None, "allow") and found[7][1] == found[8][1] == found[9][1] == found[10][1] == "block"


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    cur = con.execute(U.OP12_SQL)
    names = [c[0] for c in cur.description]
    got = U.op12_url_filter(spark, sf).select(*names)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_sql_walks_the_links(spark, tmp):
    """The SQL and the operator agree where pages do have links."""
    rows = [(i, u, h) for i, (u, h) in enumerate(PAGES)]
    spark.createDataFrame(rows, SHAPE).coalesce(1).write.parquet(f"{tmp}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp}/pages.parquet/*.parquet'")
    cur = con.execute(U.OP12_SQL)
    at = [c[0] for c in cur.description].index
    want = {r[at("page_id")]: (r[at("host")], r[at("path")], r[at("rule")], r[at("verdict")], r[at("reason")]) for r in cur.fetchall()}
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict, r.reason) for r in U.op12_url_filter(spark, tmp).collect()} == want


def test_redirect_chain_through_the_given_pages(spark):
    """A redirect table ties most pages to one resource: hot component, explicit allows stay."""
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").select("page_id", "url", "html").orderBy("page_id")
    urls = [r.url for r in pages.collect()]
    free = [u for u in urls if ruled(u) == (None, None)]
    bad = next(u for u in urls if ruled(u)[1] == "block")
    half = len(free) // 2
    edges = [(u, v) for u, v in zip(free[:half], free[1:half])] + [(free[0], bad), (bad, free[half - 1])] + [(free[half], free[half + 1])]
    redirects = spark.createDataFrame([*edges, (None, bad), (bad, None), ("x", bad)], "source string, target string")
    got = _verdicts(U.judge(pages, U.RULES, redirects=redirects))
    want = expected(urls, edges)
    assert [got[r.page_id] for r in pages.collect()] == want
    assert sum(v == "block" and r is None for r, v in want) >= half


def test_many_rules_by_join_equal_inline(spark):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet").select("page_id", "url", "html")
    urls = {r.page_id: r.url for r in pages.select("page_id", "url").collect()}
    hosts = sorted({split(u)[0] for u in urls.values()})
    rules = [*U.RULES, ("allow", "net", "/"), ("block", "org", "/")] + [("allow" if i % 2 else "block", h, f"/{x}") for i, h in enumerate(hosts) for x in ("en/1", "de/", "f")]
    assert len(rules) > U.INLINE
    df = spark.createDataFrame(rules, "verdict string, host string, path string")
    want = {i: ruled(u, rules) for i, u in urls.items()}
    for given in (rules, df.unionByName(df)):
        got = U.judge(pages, given, html_col=None)
        assert {r.page_id: (r.rule, r.verdict) for r in got.collect()} == {i: (r, v or "allow") for i, (r, v) in want.items()}
    none = U.judge(pages, df.where("false"), html_col=None)
    assert none.where("rule IS NULL AND verdict = 'allow' AND reason = 'none'").count() == len(urls)
    assert U.judge(pages, []).where("verdict = 'block'").count() == 0
    with pytest.raises(ValueError):
        U.judge(pages, [("maybe", "net", "/")])


def test_edges_of_the_operator(spark):
    assert U.judge(spark.createDataFrame([], SHAPE), U.RULES).count() == 0
    df = spark.createDataFrame([(1, "https://q.com/1", canonical("https://q.net/1"), "x", "y", None)] * 3 + [(None, None, None, None, None, None)],
                               SHAPE + ", Host string, VERDICT string, _llm_r string")
    got = U.judge(df, U.RULES)
    assert got.count() == 4 and [c.lower() for c in got.columns].count("host") == 1
    assert got.where("page_id = 1 AND verdict = 'block' AND reason = 'alias'").count() == 3


def test_nothing_large_is_broadcast(spark):
    """Hot keys are joined by a broadcast of at most HOT rows, the rest by shuffle."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    table = rows.select("k").distinct().withColumn("v", F.length("k")).where("v < 4")
    got = U.join_hot(rows, table, ["k"])
    want = rows.join(table, "k", "left")
    assert sorted(map(tuple, got.select("k", "id", "v").collect()), key=str) == sorted(map(tuple, want.select("k", "id", "v").collect()), key=str)
