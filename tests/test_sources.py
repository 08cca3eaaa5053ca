"""Lookups, robots, sitemaps, seeds and URL filters."""

import random
from urllib.robotparser import RobotFileParser

import pytest

from seine.operators import filters
from seine.sources import captures, robots, sitemaps


def test_lookup_returns_every_url_once(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("a",)], "url string")
    stored = spark.createDataFrame([("a", "<p>"), ("c", "x")], "url string, html string")
    assert sorted(map(tuple, captures.lookup_captures(wanted, stored).collect())) == [("a", "<p>"), ("b", "")]


def test_fetch_and_parse(spark, tmp_path):
    spark.createDataFrame([("http://a/", "<title>T", 200, "")], "url string, html string, status_code int, content_type string") \
        .write.parquet(str(tmp_path / "c"))
    assert captures.fetch_and_parse(spark, str(tmp_path / "c")).first().title == "T"


def checked(spark, text, agent, urls):
    docs = spark.createDataFrame([("h", text)], "host string, text string")
    bound = robots.agent_rules(robots.parse_robots(docs), agent)
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    return {r.url: (r.robots_allowed, r.crawl_delay) for r in robots.check_robots(frame, bound).collect()}


def test_robots_access_and_delay(spark):
    got = checked(spark, "User-agent: *\nCrawl-delay: 7\nAllow: /ledger/open\nDisallow: /ledger", "Reader/3",
                  ["http://h/ledger/2024", "http://h/ledger/open/1", "http://h/tide", "http://other/ledger/2024"])
    assert got == {
        "http://h/ledger/2024": (False, 7.0), "http://h/ledger/open/1": (True, 7.0), "http://h/tide": (True, 7.0), "http://other/ledger/2024": (True, 0.0),
    }


def test_robots_agree_with_the_standard_parser(spark):
    texts = [
        "User-agent: a\nUser-agent: MyBot\nDisallow: /x\n\nUser-agent: *\nDisallow: /\n",
        "Disallow: /early\nUser-agent: *\nAllow: /a/b\nDisallow: /a\nCrawl-delay: 1.5\n",
        "User-agent: mybot\n\nUser-agent: *\nDisallow:\n",
        "User-agent: bot # part\nDisallow: /caf%C3%A9\nDisallow: /q?x=1\nDisallow: *\nCrawl-delay: 7\n",
        "User-agent: *\nDisallow: /one\n\nUser-agent: *\nDisallow: /two\n",
        "# nothing\n\n", "",
    ]
    paths = ["/", "/x/1", "/early", "/a/b/c", "/a/z", "/café", "/q?x=1&y", "/one", "/two#f", ""]
    for agent in ("MyBot/1.0", "Other/2"):
        docs = spark.createDataFrame([(f"h{i}", t) for i, t in enumerate(texts)], "host string, text string")
        bound = robots.agent_rules(robots.parse_robots(docs), agent)
        urls = spark.createDataFrame([(f"http://h{i}{p}",) for i in range(len(texts)) for p in paths], "url string")
        got = {r.url: (r.robots_allowed, r.crawl_delay) for r in robots.check_robots(urls, bound).collect()}
        for i, text in enumerate(texts):
            parser = RobotFileParser()
            parser.parse(text.splitlines())
            for path in paths:
                url = f"http://h{i}{path}"
                assert got[url] == (parser.can_fetch(agent, url), float(parser.crawl_delay(agent) or 0.0)), (text, url)


NS = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:i="http://image"'


def sitemap(*locs, tag="url", root="urlset"):
    return f"<{root} {NS}>" + "".join(f"<{tag}><loc> {loc} </loc></{tag}>" for loc in locs) + f"</{root}>"


def expand(spark, docs, root):
    frame = spark.createDataFrame(list(docs.items()), "url string, xml string")
    roots = spark.createDataFrame([(root,)], "url string")
    return [r.loc for r in sitemaps.expand_sitemaps(roots, frame).orderBy("path").collect()]


def test_sitemap_documents(spark):
    docs = {
        "s": sitemap("http://a/1", "http://a/1", "http://a/2"), "bad": "<urlset><loc>", "none": "",
        "img": f"<urlset {NS}><url><loc>p</loc><i:image><i:loc>q</i:loc></i:image><loc/></url></urlset>",
    }
    rows = sitemaps.sitemap_locs(spark.createDataFrame(list(docs.items()), "url string, xml string")).collect()
    assert [r.loc for r in rows if r.url == "s"] == ["http://a/1", "http://a/1", "http://a/2"]
    assert [r.loc for r in rows if r.url == "img"] == ["p", "q"]
    assert {r.url for r in rows} == {"s", "img"}


def test_sitemap_index_is_followed_in_document_order(spark):
    index = lambda *children: sitemap(*children, tag="sitemap", root="sitemapindex")
    docs = {"i": index("b", "missing", "n", "a"), "a": sitemap("a1"), "b": sitemap("b1", "b2"), "n": index("a"), "loop": index("loop")}
    assert expand(spark, docs, "i") == ["b1", "b2", "a1", "a1"]
    assert expand(spark, docs, "loop") == []
    assert expand(spark, docs, "nowhere") == []
    deep = {f"d{n}": index(f"d{n + 1}") for n in range(4)} | {"d4": sitemap("x")}
    assert expand(spark, deep, "d0") == [] and expand(spark, deep, "d1") == ["x"]


def test_seeds(spark):
    start = spark.createDataFrame([("u", 0)], "url string, pos int")
    assert [r.url for r in sitemaps.seed_urls(start).collect()] == ["u"]
    with pytest.raises(ValueError):
        sitemaps.seed_urls(start.limit(0))


def test_url_filter_rules(spark):
    seeds = spark.createDataFrame([("http://site.com/",), ("http://b.org/x",)], "url string")
    links = ["http://site.com/a", "http://b.org/", "http://sub.site.com/", "http://other.com/", "http://site.com/skip.pdf"]
    frame = spark.createDataFrame([(u,) for u in links], "dst_url string")
    passed = lambda f: {r.dst_url for r in f.apply(frame, seeds).collect()}
    assert passed(filters.UrlFilter()) == set(links)
    assert passed(filters.UrlFilter(same_domain_only=True)) == {links[0], links[1], links[4]}
    assert passed(filters.UrlFilter(exclude=[r"\.pdf$"], include=["site"])) == {links[0], links[2]}
    with pytest.raises(ValueError):
        filters.UrlFilter(exclude=["("]).apply(frame, seeds)


def test_host_guard(spark):
    urls = spark.createDataFrame([("http://ok.com/",), ("http://in.net/",), ("http://10.0.0.1/",), ("http://new.io/",), ("x",)], "url string")
    ips = spark.createDataFrame([("ok.com", "8.8.8.8"), ("in.net", "8.8.4.4"), ("in.net", "fe80::1")], "host string, ip string")
    got = {r.url for r in filters.guard_hosts(urls, ips).where("host_blocked").collect()}
    assert got == {"http://in.net/", "http://10.0.0.1/"}
    assert filters.guard_hosts(urls, ips, enabled=False).where("host_blocked").count() == 0


def test_size_cap_is_strict(spark):
    rows = spark.createDataFrame([("x" * 10, None), ("é" * 5, None), ("x" * 11, None), ("x", 99)], "html string, declared int")
    got = [r.o for r in rows.select(filters.is_oversize(rows.html, 10, rows.declared).alias("o")).collect()]
    assert got == [False, False, True, True]


def test_seen_urls_are_dropped(spark):
    rnd = random.Random(1)
    urls = [f"u{rnd.randint(0, 50)}" for _ in range(80)]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    seen = spark.createDataFrame([("u1",), ("u2",)], "url string")
    assert {r.url for r in filters.drop_seen(frame, seen).collect()} == set(urls) - {"u1", "u2"}
