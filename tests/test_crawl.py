"""The crawl plan against a queue-driven walk, and its bounds."""

import random

import pytest
from pyspark.sql import functions as F

from seine.operators.filters import UrlFilter
from seine.operators.fetchlog import outcome_listing, wave_progress
from seine.plans import ranked
from seine.plans.crawl import CrawlPolicy, crawl, first_discovery, frontier_order, queue_stats
from seine.sources import robots


def run(spark, graph, seeds, policy=CrawlPolicy(), status=None, **options):
    edges = spark.createDataFrame([(s, i, d) for s, ds in graph.items() for i, d in enumerate(ds)] or [("-", 0, "-")],
                                  "src_url string, pos int, dst_url string")
    known = [(u, (status or {}).get(u, 200), 10) for u in graph]
    pages = spark.createDataFrame(known or [("-", 200, 1)], "url string, status_code int, n_bytes int")
    start = spark.createDataFrame([(u, i) for i, u in enumerate(seeds)], "url string, pos int")
    return crawl(start, edges, pages, policy, **options)


def outcomes(result):
    return {r.url: r.outcome for r in result.results.collect()}


def queue_walk(graph, seeds, max_depth, max_pages, status):
    """A first-in-first-out walk, one URL at a time."""
    seen, queue, depth_of = set(), [], {}
    for url in seeds:
        if url not in seen:
            seen.add(url)
            queue.append(url)
            depth_of[url] = 0
    visited = []
    for depth in range(max_depth + 1):
        wave = []
        while queue and len(visited) + len(wave) < max_pages:
            wave.append(queue.pop(0))
        visited += wave
        for url in wave if depth < max_depth else []:
            if url in graph and status.get(url, 200) < 400:
                for link in graph[url]:
                    if link not in seen:
                        seen.add(link)
                        queue.append(link)
                        depth_of[link] = depth + 1
    return visited, depth_of


def test_depth_limit(spark):
    chain = {"0": ["1"], "1": ["2"], "2": ["3"], "3": []}
    assert set(outcomes(run(spark, chain, ["0"], CrawlPolicy(max_depth=1)))) == {"0", "1"}


def test_cycle_visits_once(spark):
    result = run(spark, {"a": ["b", "c"], "b": ["a", "c"], "c": ["a"]}, ["a"], CrawlPolicy(max_depth=5))
    assert sorted(r.url for r in result.results.collect()) == ["a", "b", "c"]
    assert queue_stats(result).first().asDict() == {"queued": 0, "seen": 3, "processed": 3, "failed": 0}


def test_no_seeds(spark):
    empty = spark.createDataFrame([], "url string, pos int")
    edges = spark.createDataFrame([("a", 0, "b")], "src_url string, pos int, dst_url string")
    pages = spark.createDataFrame([("a", 200, 1)], "url string, status_code int, n_bytes int")
    result = crawl(empty, edges, pages)
    assert result.results.count() == 0 and result.waves.count() == 0


@pytest.mark.parametrize("seed,budget", [(1, 1000), (2, 37), (3, 12)])
def test_matches_a_queue_walk(spark, seed, budget, monkeypatch):
    rnd = random.Random(seed)
    graph = {f"p{i}": [f"p{rnd.randint(0, 140)}" for _ in range(rnd.randint(0, 4))] for i in range(120)}
    status = {u: 503 for u in graph if rnd.random() < 0.15}
    seeds = ["p3", "p9", "p3", "p70"]
    if seed == 2:  # the budget cut for large budgets
        monkeypatch.setattr(ranked, "TOP_K_ROWS", 0)
    result = run(spark, graph, seeds, CrawlPolicy(max_depth=3, max_pages=budget), status)
    visited, depth_of = queue_walk(graph, seeds, 3, budget, status)
    ordered = [r.url for r in result.results.orderBy("depth", "path").collect()]
    assert ordered == visited
    assert {r.url: r.depth for r in result.discovered.collect()} == depth_of
    got = outcomes(result)
    assert {u for u, o in got.items() if o == "failed"} == {u for u in visited if u not in graph or u in status}


def test_array_links_give_the_same_crawl(spark):
    graph = {"a": ["b", "c"], "b": ["d"], "c": [], "d": []}
    listed = spark.createDataFrame(list(graph.items()), "src_url string, links array<string>")
    pages = spark.createDataFrame([(u, 200, 1) for u in graph], "url string, status_code int, n_bytes int")
    start = spark.createDataFrame([("a", 0)], "url string, pos int")
    assert {r.url for r in crawl(start, listed, pages).results.collect()} == set(graph)


def test_outcome_cascade(spark):
    graph = {"http://h/": ["http://h/private/x", "http://h/gone", "http://h/big", "http://h/open", "http://h/lost", "http://10.0.0.1/", "http://h/ok"]}
    docs = spark.createDataFrame([("h", "User-agent: *\nDisallow: /private/")], "host string, text string")
    rows = [("http://h/", 200, 1), ("http://h/private/x", 200, 1), ("http://h/gone", 404, 1), ("http://h/big", 200, 11),
            ("http://h/open", 200, 1), ("http://10.0.0.1/", 200, 1), ("http://h/ok", None, 1)]
    pages = spark.createDataFrame(rows, "url string, status_code int, n_bytes int")
    edges = spark.createDataFrame([("http://h/", i, d) for i, d in enumerate(graph["http://h/"])], "src_url string, pos int, dst_url string")
    result = crawl(
        spark.createDataFrame([("http://h/", 0)], "url string, pos int"), edges, pages, CrawlPolicy(max_page_bytes=10),
        robots=robots.agent_rules(robots.parse_robots(docs), "MyBot/1.0"),
        host_ips=spark.createDataFrame([("h", "8.8.8.8")], "host string, ip string"),
        open_circuits=spark.createDataFrame([("http://h/open",)], "url string"),
    )
    got = {r.url: (r.outcome, r.reason, r.status_code) for r in result.results.collect()}
    assert got == {
        "http://h/": ("processed", None, 200),
        "http://h/private/x": ("blocked", "blocked by robots.txt", 200),
        "http://h/gone": ("failed", "PermanentError: permanent HTTP 404", 404),
        "http://h/big": ("failed", "PermanentError: page exceeds 10 bytes", 200),
        "http://h/open": ("failed", "circuit open", 200),
        "http://h/lost": ("failed", "NetworkError: no capture", None),
        "http://10.0.0.1/": ("failed", "PermanentError: blocked non-public host: 10.0.0.1", 200),
        "http://h/ok": ("processed", None, 200),
    }
    assert outcome_listing(result.results, "blocked").count() == 1
    progress = wave_progress(result.results, result.waves).orderBy("depth").collect()
    assert [(r.processed, r.failed, r.blocked, r.queued) for r in progress] == [(1, 0, 0, 7), (2, 5, 1, 0)]


def test_filters_apply_to_links_but_not_seeds(spark):
    graph = {"http://a/": ["http://a/1", "http://b/1"], "http://a/1": [], "http://b/1": []}
    policy = CrawlPolicy(url_filter=UrlFilter(same_domain_only=True, exclude=["^http://a/$"]))
    assert set(outcomes(run(spark, graph, ["http://a/"], policy))) == {"http://a/", "http://a/1"}


def test_frontier_order_and_first_discovery(spark):
    frontier = spark.createDataFrame([("low", 0, 0), ("high", 10, 1), ("mid", 5, 2)], "url string, priority int, seq long")
    assert [r.url for r in frontier_order(frontier).collect()] == ["high", "mid", "low"]
    twice = spark.createDataFrame([("u", [1, 2]), ("u", [0, 9]), ("v", [5, 0])], "url string, path array<int>")
    assert {r.url: r.path for r in first_discovery(twice).collect()} == {"u": [0, 9], "v": [5, 0]}


def test_large_budget_cut_is_exact(spark, monkeypatch):
    monkeypatch.setattr(ranked, "TOP_K_ROWS", 10)
    rows = spark.range(1000).select(F.array(F.pmod(F.col("id") * 7919, F.lit(1000)).cast("int")).alias("path"))
    got = sorted(r.path[0] for r in ranked.take_first(rows, "path", 333).collect())
    assert got == list(range(333))
