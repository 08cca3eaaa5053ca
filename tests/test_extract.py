"""Extraction from well-formed, broken, nested and empty pages."""

import time

from pyspark.sql import functions as F

from seine import schemas
from seine.operators import extract, records
from seine.operators.page_events import extract as one

FIELDS = ("title", "text", "links", "tables", "lists", "images", "headings", "metadata")

VALID = """<!DOCTYPE html>
<html lang="en"><head><meta charset="utf-8"><meta name="keywords" content="tide, harbour">
<meta name="description" content="Times of the tide"><title>Harbour log</title></head>
<body><nav><a href="/boats">All boats</a></nav><h1>Today</h1><img alt="Map" src="/maps/bay.svg">
<p>High water at <b>noon</b>, see <a href="tables.html">the tables</a>.</p><h3>Crew</h3>
<ol><li>Ada<li>Bo</ol><a>no target</a><a href="tel:123">call</a><a href="http://weather.example.net/now">sky</a></body></html>
"""


def page(html, url="https://example.com/"):
    return dict(zip(FIELDS, one(html, url, FIELDS)[0]))


def test_valid_page():
    got = page(VALID)
    assert got["title"] == "Harbour log"
    assert got["metadata"] == {"title": "Harbour log", "description": "Times of the tide", "keywords": "tide, harbour"}
    assert "High water at noon" in got["text"] and "Harbour log" not in got["text"]
    assert got["headings"] == [{"level": "h1", "text": "Today"}, {"level": "h3", "text": "Crew"}]
    assert got["images"] == [{"src": "https://example.com/maps/bay.svg", "alt": "Map"}]
    assert got["lists"] == [{"type": "ol", "items": ["Ada", "Bo"]}]
    assert got["links"] == ["https://example.com/boats", "https://example.com/tables.html", "http://weather.example.net/now"]


def test_links_resolve_against_the_page():
    assert page(VALID, "https://example.com/port/")["links"][1] == "https://example.com/port/tables.html"


def test_broken_page():
    got = page("<body><h2>Ferry times<li>north <a href=../north?day=2>pier</h2></td><b>two &amp three")
    assert got["links"] == ["https://example.com/north?day=2"]
    assert got["text"] == "Ferry times north pier two & three"


def test_empty_page_keeps_defaults():
    for html in ("", None):
        got = page(html)
        assert got["text"] == "" and got["links"] == [] and got["metadata"]["keywords"] == ""


def test_bad_links_are_dropped_alone():
    got = page("<a href='http://[bad'>1</a><a href=' /ok#part '>2</a><a href='/ok'>3</a><a href='javascript:x'>4</a>")
    assert got["links"] == ["https://example.com/ok"]


def test_image_rules():
    got = page("<img src='a.png#f'><img src='a.png#f' alt='  x '><img src='data:image/png,1'><img alt='n'><img src>")
    assert got["images"] == [
        {"src": "https://example.com/a.png#f", "alt": ""}, {"src": "https://example.com/a.png#f", "alt": "x"},
    ]


def test_nested_lists_repeat_in_the_outer_one():
    got = page("<ul><li>a<ol><li>b<li>c</ol><li>d</ul><ol></ol>")
    assert got["lists"] == [
        {"type": "ul", "items": ["a b c", "b", "c", "d"]}, {"type": "ol", "items": ["b", "c"]},
    ]


def test_tables_with_open_cells_and_nesting():
    got = page("<table><tr><th>k<td>v<tr></tr><tr><td><table><tr><td>in</table></table><table><tr></tr></table>")
    assert got["tables"] == [[["k", "v"], ["in", "in"], ["in"]], [["in"]]]


def test_hidden_text_never_counts():
    got = page("<title>T</title><style>s</style><p>a<!-- no -->b<script>var x='<p>';</script><template>t</template>c")
    assert got["text"] == "a b c"
    assert got["title"] == "T"


def test_truncated_markup():
    assert page("<body><p>done<a hre")["text"] == "done"
    assert page("<body>done<!-- cut")["text"] == "done"
    assert page("<body>a < b &amp; c")["text"] == "a < b & c"
    assert page("<h1>Top<p>rest")["headings"] == [{"level": "h1", "text": "Top"}]


def test_every_level_of_nesting_is_listed():
    got = page("<ul><li>x" * 300 + "<h2>end")
    assert [len(found["items"]) for found in got["lists"]] == list(range(300, 0, -1))
    assert got["headings"] == [{"level": "h2", "text": "end"}]
    deep = page("<table><tr><td>" + "<table><tr><td>x" * 40 + "</table>" * 40 + "tail</table>")
    assert len(deep["tables"]) == 41 and deep["tables"][0][0][0].endswith("x tail") and len(deep["tables"][0]) == 41


def test_nested_texts_are_joined_once_and_nested_by_spark(spark, monkeypatch):
    """An item or cell is joined once, whatever is around it; Spark's values equal those of the page."""
    from seine.operators import page_events

    html = "<li>out<table><tr><td>c<ul><li>x" * 30 + "<h2>end</ul><ol></ol><table><tr></tr></table><tr><td>z</table><ul><li>last"
    joined = []
    text_of = page_events.PageEvents.text_of
    monkeypatch.setattr(page_events.PageEvents, "text_of", lambda self, span: joined.append(id(span)) or text_of(self, span))
    want = dict(zip(("lists", "tables"), one(html, "u", ("lists", "tables"))[0]))
    assert len(joined) == len(set(joined)) and len(want["lists"]) == len(want["tables"]) + 1 == 31
    assert [len(found["items"]) for found in want["lists"][:2]] == [60, 58] and want["lists"][-1] == {"type": "ul", "items": ["last"]}
    captures = spark.createDataFrame([("u", html), ("e", ""), ("n", None), ("p", "<li>no list<tr><td>no table")], "url string, html string")
    parsed = extract.parse_pages(captures, ("lists", "tables"))
    assert [parsed.schema[name].dataType for name in ("lists", "tables")] == [schemas.LISTS, schemas.TABLES]
    rows = {r.url: r.asDict(recursive=True) for r in parsed.collect()}
    assert {name: rows["u"][name] for name in want} == want
    assert all(rows[url]["lists"] == rows[url]["tables"] == [] for url in "enp")


def test_stray_end_tags_take_linear_time():
    started = time.monotonic()
    got = page("<ul>" * 50_000 + "</h1>" * 200_000 + "<p>done")
    assert got["text"] == "done" and time.monotonic() - started < 20


def test_a_slash_of_a_value_closes_nothing():
    got = page("<p>a<script src=/x/>var a='<a href=/leak>'</script>b<a href=/kept/>c</a><h1 id='s'/>d")
    assert got["text"] == "a b c d" and got["links"] == ["https://example.com/kept/"]
    assert got["headings"] == [{"level": "h1", "text": ""}]


def test_page_without_body_shows_all_text():
    assert page("<title>Only</title>")["text"] == "Only"
    assert page("<title>T</title>words")["text"] == "words"


def test_parse_pages_job(spark):
    captures = spark.createDataFrame(
        [("https://example.com/", VALID), ("https://e.org/", ""), ("https://n.org/", None)], "url string, html string"
    )
    rows = {r.url: r for r in extract.parse_pages(captures).collect()}
    assert rows["https://example.com/"].lists[0]["items"] == ["Ada", "Bo"]
    assert rows["https://e.org/"].title == "" and rows["https://n.org/"].links == []
    summary = extract.summarize(extract.parse_pages(captures)).where("links_count = 3").first()
    assert summary.first_links == ["https://example.com/boats", "https://example.com/tables.html", "http://weather.example.net/now"]


def test_parse_reads_only_what_it_needs(spark, tmp_path):
    spark.createDataFrame([("u", "<p>x", 1)], "url string, html string, other int").write.parquet(str(tmp_path / "c"))
    plan = extract.parse_pages(spark.read.parquet(str(tmp_path / "c")), ("text",))._jdf.queryExecution().toString()
    assert "other" not in plan.split("Physical Plan")[1]


def test_record_shape_and_defaults(spark):
    captures = spark.createDataFrame([("http://p", "<title>T</title><a href='http://x'>l</a>")], "url string, html string")
    row = records.page_records(extract.parse_pages(captures)).first()
    assert row.asDict().keys() == {
        "url", "title", "text", "links", "metadata", "crawled_at", "status_code", "content_type",
    }
    assert (row.status_code, row.content_type, row.links) == (200, "", ["http://x"])
    assert set(row.metadata.asDict()) == {"title", "description", "keywords", "headings", "images", "lists", "tables"}


def test_latest_and_earliest(spark):
    rows = spark.createDataFrame([("u", "first", 1), ("u", "second", 2), ("v", "only", 1)], "url string, title string, seq int")
    got = {r.url: r.title for r in records.latest_per_key(rows).collect()}
    assert got == {"u": "second", "v": "only"}
    timed = rows.withColumn("crawled_at", F.timestamp_seconds("seq"))
    assert [r.title for r in records.earliest_records(timed, 1).collect()] == ["first"]


def test_slashes_of_values():
    """A slash that ends a start tag is its own unless an unquoted value takes it; any tag is read in one pass."""
    import random
    import re
    import time

    from seine.operators.page_events import _QUOTED, _self_closed

    plain = lambda t: t.endswith("/") and not re.search(r"=\s*[^\s\"'][^\s]*/\Z", _QUOTED.sub('""', t))
    rnd = random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choice("a=/ \"'\t") for _ in range(rnd.randint(0, 9))) + rnd.choice(["/", "", "/"])
        assert _self_closed(text) == plain(text), text
    started = time.monotonic()
    assert not _self_closed(" " + "=" * 5_000_000 + "/") and _self_closed(" a" * 2_000_000 + " /")
    assert time.monotonic() - started < 5
