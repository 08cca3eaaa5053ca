"""A whole job from start URLs to records, statistics and exports."""

import glob
import json

import pytest

from seine.plans.exports import export_report, export_summary
from seine.plans.job import CaptureJob
from seine.session import checkpoint_root, cut_lineage
from seine.sinks import JsonLinesSink, PageSink, SinkError, read_jsonl_records

SITE = [
    ("http://site/", "<title>Home</title><a href='/a'>a</a><a href='http://else/'>x</a><a href='/private/p'>p</a>"),
    ("http://site/a", "<title>A</title><a href='/'>home</a><a href='/b'>b</a>"),
    ("http://site/b", "<title>B</title>"),
    ("http://map/1", "<title>M</title>"),
    ("http://else/", "<title>E</title>"),
]


@pytest.fixture
def site(spark):
    return spark.createDataFrame(SITE, "url string, html string")


def text_of(path):
    return "".join(open(name, encoding="utf-8").read() for name in sorted(glob.glob(f"{path}/part-*")))


def test_job_end_to_end(spark, site, tmp_path):
    docs = spark.createDataFrame([("site", "User-agent: *\nDisallow: /private/")], "host string, text string")
    result = CaptureJob(["http://site/"], same_domain_only=True, max_depth=1).run(
        site, robots_docs=docs, sink=JsonLinesSink(str(tmp_path / "out"))
    )
    assert {r.url: r.outcome for r in result.run.results.collect()} == {
        "http://site/": "processed", "http://site/a": "processed", "http://site/private/p": "blocked",
    }
    row = result.summary().first()
    assert (row.total_pages, row.successful, row.failed, row.status_codes) == (2, 2, 0, {"200": 2})
    assert [tuple(d) for d in row.top_domains] == [("site", 2)]
    saved = {r.url: r.title for r in read_jsonl_records(spark, str(tmp_path / "out")).collect()}
    assert saved == {"http://site/": "Home", "http://site/a": "A"} == {r.url: r.title for r in result.records.collect()}

    export_summary(result.log, str(tmp_path / "summary"))
    text = text_of(tmp_path / "summary" / "batch=0")
    assert json.loads(text)[0]["successful"] == 2
    export_report(result.log, str(tmp_path / "report"))
    assert "<td>site</td>" in text_of(tmp_path / "report")


def test_a_second_job_appends(spark, site, tmp_path):
    for start in ("http://site/b", "http://map/1"):
        CaptureJob([start]).run(site, sink=JsonLinesSink(str(tmp_path / "out")))
    saved = read_jsonl_records(spark, str(tmp_path / "out")).collect()
    assert sorted(r.title for r in saved) == ["B", "M"]


def test_a_job_run_again_under_its_id_replaces_its_waves(spark, site, tmp_path):
    for run_id in (1, 1, 2):
        CaptureJob(["http://site/b"]).run(site, sink=JsonLinesSink(str(tmp_path / "out")), run_id=run_id)
    assert read_jsonl_records(spark, str(tmp_path / "out")).count() == 2


def test_pages_that_cannot_be_read_have_failed(spark, tmp_path):
    pages = spark.createDataFrame([
        ("http://site/", "<a href='/none'>n</a><a href='/empty'>e</a><a href='/gone'>g</a>", 200),
        ("http://site/none", None, 200), ("http://site/empty", "", 200), ("http://site/gone", None, 404),
    ], "url string, html string, status_code int")
    result = CaptureJob(["http://site/"]).run(pages, sink=JsonLinesSink(str(tmp_path / "out")))
    assert {r.url: (r.outcome, r.reason) for r in result.run.results.collect()} == {
        "http://site/": ("processed", None), "http://site/none": ("failed", "ParseError: no html"),
        "http://site/empty": ("processed", None), "http://site/gone": ("failed", "PermanentError: permanent HTTP 404"),
    }
    saved = {r.url for r in read_jsonl_records(spark, str(tmp_path / "out")).collect()}
    assert saved == {"http://site/", "http://site/empty"} == {r.url for r in result.records.collect()}
    parts = result.errors()
    assert {r.error_class: r.n for r in parts["errors_by_type"].collect()} == {"ParseError": 1, "PermanentError": 1}
    assert {r.url for r in parts["failed_urls"].collect()} == {"http://site/none", "http://site/gone"}
    row = result.summary().first()
    assert (row.total_pages, row.successful, row.failed, row.status_codes) == (4, 2, 2, {"200": 3, "404": 1})


def test_a_job_of_one_wave_takes_its_time(spark, site):
    result = CaptureJob(["http://site/b"]).run(site)
    row = result.summary().first()
    assert row.elapsed_seconds == pytest.approx(result.finished - result.started, abs=0.02) and row.elapsed_seconds > 0
    assert row.pages_per_second == pytest.approx(1 / (result.finished - result.started), abs=0.02)


def test_a_broken_page_is_an_error_of_its_own(spark, monkeypatch):
    from seine.operators import page_events

    monkeypatch.setattr(page_events.PageEvents, "read", lambda self, html: 1 / 0)
    assert page_events.extract("<p>", "http://a/", ("title", "links")) == (["", []], "division by zero")


def test_job_seeds_from_a_sitemap(spark, site):
    docs = spark.createDataFrame([("http://map/s", "<urlset><url><loc>http://map/1</loc></url></urlset>")], "url string, xml string")
    job = CaptureJob(["http://site/b"], sitemap_url="http://map/s")
    result = job.run(site, sitemap_docs=docs)
    assert [r.url for r in result.run.results.orderBy("path").collect()] == ["http://site/b", "http://map/1"]
    with pytest.raises(ValueError):
        CaptureJob(sitemap_url="http://map/none").run(site, sitemap_docs=docs)


def test_private_hosts_are_refused_unless_allowed(spark):
    pages = spark.createDataFrame([("http://127.0.0.1/", "<p>x")], "url string, html string")
    run = lambda **kw: CaptureJob(["http://127.0.0.1/"], **kw).run(pages).run.results.first().outcome
    assert run() == "failed" and run(allow_private_hosts=True) == "processed"


def test_failing_sink_does_not_stop_the_job(spark, site):
    class Full(PageSink):
        def write(self, batch, batch_id):
            raise SinkError("full")

    assert CaptureJob(["http://site/b"]).run(site, sink=Full()).records.count() == 1


def test_cut_lineage_is_a_table_in_the_shared_folder(spark, site):
    cut = cut_lineage(site)
    assert all(checkpoint_root(spark) in name for name in cut.inputFiles())
    assert cut.count() == len(SITE)
