"""Column functions against the standard library and fixed cases."""

import ipaddress
import random
from urllib.parse import quote, unquote, urldefrag, urljoin, urlparse, urlsplit, urlunparse

import pytest
from pyspark.sql import functions as F

from seine.functions import errors, net, text, urls
from seine.functions.retry import RetryPolicy, TimeoutPolicy, flag_attempts, retry_schedule

REFERENCES = (
    "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g "
    "../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g?y/../x "
    "g#s/./x http:g x//y //h/a//b /a//b https://z/p HTTP://Up.Case/P mailto:a@b #"
).split() + [""]


def test_absolutise_matches_the_standard_library(spark):
    bases = ["http://a/b/c/d;p?q", "https://h.example/x/y/#top", "http://h.example", "http://h.example/?k=v"]
    rows = [(b, r) for b in bases for r in REFERENCES]
    frame = spark.createDataFrame(rows, "base string, ref string").withColumn("got", urls.absolutise("base", "ref"))
    wrong = [(r.base, r.ref, r.got, urljoin(r.base, r.ref)) for r in frame.collect() if r.got != urljoin(r.base, r.ref)]
    assert not wrong


def test_url_parts_match_the_standard_library(spark):
    cases = [
        "http://User:pw@Host.Example:8080/p", "https://[::1]:80/x", "HTTP://EXAMPLE.com?x", "mailto:a@b", "//net/path",
        "/local", "", "http:///nohost", "https://under_score.example/#f", "http://a@b@c/d", "x", "1http://a/",
    ]
    frame = spark.createDataFrame([(c,) for c in cases], "u string").select(
        "u", urls.hostname("u").alias("h"), urls.scheme("u").alias("s"), urls.drop_fragment("u").alias("d")
    )
    for r in frame.collect():
        assert r.h == urlsplit(r.u).hostname, r.u
        assert r.s == urlsplit(r.u).scheme, r.u
        assert r.d == urldefrag(r.u).url, r.u


def test_robots_path_is_quoted_like_the_parser_does(spark):
    cases = [
        "http://h/a b?x=ü&y#z", "http://h", "http://h/", "http://h/%7Euser/%2Fx", "http://h/a+b%zz*~", "http://h/%E4?",
        "http://h/caf%C3%A9", "http://h/(a)'!",
    ]

    def want(u):
        parts = urlparse(unquote(u))
        return quote(urlunparse(("", "", parts.path, parts.params, parts.query, parts.fragment))) or "/"

    frame = spark.createDataFrame([(c,) for c in cases], "u string").withColumn("p", urls.robots_path("u"))
    assert [(r.u, r.p) for r in frame.collect()] == [(u, want(u)) for u in cases]


def test_blocked_addresses_match_the_standard_library(spark):
    rnd = random.Random(7)
    cases = [
        "127.0.0.1", "10.0.0.5", "192.168.1.1", "169.254.169.254", "::1", "8.8.8.8", "example.com", "::ffff:8.8.8.8",
        "2001:4860:4860::8888", "fe80::1%eth0", "fec0::1", "1:2:3:4:5:6:7::", "1::2:3:4:5:6:7:8", ":::", "01.2.3.4",
        "2001:1::1", "2001:3::5", "2002::1", "192.0.0.9", "192.0.0.8", "100.64.0.1", "", "1.2.3", "2600::g", "::1.2.3.256",
    ]
    for _ in range(150):
        cases.append(".".join(str(rnd.choice([0, 8, 10, 16, 31, 127, 168, 169, 172, 192, 198, 254])) for _ in range(4)))
        cases.append(str(ipaddress.IPv6Address((rnd.choice([0x2001, 0x2002, 0x2600, 0xFE80, 0xFC00, 0]) << 112) | rnd.getrandbits(rnd.choice([8, 64, 100])))))

    def want(case):
        try:
            ip = ipaddress.ip_address(case)
        except ValueError:
            return False
        return ip.is_private or ip.is_loopback or ip.is_link_local or ip.is_reserved or ip.is_multicast or ip.is_unspecified

    rows = spark.createDataFrame([(c,) for c in [*cases, None]], "ip string").withColumn("b", net.blocked_ip("ip")).collect()
    assert [r.ip for r in rows if r.ip is not None and r.b != want(r.ip)] == []
    assert rows[-1].b is False


def test_status_classes(spark):
    frame = spark.createDataFrame([(s,) for s in (503, 429, 500, 599, 404, 403, 418, 408, None)], "s int")
    got = {r.s: r.c for r in frame.withColumn("c", errors.classify_status(F.col("s"))).collect()}
    assert {s for s, c in got.items() if c == "TransientError"} == {503, 429, 500, 599, 408}
    assert {s for s, c in got.items() if c == "PermanentError"} == {404, 403, 418}
    assert got[None] is None


def schedule(spark, policy, cls, status, timeouts=TimeoutPolicy()):
    frame = spark.createDataFrame([(1, cls, status)], "op int, error_class string, status int")
    return retry_schedule(frame, "op", policy, timeouts).orderBy("attempt").collect()


def waits(rows):
    return [r.wait_s for r in rows if r.wait_s is not None]


def test_backoff_sequences(spark):
    assert waits(schedule(spark, RetryPolicy(), "TransientError", 503)) == [1, 2, 4]
    capped = RetryPolicy(base_delay=10, backoff_factor=10, max_delay=50)
    assert waits(schedule(spark, capped, "TransientError", 503)) == [10, 50, 50]
    assert waits(schedule(spark, RetryPolicy(max_retries=1), "TransientError", 429)) == [3]
    assert schedule(spark, RetryPolicy(), "TransientError", 503)[-1].waited_s == 7
    assert len(schedule(spark, RetryPolicy(), "PermanentError", 404)) == 1


def test_limits_per_class(spark):
    limits = RetryPolicy(max_retries={"NetworkError": 4, "TransientError": 1})
    assert len(schedule(spark, limits, "NetworkError", None)) == 5
    assert len(schedule(spark, limits, "TransientError", 503)) == 2
    assert len(schedule(spark, RetryPolicy(max_retries={"TransientError": 3}), "NetworkError", None)) == 1
    first = RetryPolicy(max_retries={"CrawlerError": 2, "NetworkError": 9})
    assert len(schedule(spark, first, "NetworkError", None)) == 3
    with pytest.raises(ValueError):
        RetryPolicy(max_retries=-1)
    with pytest.raises(ValueError):
        RetryPolicy(max_retries={"NetworkError": -1})


def test_timeouts_grow(spark):
    rows = schedule(spark, RetryPolicy(), "TransientError", 503, TimeoutPolicy(connect=1, read=2, growth=2))
    assert [r.read_s for r in rows[:3]] == [2, 4, 8] and rows[2].connect_s == 4 and rows[0].total_s is None
    with pytest.raises(ValueError):
        TimeoutPolicy(growth=0.5)


def test_attempt_flags(spark):
    attempts = spark.createDataFrame(
        [(1, 0, "TransientError"), (1, 1, None), (2, 0, "PermanentError"), (3, 0, "NetworkError"), (3, 1, "NetworkError")],
        "op_id long, attempt int, error_class string",
    )
    rows = flag_attempts(attempts, RetryPolicy(max_retries=1)).where("is_final").collect()
    assert {(r.op_id, r.attempt, r.gave_up) for r in rows} == {(1, 1, False), (2, 0, False), (3, 1, True)}


def test_decoding_keeps_going(spark):
    raw = [(b"ok \xff end", None), ("é".encode("latin-1"), "latin-1"), (b"x", "no-such"), (None, None)]
    frame = spark.createDataFrame(raw, "b binary, c string")
    rows = frame.select(text.decode_utf8("b").alias("u"), text.decode_lossy(F.col("b"), F.col("c")).alias("t")).collect()
    assert rows[0].u == "ok � end" and [r.t for r in rows] == ["ok � end", "é", "x", None]
