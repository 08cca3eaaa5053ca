"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import hostname
from ..operators.extract import parse_pages
from ..sources import captures as capture_source

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times in the checks are UTC; the setting belongs to the running session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return capture_source.read_captures(spark, f"{sf_dir}/pages.parquet", PAGES)


def as_fetch_log(events: DataFrame) -> DataFrame:
    """One final fetch outcome per event; works on batches and streams."""
    host = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit(".example.com"))
    kind, slot = F.col("event_type"), F.col("event_id") % 3
    status = (
        F.when(kind.isin("view", "click"), 200)
        .when(kind == "signup", 301)
        .when(kind == "purchase", 404)
        .when(slot == 0, 503)
        .when(slot == 1, 429)
    )
    error = (
        F.when(kind == "purchase", "PermanentError")
        .when((kind == "error") & (slot == 2), "NetworkError")
        .when(kind == "error", "TransientError")
    )
    return events.select(
        F.col("event_id").alias("seq"),
        "ts",
        host.alias("host"),
        F.concat(F.lit("http://"), host, F.lit("/p"), (F.col("event_id") % 40).cast("string")).alias("url"),
        status.alias("status"),
        error.alias("error_class"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_fetch_log(table(spark, sf_dir, "events"))


def skewed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fetch log with nine tenths of its rows on one host within one hour; some rows have no time."""
    log, hot = fetch_log(spark, sf_dir), F.col("seq") % 10 < 9
    burst = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("seq") * 7919) % 3600)
    return log.withColumns({
        "host": F.when(hot, "hot.example.com").otherwise(F.col("host")),
        "ts": F.when(F.col("seq") % 31 != 0, F.when(hot, burst).otherwise(F.col("ts"))),
    })


FETCH_LOG_SQL = """
  SELECT event_id AS seq, ts, concat('u', user_id, '.example.com') AS host,
    concat('http://u', user_id, '.example.com/p', event_id % 40) AS url,
    CASE WHEN event_type IN ('view','click') THEN 200 WHEN event_type = 'signup' THEN 301
         WHEN event_type = 'purchase' THEN 404
         WHEN event_id % 3 = 0 THEN 503 WHEN event_id % 3 = 1 THEN 429 END AS status,
    CASE WHEN event_type = 'purchase' THEN 'PermanentError'
         WHEN event_type = 'error' AND event_id % 3 = 2 THEN 'NetworkError'
         WHEN event_type = 'error' THEN 'TransientError' END AS error_class
  FROM events
"""

SKEWED_LOG_SQL = f"""
  SELECT * REPLACE (CASE WHEN seq % 10 < 9 THEN 'hot.example.com' ELSE host END AS host,
    CASE WHEN seq % 31 = 0 THEN NULL WHEN seq % 10 < 9 THEN TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 SECOND * ((seq * 7919) % 3600) ELSE ts END AS ts)
  FROM ({FETCH_LOG_SQL})
"""

HOST_SQL = "lower(regexp_extract(url, '^https?://([^/?#:]+)', 1))"

ROBOTS_TEXT = "\n".join([
    "User-agent: *", "Disallow: /de/", "Crawl-delay: 2", "",
    "User-agent: MyBot", "Allow: /fr/1", "Disallow: /fr/", "",
])


def robots_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One robots text per host; hosts of some name lengths have none."""
    hosts = pages(spark, sf_dir).select(hostname("url").alias("host")).distinct()
    return hosts.where(F.length("host") % 3 != 0).withColumn("text", F.lit(ROBOTS_TEXT))


# URLs per sitemap, and documents per index of each level.
LEAF, BRANCH = 50, 1000


def sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A root index over two index levels over sitemaps of ``LEAF`` pages each.

    Every document is bounded, so documents grow in number, not in size. The root
    also names a missing and a malformed document.
    """
    def doc(rows, group, order, tag, root, prefix):
        entry = F.concat(F.lit(f"<{tag}><loc> "), F.replace("loc", F.lit("&"), F.lit("&amp;")), F.lit(f" </loc></{tag}>"))
        body = rows.withColumn("_entry", entry).groupBy(group.alias("i")).agg(
            F.expr(f"listagg(_entry, '') WITHIN GROUP (ORDER BY {order})").alias("body")
        )
        xml = F.concat(F.lit(f'<{root} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "body", F.lit(f"</{root}>"))
        return body.select("i", F.concat(F.lit(f"http://s/{prefix}"), F.col("i").cast("string"), F.lit(".xml")).alias("url"), xml.alias("xml"))

    parent = lambda width: F.floor(F.col("i") / width)
    leaf_rows = pages(spark, sf_dir).select("page_id", F.col("url").alias("loc"))
    leaves = doc(leaf_rows, F.floor(F.col("page_id") / LEAF), "page_id", "url", "urlset", "pages-")
    names = leaf_rows.select(F.floor(F.col("page_id") / LEAF).alias("i")).distinct()
    named = lambda rows, prefix: rows.withColumn(
        "loc", F.concat(F.lit(f"http://s/{prefix}"), F.col("i").cast("string"), F.lit(".xml"))
    )
    lower = doc(named(names, "pages-"), parent(BRANCH), "i", "sitemap", "sitemapindex", "low-")
    lower_names = names.select(parent(BRANCH).alias("i")).distinct()
    upper = doc(named(lower_names, "low-"), parent(BRANCH), "i", "sitemap", "sitemapindex", "high-")
    upper_names = lower_names.select(parent(BRANCH).alias("i")).distinct()
    extra = upper_names.agg(F.max("i").alias("m")).select(
        F.explode(F.array(
            F.struct((F.col("m") + 1).alias("i"), F.lit("http://s/missing.xml").alias("loc")),
            F.struct((F.col("m") + 2).alias("i"), F.lit("http://s/bad.xml").alias("loc")),
        )).alias("e")
    ).select("e.*")
    root = doc(named(upper_names, "high-").unionByName(extra), F.lit(0), "i", "sitemap", "sitemapindex", "index-")
    bad = names.limit(1).select(F.lit("http://s/bad.xml").alias("url"), F.lit("<urlset><loc>").alias("xml"))
    every = [part.select("url", "xml") for part in (leaves, lower, upper, root)]
    out = bad
    for part in every:
        out = out.unionByName(part)
    return out


def link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_url, pos, dst_url): three links per page to other pages of the table."""
    base = pages(spark, sf_dir).select("page_id", "url")
    total = base.agg(F.count("*")).scalar()
    k = F.col("pos")
    targets = base.select(
        F.col("url").alias("src_url"), "page_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("pos")
    ).select("src_url", "pos", ((F.col("page_id") * k * 7 + 13 * k + 1) % total).alias("dst"))
    names = base.select(F.col("page_id").alias("dst"), F.col("url").alias("dst_url"))
    return targets.join(names, "dst").select("src_url", "pos", "dst_url")


def graph_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture facts of the graph's pages; every eleventh failed with 503."""
    status = F.when(F.col("page_id") % 11 == 5, 503).otherwise(200)
    return pages(spark, sf_dir).select(
        "url", status.alias("status_code"), F.octet_length("html").alias("n_bytes")
    )


def parsed_with_id(spark: SparkSession, sf_dir: str, fields: tuple[str, ...]) -> DataFrame:
    return parse_pages(pages(spark, sf_dir), fields, keep=("page_id", "url"))
