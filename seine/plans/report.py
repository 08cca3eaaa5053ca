"""A self-contained HTML page of a run summary, built as one row of text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STYLE = (
    "body{font:16px/1.5 sans-serif;margin:32px;color:#222}"
    ".tiles{display:flex;flex-wrap:wrap;gap:12px}"
    ".tile{border:1px solid #ccc;border-radius:6px;padding:12px 18px}"
    ".tile b{display:block;font-size:26px}"
    "table{border-collapse:collapse;min-width:480px}"
    "td{border-bottom:1px solid #ddd;padding:6px 10px}"
    "td.bar{width:60%}td.bar span{display:block;height:12px;background:#3a6ea5}"
    "td.n{text-align:right}"
)
# The figures a report shows, in order.
TILES = (
    ("Total pages", "total_pages"),
    ("Successful", "successful"),
    ("Failed", "failed"),
    ("Pages/sec", "pages_per_second"),
    ("Elapsed, s", "elapsed_seconds"),
)


def bar_widths(counts: DataFrame, section: str = "section", n: str = "n") -> DataFrame:
    """Add ``width``: the whole percentage of the section's largest count.

    Runs on aggregated bars, a handful of rows per section.
    """
    peak = F.max(n).over(Window.partitionBy(section))
    return counts.withColumn("width", F.floor(F.coalesce(F.try_divide(F.col(n) * 100, peak), F.lit(0))))


def _escape(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _bars(items: Column, name: str) -> Column:
    peak = F.array_max(F.transform(items, lambda i: i["n"]))
    row = lambda i: F.concat(
        F.lit("<tr><td>"), _escape(i[name]),
        F.lit("</td><td class='bar'><span style='width:"),
        F.floor(F.coalesce(F.try_divide(i["n"] * 100, peak), F.lit(0))).cast("string"),
        F.lit("%'></span></td><td class='n'>"), i["n"].cast("string"), F.lit("</td></tr>"),
    )
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, row), "")).otherwise(
        F.lit("<tr><td>no data</td></tr>")
    )


def html_report(summary: DataFrame) -> DataFrame:
    """One row ``value`` holding the page. ``summary`` comes from ``run_summary``."""
    tiles = [
        F.concat(F.lit("<div class='tile'><b>"), F.col(name).cast("string"), F.lit(f"</b>{label}</div>"))
        for label, name in TILES
    ]
    codes = F.transform(
        F.map_entries("status_codes"), lambda e: F.struct(e["key"].alias("name"), e["value"].alias("n"))
    )
    page = F.concat(
        F.lit("<!doctype html>\n<html lang='en'><head><meta charset='utf-8'><title>Run report</title>"),
        F.lit(f"<style>{_STYLE}</style></head>\n<body><h1>Run report</h1>\n<p>Generated: "),
        F.coalesce("finished_at", F.lit("")),
        F.lit("</p>\n<div class='tiles'>"), *tiles,
        F.lit("</div>\n<h2>Status codes</h2><table>"), _bars(codes, "name"),
        F.lit("</table>\n<h2>Top domains</h2><table>"), _bars(F.col("top_domains"), "host"),
        F.lit("</table>\n</body></html>"),
    )
    return summary.select(page.alias("value"))
