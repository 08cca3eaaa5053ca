"""Robots documents: parsing, agent selection, access and crawl delay."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.robotparser import RobotFileParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.urls import hostname, robots_path


def _entries(host: str, text: str | None) -> list[dict]:
    parser = RobotFileParser()
    parser.parse((text or "").splitlines())
    entries = [(entry, False) for entry in parser.entries]
    if parser.default_entry is not None:
        entries.append((parser.default_entry, True))
    return [
        {
            "host": host,
            "entry_idx": index,
            "is_default": default,
            "agents": [agent.lower() for agent in entry.useragents],
            "delay": None if entry.delay is None else float(entry.delay),
            "rules": [{"allow": line.allowance, "path": line.path} for line in entry.rulelines],
        }
        for index, (entry, default) in enumerate(entries)
    ]


def parse_robots(docs: DataFrame) -> DataFrame:
    """``(host, text)`` to one row per agent group, the default group last."""
    arrow = to_arrow_schema(schemas.ROBOTS_RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("host").to_pylist(), batch.column("text").to_pylist())
            rows = [entry for host, text in pairs for entry in _entries(host, text)]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return docs.select("host", "text").mapInArrow(run, schemas.ROBOTS_RULES)


def agent_rules(rules: DataFrame, user_agent: str) -> DataFrame:
    """One row per host: the ordered rules and delay that bind ``user_agent``.

    The first group naming part of the agent's product token, else the default.
    """
    product = user_agent.split("/")[0].lower()
    fits = F.col("is_default") | F.exists("agents", lambda agent: F.lit(product).contains(agent))
    chosen = F.min_by(F.struct("rules", "delay"), F.struct("is_default", "entry_idx"))
    return rules.where(fits).groupBy("host").agg(chosen.alias("e")).select("host", "e.rules", "e.delay")


def check_robots(urls: DataFrame, bound: DataFrame, url: str = "url") -> DataFrame:
    """Add ``robots_allowed`` and ``crawl_delay`` from :func:`agent_rules` rows.

    A host's rules travel as one small array, so the join is one row per host on
    the right; a hot host on the left is split by the adaptive skew join. The
    first rule whose path is a prefix decides; no rule and no document allow.
    """
    right = bound.select(F.col("host").alias("_host"), "rules", "delay")
    path = robots_path(url)
    matching = F.filter("rules", lambda r: (r["path"] == "*") | F.col("_path").startswith(r["path"]))
    joined = urls.withColumn("_path", path).join(right, hostname(url) == F.col("_host"), "left")
    return joined.withColumns({
        "robots_allowed": F.coalesce(F.get(matching, F.lit(0))["allow"], F.lit(True)),
        "crawl_delay": F.coalesce("delay", F.lit(0.0)),
    }).drop("_path", "_host", "rules", "delay")
