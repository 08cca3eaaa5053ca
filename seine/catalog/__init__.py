"""The registered queries and their SQL checks, by area."""

from . import crawling, fetches, hosts, pages, saving, streams

_AREAS = (pages, hosts, crawling, fetches, saving, streams)


def queries() -> dict:
    return {name: query for area in _AREAS for name, query in area.QUERIES.items()}


def oracles() -> dict:
    return {name: sql for area in _AREAS for name, sql in area.ORACLES.items()}
