"""The driver contract: names, entry and a few whole comparisons."""

import duckdb
import pytest

import __spark_entry__ as contract

SMALL = "/root/testdata/sf0.001"


def test_every_query_has_a_check():
    from seine import catalog

    assert set(catalog.queries()) == set(catalog.oracles())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["host", "n"] and frame.count() == 10


@pytest.mark.parametrize("name", ["extract_text", "robots_allowed", "attempt_numbering", "breaker_states", "crawl_budget"])
def test_whole_results_on_the_small_tables(spark, name):
    frame = contract.queries()[name](spark, SMALL)
    db = duckdb.connect()
    for table in ("pages", "events"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = db.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == rows
