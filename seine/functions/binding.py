"""Use a value many times while computing it once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which appears once in the plan however often it is used.

    Nested expressions that repeat their inputs otherwise grow exponentially.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
