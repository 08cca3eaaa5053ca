"""Attempts of retried operations, derived from a log of outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.retry import RetryPolicy
from .ordered import HEAVY_ROWS, Ordered


def number_attempts(
    log: DataFrame, policy: RetryPolicy, *, key: str = "host", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Add op_start, attempt, is_final, gave_up and wait_s to an outcome log.

    Per ``key`` in (ts, seq) order, a run of retryable failures and the row after
    it form operations of at most ``max_retries + 1`` rows. A row's place in its
    run is the distance to the last row that was not retryable, so the attempt is
    that distance modulo the operation length: three ordered columns, whatever
    the size of a key. Rows without a time come first.
    """
    if not isinstance(policy.max_retries, int):
        raise ValueError("numbering from outcomes needs one retry limit")
    length = policy.max_retries + 1
    base = log.withColumns({
        "_retryable": policy.retryable(F.col("error_class")),
        "_one": F.lit(1).cast("bigint"),
    })
    ordered = Ordered(base, [key], ["ts", "seq"], heavy_rows).add(running_sum={"_rn": "_one"}, last_row="_at_end")
    ordered.map(lambda rows: rows.withColumn("_end", F.when(~F.col("_retryable"), F.col("_rn"))))
    placed = ordered.add(max_before={"_prev_end": "_end"}).rows()
    place = F.col("_rn") - F.coalesce("_prev_end", F.lit(0)) - 1
    attempt = (place % length).cast("int")
    placed = placed.withColumns({"attempt": attempt, "op_start": F.col("_rn") - attempt})
    # Final: not retryable, or out of retries, or the log of the key ends here.
    spent = F.col("attempt") >= policy.max_retries
    final = ~F.col("_retryable") | spent | F.col("_at_end")
    return placed.withColumns({
        "is_final": final,
        "gave_up": F.col("_retryable") & spent,
        "wait_s": F.when(F.col("_retryable") & ~final, policy.delay(F.col("status"), F.col("attempt"))),
    }).drop("_retryable", "_one", "_rn", "_end", "_prev_end", "_at_end")
