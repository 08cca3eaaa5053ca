"""Error classes of fetch outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class names and statuses as they appear in saved outcomes.
TRANSIENT = "TransientError"
PERMANENT = "PermanentError"
NETWORK = "NetworkError"
PARSE = "ParseError"
STORAGE = "StorageError"
BASE = "CrawlerError"
TRANSIENT_STATUSES = (408, 429, 500, 502, 503, 504)


def is_transient(status: Column) -> Column:
    return status.isin(*TRANSIENT_STATUSES) | status.between(500, 599)


def classify_status(status: Column) -> Column:
    """Error class of an HTTP error status; null for a null status."""
    return F.when(is_transient(status), F.lit(TRANSIENT)).when(status.isNotNull(), F.lit(PERMANENT))


def status_message(status: Column) -> Column:
    kind = F.when(is_transient(status), F.lit("transient HTTP ")).otherwise(F.lit("permanent HTTP "))
    return F.concat(kind, status.cast("string"))


def fetch_error(status: Column, timed_out: Column, network_message: Column, url: Column) -> Column:
    """struct<error_class, message> of a failed fetch, null for a good one.

    An HTTP error status is classified; otherwise a timeout is transient and any
    other client error is a network error.
    """
    pair = lambda cls, msg: F.struct(cls.alias("error_class"), msg.alias("message"))
    return (
        F.when(status >= 400, pair(classify_status(status), status_message(status)))
        .when(timed_out, pair(F.lit(TRANSIENT), F.concat(F.lit("timeout for "), url)))
        .when(network_message.isNotNull(), pair(F.lit(NETWORK), network_message))
    )


def reason(error_class: Column, message: Column) -> Column:
    """"Class: message", as kept for failed URLs."""
    return F.concat(error_class, F.lit(": "), message)
