"""Lossy decoding and JSON cells."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ISO-8601 with zone offset; six fractional digits only when there are any.
ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]xxx"


def decode_utf8(data: Column | str) -> Column:
    """Bytes to text; each bad sequence becomes U+FFFD."""
    data = F.col(data) if isinstance(data, str) else data
    return F.make_valid_utf8(data.cast("string"))


@F.pandas_udf(StringType())
def _decode_any(data: pd.Series, charset: pd.Series) -> pd.Series:
    def one(raw, name):
        if raw is None:
            return None
        try:
            return bytes(raw).decode(name or "utf-8", errors="replace")
        except LookupError:
            return bytes(raw).decode("utf-8", errors="replace")

    return pd.Series([one(raw, name) for raw, name in zip(data, charset)])


def decode_lossy(data: Column, charset: Column) -> Column:
    """Bytes in a named charset to text, utf-8 when the name is null or unknown."""
    return _decode_any(data, charset)


def json_cell(value: Column) -> Column:
    """A nested value as JSON text with nulls kept and ISO timestamps."""
    return F.to_json(value, {"ignoreNullFields": "false", "timestampFormat": ISO})


def iso_time(value: Column) -> Column:
    """A timestamp as ISO-8601 in UTC, fraction only when there is one."""
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(value) % 1_000_000 == 0, whole).otherwise(exact)
