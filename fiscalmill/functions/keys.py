"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column, nulls_as_empty: bool = False) -> Column:
    """md5 over the text of ``columns`` joined by '-'; NULL becomes a token."""
    if not columns:
        raise ValueError("surrogate_key needs at least one column")
    token = F.lit("" if nulls_as_empty else NULL_TOKEN)
    texts = [F.coalesce(_column(c).cast("string"), token) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
