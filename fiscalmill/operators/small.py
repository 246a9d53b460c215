"""Sides of a join that are small by nature, checked before they are broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 10_000


def checked_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """The same rows as a local table to broadcast, if there are few enough.

    At most ``max_rows + 1`` rows are fetched.  A larger side comes back
    unchanged, so the join shuffles and AQE splits its skewed partitions.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
