"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list[Column], ties: list[str] | None = None) -> DataFrame:
    """First row of every ``partition_by`` group under ``order_by``.

    All remaining columns (or ``ties``) break ties, so reruns agree.  The
    ``row_number() == 1`` filter lets Spark keep one row per key in every map
    task before the shuffle, so a key holding a large share of the rows moves
    only one row per task.
    """
    rest = [F.col(c).asc_nulls_last() for c in (df.columns if ties is None else ties) if c not in partition_by]
    window = Window.partitionBy(*partition_by).orderBy(*order_by, *rest)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
