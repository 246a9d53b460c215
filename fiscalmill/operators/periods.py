"""Comparison with an earlier period of the same key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.operators.ranges import with_neighbour


def with_previous_period(df: DataFrame, key: str, period: str, carried: dict[str, str], step: int = 1) -> DataFrame:
    """Left join of every row with its key's rows of exactly ``period - step``.

    ``carried`` maps output names to columns of the earlier rows.  Every row is sent
    to its own period, and what it carries to the period ``step`` later as well; there
    the two meet.  That is the result of a self join with one shuffle and one evaluation
    of ``df``, and as rows are dealt by key and period, a key with most of the rows
    spreads over its periods.  A NULL key or period has no earlier rows.
    """
    at = F.col(f"`{period}`")
    sides = F.array(F.struct(F.lit(True).alias("own"), at.alias("at")), F.struct(F.lit(False).alias("own"), (at + step).cast(df.schema[period].dataType).alias("at")))
    sent = df.select("*", F.explode(sides).alias("_side")).where(F.col("_side.own") | F.col(f"`{key}`").isNotNull() & at.isNotNull())
    needed = {key, *carried.values()}
    columns = [F.col(f"`{c}`") if c in needed else F.when(F.col("_side.own"), F.col(f"`{c}`")).alias(c) for c in df.columns]
    met = Window.partitionBy(key, F.col("_side.at"))
    earlier = F.collect_list(F.when(~F.col("_side.own"), F.struct(*[F.col(f"`{c}`").alias(name) for name, c in carried.items()]))).over(met)
    rows = sent.select(*columns, "_side").withColumn("_rows", earlier).where("_side.own").select("*", F.explode_outer("_rows").alias("_earlier"))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"_earlier.{name}").alias(name) for name in carried])


def with_growth(
    df: DataFrame, key: str, period: str, value: str, previous: str, rate: str, gap_aware: bool = False, split_keys: bool = False
) -> DataFrame:
    """Value of the key's previous row and the growth rate in percent.

    With ``gap_aware`` only the directly preceding period counts as previous.  A key
    has about one row per period, so its rows are one window; ``split_keys`` is for keys
    that hold much of the table: rows are cut at ranges of key and period, and one row is
    carried over each cut.
    """
    if split_keys:
        near = with_neighbour(df, [key], [period], "_near", carry=[period, value])
        before, earlier = F.col(f"_near.`{period}`"), F.col(f"_near.`{value}`")
    else:
        window = Window.partitionBy(key).orderBy(period)
        near = df.withColumn("_near", F.lag(F.struct(F.col(f"`{period}`").alias("p"), F.col(f"`{value}`").alias("v"))).over(window))
        before, earlier = F.col("_near.p"), F.col("_near.v")
    if gap_aware:
        earlier = F.when(before == F.col(period) - 1, earlier)
    grown = near.withColumn(previous, earlier).drop("_near")
    return grown.withColumn(rate, F.try_divide(F.col(value) - F.col(previous), F.col(previous)) * 100)
