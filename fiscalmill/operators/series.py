"""Number series and date spines."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATEPARTS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")


def generate_series(spark: SparkSession, upper_bound: int, name: str = "generated_number") -> DataFrame:
    """Rows 1..upper_bound, made in parallel."""
    if upper_bound <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper_bound + 1).select(F.col("id").alias(name))


def intervals_between(spark: SparkSession, start: datetime, end: datetime, datepart: str) -> int:
    """Number of ``datepart`` boundaries between two moments."""
    truncated = [f"date_trunc('{datepart}', timestamp '{moment}')" for moment in (start, end)]
    if datepart in ("year", "quarter", "month"):
        months = {"year": 12, "quarter": 3, "month": 1}[datepart]
        query = f"cast(months_between({truncated[1]}, {truncated[0]}) / {months} as bigint)"
    else:
        query = f"timestampdiff({datepart}, {truncated[0]}, {truncated[1]})"
    return int(spark.range(1).select(F.expr(query)).first()[0])


def date_spine(spark: SparkSession, datepart: str, start: date | datetime, end: date | datetime) -> DataFrame:
    """One row per ``datepart`` from ``start`` on, ``end`` excluded.

    Whole-day parts between dates give dates, all else gives timestamps.
    """
    if datepart not in DATEPARTS:
        raise ValueError(f"datepart must be one of {DATEPARTS}")
    whole_days = not any(isinstance(moment, datetime) for moment in (start, end))
    first, last = (m if isinstance(m, datetime) else datetime.combine(m, datetime.min.time()) for m in (start, end))
    steps = intervals_between(spark, first, last, datepart)
    # A step that is still before ``end`` but not a full part is kept out, as is ``end``.
    spine = spark.range(max(steps, 0)).select(
        F.expr(f"timestampadd({datepart}, cast(id as int), timestamp '{first}')").alias(f"date_{datepart}")
    )
    spine = spine.filter(F.col(f"date_{datepart}") <= F.expr(f"timestamp '{last}'"))
    if whole_days and datepart not in ("hour", "minute", "second"):
        spine = spine.withColumn(f"date_{datepart}", F.col(f"date_{datepart}").cast("date"))
    return spine
