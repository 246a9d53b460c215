"""Order-aware work without a single-task window.

A window without partitions, or with one group that holds much of the table,
sorts that share in one task.  The operators here range-partition the rows on
all grouping and ordering columns, so neither a large group nor a frequent
value nor a shared text prefix fills a task, and carry one small row per
partition across the cuts.  The ordered rows are stored once in the shared
folder: every later read sees the same cuts.  Values are compared as they are.

Only rows that are equal in all these columns stay together; callers fold those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.session import scratch_dir

_PART_BITS = 33  # of monotonically_increasing_id: the row's number within its partition


def _names(columns: list[str]) -> list:
    return [F.col(f"`{c}`") for c in columns]


def ordered_parts(df: DataFrame, order_by: list[str]) -> DataFrame:
    """The rows with ``_part`` and ``_at``: their place in the total order, NULLs first."""
    spark = df.sparkSession
    keys = [c.asc_nulls_first() for c in _names(order_by)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    path = scratch_dir(spark, "ordered")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    return stored.select(
        *_names(df.columns), F.shiftright("_row", _PART_BITS).alias("_part"), F.col("_row").bitwiseAND((1 << _PART_BITS) - 1).alias("_at")
    )


def dense_ids(df: DataFrame, order_by: list[str], id_name: str) -> DataFrame:
    """Ids 1..n in the total order of ``order_by``, for any number of rows."""
    rows = ordered_parts(df, order_by)
    # One row per partition: the window and the broadcast are bounded by their number.
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = F.broadcast(sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before")))
    number = (F.col("_before") + F.col("_at") + 1).cast("bigint")
    return rows.join(offsets, "_part").select(number.alias(id_name), *_names(df.columns))


def small_set_ids(df: DataFrame, order_by: str, id_name: str) -> DataFrame:
    """Ids for a set of a handful of values by construction (such as the four grades)."""
    number = F.row_number().over(Window.orderBy(F.col(order_by).asc_nulls_first())).cast("bigint")
    return df.select(number.alias(id_name), *df.columns)


def set_ids(df: DataFrame, order_by: str, id_name: str) -> DataFrame:
    """Ids for a distinct set of any size."""
    return dense_ids(df, [order_by], id_name)


def with_neighbour(
    df: DataFrame, group_by: list[str], order_by: list[str], out: str, following: bool = False, carry: list[str] | None = None
) -> DataFrame:
    """Add the first ordering column (or a struct of ``carry``) of the previous or following row.

    Same as ``lag`` / ``lead`` over (partition by group_by order by order_by),
    whatever share of the rows a group holds.
    """
    value = F.struct(*_names(carry)) if carry else F.col(f"`{order_by[0]}`")
    step, edge = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    group = F.struct(*_names(group_by)) if group_by else F.struct(F.lit(0).alias("all"))
    rows = ordered_parts(df, [*group_by, *order_by]).withColumn("_own", F.struct(group.alias("g"), value.alias("v")))
    # One row per partition, and none of them is empty: its neighbour's edge is the next row over the cut.
    edges = rows.groupBy("_part").agg(edge("_own", "_at").alias("_edge"))
    carried = F.broadcast(edges.select("_part", step("_edge").over(Window.orderBy("_part")).alias("_carried")))
    near = rows.withColumn("_near", step("_own").over(Window.partitionBy("_part").orderBy("_at"))).join(carried, "_part")
    found = F.coalesce("_near", "_carried")
    value = F.when(found["g"].eqNullSafe(F.col("_own.g")), found["v"])
    return near.select(*_names(df.columns), value.alias(out))
