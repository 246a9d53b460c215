"""Rows to columns and back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names are the only thing collected for a pivot; more would not be a table.
MAX_PIVOT_VALUES = 1000

AGGREGATES = {
    "sum": (F.sum, F.sum_distinct),
    "count": (F.count, F.count_distinct),
    "avg": (F.avg, lambda c: F.try_divide(F.sum_distinct(c), F.count_distinct(c))),
    "min": (F.min, F.min),
    "max": (F.max, F.max),
}
COMPARISONS = {
    "=": Column.__eq__,
    "!=": Column.__ne__,
    "<>": Column.__ne__,
    "<": Column.__lt__,
    "<=": Column.__le__,
    ">": Column.__gt__,
    ">=": Column.__ge__,
}


def slugify(text: str) -> str:
    """Lower-case name of letters, digits and '_', not starting with a digit."""
    name = re.sub(r"[ -]+", "_", text.lower())
    name = re.sub(r"[^a-z0-9_]+", "", name)
    return f"_{name}" if name[:1].isdigit() else name


def pivot(
    column: str,
    values: list,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per value, for ``groupBy(...).agg(*pivot(...))``.

    Unlike ``GroupedData.pivot`` an absent combination gives ``else_value``.
    ``then_value`` / ``else_value`` may be Columns or literals.
    """
    aggregate = AGGREGATES[agg][1 if distinct else 0]
    columns = []
    for value in values:
        hit = COMPARISONS[cmp](F.col(column), F.lit(value))
        cell = aggregate(F.when(hit, then_value).otherwise(else_value))
        if alias:
            name = f"{prefix}{value}{suffix}"
            cell = cell.alias(name if quote_identifiers else slugify(name))
        columns.append(cell)
    return columns


#: Values whose counts a summary keeps; what a longer column loses is bounded by a share of its rows.
TRACKED = 10_000
#: A value with more than this many times rows / TRACKED is in the summary for certain (twice the summary's error).
_CERTAIN = 7


def frequent_values(df: DataFrame, column: str, k: int, tracked: int = TRACKED) -> DataFrame | None:
    """The ``k`` most frequent values with their exact counts, or None if the summary cannot tell them.

    A first pass keeps a bounded summary per task and merges them, so no value is
    shuffled; a second one counts its candidates exactly.  If the k-th count is above
    what the summary may have lost, no other value can be among them.
    """
    if isinstance(df.schema[column].dataType, (T.BinaryType, T.ArrayType, T.MapType, T.StructType)) or not 0 < k <= tracked:
        return None
    rows = df.select(F.col(column).alias("value"))
    total = rows.agg(F.count("*").alias("n"), F.call_function("approx_top_k", F.col("value"), F.lit(tracked), F.lit(tracked)).alias("top"))
    total = total.select("n", F.transform("top", lambda t: t.getField("item")).alias("candidates")).first()
    if total is None or not total["n"]:
        return None
    # at most ``tracked`` values, so this side may always be broadcast
    listed = df.sparkSession.createDataFrame([(v,) for v in total["candidates"]], T.StructType([T.StructField("_value", rows.schema["value"].dataType)]))
    counts = rows.join(F.broadcast(listed), F.col("value").eqNullSafe(F.col("_value")), "left_semi").groupBy("value").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.desc("n"), F.col("value").asc_nulls_first()).limit(k).collect()
    every = sum(r["n"] for r in best) == total["n"]  # nothing else occurs at all
    if not every and (len(best) < k or best[-1]["n"] <= _CERTAIN * total["n"] / tracked):
        return None
    return df.sparkSession.createDataFrame(best, counts.schema).orderBy(F.desc("n"), F.col("value").asc_nulls_first())


def column_values(
    df: DataFrame,
    column: str,
    order_by: list[Column] | None = None,
    max_records: int | None = None,
    where: str | None = None,
) -> DataFrame:
    """Distinct values with their counts, most frequent first (then by value).

    The ``max_records`` most frequent ones come from a summary of the column where it
    can tell them, so that a column of any number of values is not shuffled.
    """
    rows = df.filter(where) if where else df
    if max_records is not None and not order_by and (found := frequent_values(rows, column, max_records)) is not None:
        return found
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = counts.orderBy(*(order_by or [F.desc("n")]), F.col("value").asc_nulls_first())
    return ordered.limit(max_records) if max_records is not None else ordered


def get_column_values(
    df: DataFrame | None,
    column: str,
    order_by: list[Column] | None = None,
    max_records: int | None = None,
    default: list | None = None,
    where: str | None = None,
    most: int = MAX_PIVOT_VALUES,
) -> list | None:
    """The values as a list for naming pivot columns; more than ``most`` without ``max_records`` raise."""
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return default
    bound = most if max_records is None else max_records
    rows = column_values(df, column, order_by, bound + (max_records is None), where).collect()
    if max_records is None and len(rows) > most:
        raise ValueError(f"{column} has more than {most} values")
    return [r["value"] for r in rows] if rows else default


def unpivot(
    df: DataFrame,
    cast_to: str | T.DataType = "string",
    exclude: list[str] | None = None,
    remove: list[str] | None = None,
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Melt all columns but ``exclude`` (kept as ids) and ``remove`` (dropped).

    NULL values stay as rows; booleans become 'true' / 'false'.
    """
    ids = exclude or []
    skip = {c.lower() for c in [*ids, *(remove or [])]}
    melted = [f for f in df.schema if f.name.lower() not in skip]

    def as_target(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.BooleanType):
            value = value.cast("string")
        return value.cast(cast_to).alias(field.name)

    typed = df.select(*ids, *[as_target(f) for f in melted])
    return typed.unpivot(ids, [f"`{f.name}`" for f in melted], field_name, value_name)
