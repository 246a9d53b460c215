"""Column selection helpers and small results as values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalmill.operators.ranges import dense_ids

# A result turned into one row of arrays is a report, not a table; larger ones are refused.
MAX_ARRAY_ROWS = 10_000


def filtered_columns(df: DataFrame, except_: list[str] | None = None) -> list[str]:
    """Column names without ``except_`` (case-insensitive)."""
    skip = {c.lower() for c in except_ or []}
    return [c for c in df.columns if c.lower() not in skip]


def star(df: DataFrame, except_: list[str] | None = None, prefix: str = "", suffix: str = "", alias: str = "") -> list[Column]:
    """All columns but ``except_``, renamed only when a prefix or suffix is given."""
    source = f"{alias}." if alias else ""
    return [F.col(f"{source}`{c}`").alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, except_)]


def nullcheck(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """The columns with '' turned into NULL where they hold text."""
    fields = [f for f in df.schema if columns is None or f.name in columns]
    return [
        (F.nullif(F.col(f"`{f.name}`"), F.lit("")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")).alias(f.name)
        for f in fields
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def group_by_n(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    if not 1 <= n <= len(df.columns):
        raise ValueError(f"n must be between 1 and {len(df.columns)}")
    return df.groupBy(*df.columns[:n])


def single_value(df: DataFrame, name: str, default=None) -> DataFrame:
    """One row holding the first value of the first column, or the default.

    Meant for queries that yield at most one row; use it as a filter through a
    cross join with this single row.
    """
    value = F.col(f"`{df.columns[0]}`")
    # Wrapped so that a NULL found in the row is kept apart from no row at all.
    first = F.first(F.struct(value.alias("v")))
    return df.limit(1).agg(F.when(F.count("*") == 0, F.lit(default)).otherwise(first["v"]).alias(name))


def get_single_value(df: DataFrame, default=None):
    """The first value of the first row on the driver, or the default."""
    row = df.select(df.columns[0]).first()
    return default if row is None else row[0]


def results_as_arrays(df: DataFrame, order_by: list[Column], max_rows: int = MAX_ARRAY_ROWS) -> DataFrame:
    """One row with an array per column, all in the same order.

    The query fails when there are more than ``max_rows`` rows; nothing is cut.
    """
    names = df.columns
    keyed = F.struct(*[key.alias(f"_k{i}") for i, key in enumerate(order_by)], F.struct(*names).alias("_row"))
    # Only max_rows + 1 rows ever reach the final task, enough to see an overflow.
    rows = df.limit(max_rows + 1).agg(F.sort_array(F.collect_list(keyed)).alias("_rows"))
    checked = rows.select(
        F.when(F.size("_rows") <= max_rows, F.col("_rows"))
        .otherwise(F.raise_error(F.lit(f"more than {max_rows} rows")).cast(rows.schema["_rows"].dataType))
        .alias("_rows")
    )
    return checked.select(*[F.col("_rows._row").getField(n).alias(n) for n in names])


def results_in_chunks(df: DataFrame, order_by: list[str], chunk_rows: int = MAX_ARRAY_ROWS) -> DataFrame:
    """(chunk, then an array per column): any number of rows as arrays of ``chunk_rows`` at most.

    Chunks are numbered from 1 in the order of the rows, and the arrays of a chunk
    are in it too.  Rows are numbered over range partitions, so no task holds more
    than its range and a chunk.  Rows that are equal in ``order_by`` come in any order.
    """
    numbered = dense_ids(df, order_by, "_id")
    place = F.floor((F.col("_id") - 1) / chunk_rows).cast("bigint") + 1
    held = numbered.groupBy(place.alias("chunk")).agg(F.sort_array(F.collect_list(F.struct("_id", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")))).alias("_rows"))
    return held.select("chunk", *[F.col("_rows._row").getField(c).alias(c) for c in df.columns])


def results_as_dict(df: DataFrame, order_by: list[Column], max_rows: int = MAX_ARRAY_ROWS) -> dict[str, list]:
    """Column name -> ordered values, on the driver."""
    return results_as_arrays(df, order_by, max_rows).first().asDict()
