"""Checks: each returns a DataFrame of failing rows.

Equal failing rows are folded into one with their number in ``n_rows``; the
number of failures of such a check is the sum of that column.  Folding happens
before the shuffle, so one value holding a large share of a table costs one row
per task.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions.text import strip
from fiscalmill.operators.ranges import with_neighbour
from fiscalmill.quality.fingerprint import BUCKETS, alike, differing_buckets, rows_of

N_ROWS = "n_rows"


def _quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


# ---- row-level checks: a plain filter -------------------------------------


def null_rows(column: str) -> Column:
    return F.col(column).isNull()


def out_of_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """True outside the range; NULL values count as inside."""
    value, bad = F.col(column), []
    if min_value is not None:
        bad.append(value < min_value if inclusive else value <= min_value)
    if max_value is not None:
        bad.append(value > max_value if inclusive else value >= max_value)
    return F.coalesce(reduce(or_, bad, F.lit(False)), F.lit(False))


def not_true(expression: str, column: str | None = None) -> Column:
    """True where the SQL expression is false; NULL counts as true."""
    text = f"{column} {expression}" if column else expression
    return F.coalesce(~F.expr(text), F.lit(False))


def empty_text(column: str, trim_whitespace: bool = True) -> Column:
    value = F.col(column)
    if trim_whitespace:
        value = strip(value)
    return F.coalesce(value == "", F.lit(False))


def unequal(actual: str, expected: str) -> Column:
    return F.coalesce(F.col(actual) != F.col(expected), F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(null_rows(column))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.filter(out_of_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.filter(not_true(expression, column))


def not_empty_string(df: DataFrame, column: str, trim_whitespace: bool = True) -> DataFrame:
    return df.filter(empty_text(column, trim_whitespace))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.filter(unequal(actual, expected))


# ---- value checks: one partial aggregation --------------------------------


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    rows = df.filter(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.count("*").alias(N_ROWS)).filter(F.col(N_ROWS) > 1)


def unique_combination_of_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*_quoted(columns)).agg(F.count("*").alias(N_ROWS)).filter(F.col(N_ROWS) > 1)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, with their number of rows; NULL is accepted."""
    bad = df.filter(~F.col(column).isin(values))
    return bad.groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias(N_ROWS))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values of the list that occur."""
    return df.filter(F.col(column).isin(values)).select(F.col(column).alias("value_field")).distinct()


def has_rows(df: DataFrame) -> DataFrame:
    """A single row with count 0 when the table is empty, else nothing."""
    return df.limit(1).agg(F.count("*").alias("row_count")).filter("row_count = 0")


def at_least_one(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups without any non-null value (every group is looked at)."""
    if not group_by:
        # One non-null row is enough, so the scan may stop early.
        found = df.filter(F.col(column).isNotNull()).select(column).limit(1)
        return found.agg(F.count("*").alias("filler_column")).filter("filler_column = 0")
    return df.groupBy(*_quoted(group_by)).agg(F.count(column).alias("filler_column")).filter("filler_column = 0")


def not_constant(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Groups with exactly one distinct value.

    Smallest = largest says the same as count(distinct) = 1 without a second
    shuffle.
    """
    low, high = F.min(column), F.max(column)
    spread = df.groupBy(*_quoted(group_by or [])).agg(low.alias("_low"), high.alias("_high"))
    return spread.filter("_low = _high").select(*_quoted(group_by or []), F.lit(1).cast("bigint").alias("filler_column"))


def not_null_proportion(
    df: DataFrame, column: str, at_least: float, at_most: float = 1.0, group_by: list[str] | None = None
) -> DataFrame:
    share = F.try_divide(F.count(column), F.count("*")).alias("not_null_proportion")
    shares = df.groupBy(*_quoted(group_by or [])).agg(share)
    return shares.filter((F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(
    df: DataFrame,
    field: str,
    datepart: str,
    interval: int,
    now: datetime | Column | None = None,
    ignore_time_component: bool = False,
    group_by: list[str] | None = None,
) -> DataFrame:
    """Groups whose newest ``field`` lies before now - interval."""
    moment = F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)
    kind = "date" if ignore_time_component else "timestamp"
    threshold = F.timestamp_add(datepart.upper(), F.lit(-interval), moment).cast(kind)
    newest = df.groupBy(*_quoted(group_by or [])).agg(F.max(field).cast(kind).alias("most_recent"))
    return newest.withColumn("threshold", threshold).filter("most_recent < threshold")


# ---- comparisons of two tables: one shuffle over both ----------------------


def _two_sides(a: DataFrame, b: DataFrame, keys_a: list[str], keys_b: list[str]) -> DataFrame:
    """Rows of both tables with one counter per side, grouped by the keys.

    Grouping keeps NULL keys and one-sided keys, and combines map-side.
    """
    names = [f"_k{i}" for i in range(len(keys_a))]
    left = a.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys_a, names)], F.lit(1).alias("_a"), F.lit(0).alias("_b"))
    right = b.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys_b, names)], F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    counts = left.unionAll(right).groupBy(*names)
    summed = counts.agg(F.coalesce(F.sum("_a"), F.lit(0)).alias("_a"), F.coalesce(F.sum("_b"), F.lit(0)).alias("_b"))
    return summed.select(*[F.col(n).alias(k) for n, k in zip(names, keys_a)], "_a", "_b")


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs found on one side only."""
    counts = _two_sides(df, to, [column], [field]).filter("_a <> _b")
    sides = F.array(F.col("_a"), F.col("_b"))
    return counts.select(F.col(column), F.explode(F.filter(sides, lambda n: n > 0)).alias("num_rows"))


def equal_rowcount(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Groups whose row counts differ; a missing group counts as 0 rows."""
    counts = _two_sides(df, compare, group_by or [], group_by or [])
    return counts.select(
        *_quoted(group_by or []),
        F.col("_a").alias("count_a"),
        F.col("_b").alias("count_b"),
        F.abs(F.col("_a") - F.col("_b")).alias("diff_count"),
    ).filter("diff_count <> 0")


def fewer_rows_than(df: DataFrame, compare: DataFrame, group_by: list[str] | None = None) -> DataFrame:
    """Groups that do not have fewer rows than in ``compare``."""
    ours, theirs = F.col("_a"), F.col("_b")
    delta = F.when(ours > theirs, ours - theirs).when(ours == theirs, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    counts = _two_sides(df, compare, group_by or [], group_by or [])
    return counts.select(
        *_quoted(group_by or []),
        ours.alias("count_our_model"),
        theirs.alias("count_comparison_model"),
        delta.alias("row_count_delta"),
    ).filter("row_count_delta <> 0")


def equality(
    df: DataFrame, compare: DataFrame, columns: list[str] | None = None, multiset: bool = False, buckets: int = BUCKETS
) -> DataFrame:
    """Rows on one side only, tagged by side; duplicates count with ``multiset``.

    Both sides are fingerprinted first, which moves a few bytes per bucket; only the
    rows of buckets that differ are shuffled and compared. Equal tables end there.
    """
    columns = columns or df.columns
    left, right = alike(df, compare, columns)
    differing = differing_buckets(left, right, buckets)
    if len(differing) < buckets:
        left, right = rows_of(left, differing, buckets), rows_of(right, differing, buckets)
    counts = _two_sides(left, right, columns, columns)
    if multiset:
        rows = counts.filter("_a <> _b")
        extra = F.abs(F.col("_a") - F.col("_b")).alias(N_ROWS)
    else:
        rows = counts.filter("_a = 0 or _b = 0")
        extra = F.lit(1).cast("bigint").alias(N_ROWS)
    side = F.when(F.col("_a") > F.col("_b"), "a_minus_b").otherwise("b_minus_a")
    return rows.select(side.alias("which_diff"), *_quoted(columns), extra)


def relationships(df: DataFrame, column: str, to: DataFrame, field: str) -> DataFrame:
    """Non-null child values without a parent."""
    return relationships_where(df, column, to, field)


def relationships_where(
    df: DataFrame, column: str, to: DataFrame, field: str, from_condition: str = "1=1", to_condition: str = "1=1"
) -> DataFrame:
    """Child values (of filtered rows) without a (filtered) parent.

    Both sides shrink to distinct keys before they meet.  (An anti join would be
    pushed below the aggregation, so that all child rows are shuffled again.)
    """
    child = df.filter(from_condition).filter(F.col(column).isNotNull())
    parent = to.filter(to_condition).filter(F.col(field).isNotNull()).select(F.col(field).alias("id")).distinct()
    keys = child.groupBy(F.col(column).alias("id")).agg(F.count("*").alias(N_ROWS))
    matched = keys.join(parent.withColumn("_found", F.lit(True)), "id", "left")
    return matched.filter("_found is null").select("id", N_ROWS)


def columns_match_set(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column names found on one side only, compared without case."""
    have, want = {c.lower() for c in df.columns}, {c.lower() for c in columns}
    rows = [(c, "unexpected") for c in sorted(have - want)] + [(c, "missing") for c in sorted(want - have)]
    return df.sparkSession.createDataFrame(rows, "column_name string, problem string")


# ---- ordered checks: no single-task window --------------------------------


def _neighbours(rows: DataFrame, groups: list[str], order: list[str], following: bool) -> DataFrame:
    """Every distinct row with its neighbour's first ordering column in ``_near``
    and its number of copies with that neighbour in ``n_rows``.

    All copies of a row but one have a copy of themselves as neighbour.
    """
    folded = rows.groupBy(*rows.columns).agg(F.count("*").alias("_copies"))
    near = with_neighbour(folded, groups, order, "_other", following)
    # A different row may still start like this one; then all copies agree.
    same = F.col("_other").eqNullSafe(F.col(order[0]))
    other = F.struct(F.col("_other").alias("near"), F.when(same, F.col("_copies")).otherwise(1).alias("n"))
    own = F.struct(F.col(order[0]).alias("near"), F.when(same, 0).otherwise(F.col("_copies") - 1).alias("n"))
    both = near.select(*rows.columns, F.explode(F.array(other, own)).alias("_c")).filter("_c.n > 0")
    return both.select(*rows.columns, F.col("_c.near").alias("_near"), F.col("_c.n").alias(N_ROWS))


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: list[str] | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> DataFrame:
    """Ranges that are inverted or touch the next one in a forbidden way."""
    touches = {
        "not_allowed": lambda end, start: end == start,
        "allowed": lambda end, start: end <= start,
        "required": lambda end, start: end < start,
    }
    if gaps not in touches:
        raise ValueError(f"gaps must be one of {list(touches)}, got {gaps!r}")
    keys = [f"_p{i}" for i in range(len(partition_by or []))]
    ranges = df.select(
        *[F.expr(p).alias(k) for p, k in zip(partition_by or [], keys)],
        F.expr(lower).alias("lower_bound"),
        F.expr(upper).alias("upper_bound"),
    )
    rows = _neighbours(ranges, keys, ["lower_bound", "upper_bound"], following=True)
    start, end, following = F.col("lower_bound"), F.col("upper_bound"), F.col("_near")
    length_ok = F.coalesce(start <= end if zero_length_range_allowed else start < end, F.lit(False))
    # NULL bounds sort first and fail anyway: without a next bound a row is the last.
    next_ok = F.coalesce(touches[gaps](end, following), following.isNull())
    return rows.filter(~(length_ok & next_ok)).select(
        *[F.col(k).alias(p) for k, p in zip(keys, partition_by or [])], start, end, following.alias("next_lower_bound"), N_ROWS
    )


def sequential_values(
    df: DataFrame, column: str, interval: int = 1, datepart: str | None = None, group_by: list[str] | None = None
) -> DataFrame:
    """Values that are not the previous value of their group plus ``interval``."""
    groups = group_by or []
    rows = _neighbours(df.select(*_quoted([*groups, column])), groups, [column], following=False)
    if datepart:
        # Interval arithmetic keeps timestamps without a zone free of any zone.
        number, unit = (3 * interval, "month") if datepart == "quarter" else (interval, datepart)
        zoneless = df.schema[column].dataType.typeName() == "timestamp_ntz"
        kind = "timestamp_ntz" if zoneless else "timestamp"
        bad = F.col(column).cast(kind) != F.col("_near").cast(kind) + F.expr(f"interval {number} {unit}")
    else:
        bad = F.col(column) != F.col("_near") + interval
    return rows.filter(bad).select(*_quoted(groups), F.col(column), F.col("_near").alias(f"previous_{column}"), N_ROWS)
