"""Fingerprints of whole tables: equal tables are told from a few bytes per bucket.

Every row has two independent 64-bit hashes. The first deals it into a bucket; a bucket's
fingerprint is its number of rows and the sums of both hashes, so it does not depend on the
order of the rows and counts repeated ones. A scan folds a table to its buckets before
anything is shuffled. Where the buckets of two tables agree, so do their rows (but for
chances of about one in 2**120); only rows of other buckets are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096
_NESTED = (T.ArrayType, T.StructType)


def _parts(schema: T.StructType) -> list[Column]:
    """What a row's hashes see of its columns: hashes skip NULL, so its places count too."""
    values, nulls = [], []
    for field in schema:
        column = F.col(f"`{field.name}`")
        nulls.append(column.isNull())
        if isinstance(field.dataType, _NESTED):
            values.append(column.cast("string"))  # shows where NULLs stand inside, which the hash of the value skips
        elif isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            column = F.when(F.isnan(column), F.lit(float("nan"))).otherwise(column + F.lit(0.0))  # one zero, one NaN
        values.append(column)
    return [*values, *nulls]


def alike(a: DataFrame, b: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with the given columns, in the types that a union would give them."""
    left, right = (df.select(*[F.col(f"`{c}`") for c in columns]) for df in (a, b))
    schema = left.unionAll(right).schema
    return tuple(df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema]) for df in (left, right))


def hashed(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows with their bucket ``_bucket`` and the hashes ``_h`` and ``_g``."""
    parts = _parts(df.schema)
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    return df.select("*", first.alias("_h"), second.alias("_g")).withColumn("_bucket", F.pmod("_h", F.lit(buckets)).cast("int"))


def fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, h, g): one small row per bucket that holds rows."""
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    rows = hashed(df, buckets).groupBy(F.col("_bucket").alias("bucket"))
    return rows.agg(F.count("*").alias("n"), exact("_h").alias("h"), exact("_g").alias("g"))


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose rows differ; at most ``buckets`` numbers reach the driver."""
    negated = [(-F.col(c)).alias(c) for c in ("n", "h", "g")]
    both = fingerprint(a, buckets).unionAll(fingerprint(b, buckets).select("bucket", *negated)).groupBy("bucket")
    sums = both.agg(*[F.sum(c).alias(c) for c in ("n", "h", "g")])
    return sorted(r["bucket"] for r in sums.where("n <> 0 or h <> 0 or g <> 0").select("bucket").collect())


def rows_of(df: DataFrame, numbers: list[int], buckets: int = BUCKETS) -> DataFrame:
    """The rows of some buckets, with the columns of ``df``."""
    return hashed(df, buckets).where(F.col("_bucket").isin(numbers)).select(*[F.col(f"`{c}`") for c in df.columns])
