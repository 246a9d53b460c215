"""Choice of the newest published file per year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_per_year(manifest: DataFrame, order: str) -> DataFrame:
    """One file per year from (name, url, format, created).

    Only spreadsheets whose name has a year and is not about metadata count.
    The newest dd/mm/yyyy in the name wins, else the creation time; on a tie
    the file that comes first by ``order``.  All times are compared in UTC.
    """
    day = F.regexp_extract("name", r"(\d{2}/\d{2}/\d{4})", 1)
    named = F.try_to_timestamp(F.concat(day, F.lit(" +00:00")), F.lit("dd/MM/yyyy XXX"))
    zoned = F.col("created").rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    created = F.when(zoned, F.col("created")).otherwise(F.concat("created", F.lit("Z"))).try_cast("timestamp")
    files = manifest.filter((F.upper("format") == "XLSX") & ~F.lower("name").contains("metadados"))
    files = files.withColumn("year", F.regexp_extract("name", r"(\d{4})", 1).try_cast("bigint"))
    files = files.withColumn("_key", F.coalesce(F.when(day != "", named), created))
    # Year 0 counts as no year.
    window = Window.partitionBy("year").orderBy(F.col("_key").desc_nulls_last(), F.col(order))
    newest = files.filter("year <> 0").withColumn("_rn", F.row_number().over(window)).filter("_rn = 1")
    return newest.select(F.col("name").alias("title"), F.col("url").alias("link"), "year", F.col("_key").alias("sort_key"))


def new_files_only(files: DataFrame, stored_years: DataFrame) -> DataFrame:
    """Files whose base year (published year - 1) is not stored yet.

    ``stored_years`` is the ``_year`` column made by ``years_stored``.
    """
    missing = files.withColumn("_year", F.col("year") - 1).join(stored_years, "_year", "left_anti")
    return missing.select(*files.columns)
