"""Bronze: the raw columns, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fiscalmill.sources.files import CITY_COLUMNS, GDP_COLUMNS, RATING_COLUMNS


def rating(raw: DataFrame) -> DataFrame:
    return raw.select(*RATING_COLUMNS)


def cities(raw: DataFrame) -> DataFrame:
    return raw.select(*CITY_COLUMNS)


def gdp(raw: DataFrame) -> DataFrame:
    return raw.select(*GDP_COLUMNS)
