"""The older four-table star, built straight from the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions.text import strip
from fiscalmill.operators.ranges import dense_ids, set_ids
from fiscalmill.operators.small import checked_broadcast

FACT_COLUMNS = [
    "ano_base", "populacao", "indicador_1", "nota_1", "indicador_2", "nota_2", "indicador_3", "nota_3",
    "cod_ibge", "uf_id", "classificacao_capag_id",
]


def dim_rating(raw_rating: DataFrame) -> DataFrame:
    found = raw_rating.filter("classificacao_capag is not null")
    values = found.select(F.upper(strip("classificacao_capag")).alias("classificacao_capag")).distinct()
    return set_ids(values, "classificacao_capag", "classificacao_capag_id")


def dim_institution(raw_cities: DataFrame) -> DataFrame:
    return raw_cities.select(F.col("nome").alias("nome_instituicao"), F.col("codigo").alias("cod_ibge"), "uf")


def dim_state(raw_rating: DataFrame) -> DataFrame:
    return set_ids(raw_rating.select("uf").distinct(), "uf", "uf_id")


def fact_indicators(raw_rating: DataFrame, institutions: DataFrame, states: DataFrame, ratings: DataFrame) -> DataFrame:
    """Raw indicators with dimension keys and an id in the order of all columns."""
    known = institutions.select("cod_ibge").withColumnRenamed("cod_ibge", "_code")
    state = checked_broadcast(states.withColumnRenamed("uf", "_uf"))
    rating = checked_broadcast(ratings.withColumnRenamed("classificacao_capag", "_rating"))
    joined = (
        raw_rating.withColumn("_grade", F.upper(strip("classificacao_capag")))
        .drop("classificacao_capag")
        .join(known, F.col("cod_ibge") == F.col("_code"), "left")
        .join(state, F.col("uf") == F.col("_uf"), "left")
        .join(rating, F.col("_grade") == F.col("_rating"), "left")
    )
    rows = joined.drop("cod_ibge").withColumnRenamed("_code", "cod_ibge").select(*FACT_COLUMNS)
    return dense_ids(rows, ["cod_ibge", "ano_base", *[c for c in FACT_COLUMNS if c not in ("cod_ibge", "ano_base")]], "id")
