"""Silver: typed, cleaned, one row per key; and the two dimension sets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions.keys import surrogate_key
from fiscalmill.functions.text import NOT_AVAILABLE, decimal_comma, grade, label_map, null_if_in, safe_double, strip
from fiscalmill.operators.dedup import deduplicate
from fiscalmill.operators.ranges import set_ids, small_set_ids

# The ratings and their descriptions.
RATING_TEXT = {
    "A": "Boa capacidade de pagamento",
    "B": "Capacidade de pagamento media",
    "C": "Capacidade de pagamento fraca",
    "D": "Informacao insuficiente",
}
UNRATED_TEXT = "Nao classificado"


def rating(bronze: DataFrame) -> DataFrame:
    """Ratings, one row per municipality and year: the highest rating text wins.

    'n.d.' is nulled in grades and indicators but not in the rating itself.
    """
    cleaned = bronze.filter("cod_ibge is not null and ano_base is not null").select(
        strip("instituicao").alias("instituicao"),
        F.col("cod_ibge").cast("bigint").alias("cod_ibge"),
        F.upper(strip("uf")).alias("uf"),
        null_if_in(F.col("populacao").cast("string"), "").cast("bigint").alias("populacao"),
        decimal_comma("indicador_1").alias("indicador_1"),
        grade("nota_1", NOT_AVAILABLE, "").alias("nota_1"),
        decimal_comma("indicador_2").alias("indicador_2"),
        grade("nota_2", NOT_AVAILABLE, "").alias("nota_2"),
        decimal_comma("indicador_3").alias("indicador_3"),
        grade("nota_3", NOT_AVAILABLE, "").alias("nota_3"),
        grade("classificacao_capag", "").alias("classificacao_capag"),
        grade("icf", NOT_AVAILABLE, "").alias("icf"),
        F.col("ano_base").cast("bigint").alias("ano_base"),
        surrogate_key("cod_ibge", "ano_base").alias("capag_sk"),
    )
    return deduplicate(cleaned, ["cod_ibge", "ano_base"], [F.col("classificacao_capag").desc_nulls_last()])


def cities(bronze: DataFrame) -> DataFrame:
    """Municipality register, one row per code: the lowest id wins."""
    cleaned = bronze.filter("codigo is not null").select(
        F.col("codigo").cast("bigint").alias("cod_ibge"),
        strip("nome").alias("nome_municipio"),
        F.upper(strip("uf")).alias("uf"),
        F.col("id").try_cast("bigint").alias("_id"),
    )
    return deduplicate(cleaned, ["cod_ibge"], [F.col("_id").asc_nulls_first()]).drop("_id")


def gdp(bronze: DataFrame) -> DataFrame:
    """GDP, one row per municipality and year: the largest value wins."""
    cleaned = bronze.filter("cod_ibge is not null and ano is not null").select(
        F.col("ano").cast("bigint").alias("ano"),
        F.col("cod_ibge").cast("bigint").alias("cod_ibge"),
        strip("nome_municipio").alias("nome_municipio"),
        F.upper(strip("uf")).alias("uf"),
        safe_double(F.col("pib").cast("string")).alias("pib"),
        surrogate_key("cod_ibge", "ano").alias("pib_sk"),
    )
    return deduplicate(cleaned, ["cod_ibge", "ano"], [F.col("pib").desc_nulls_last()])


def dim_state(ratings: DataFrame, register: DataFrame, ids: Callable = set_ids) -> DataFrame:
    """All states of both tables with a dense id.

    Over stored tables ``ids=set_ids`` also copes with a column full of other
    text; over a lazy chain the few states of the domain are taken for granted.
    """
    states = ratings.select("uf").union(register.select("uf")).filter("uf is not null").distinct()
    return ids(states, "uf", "uf_id")


def dim_rating(ratings: DataFrame) -> DataFrame:
    """The ratings A to D that occur (at most four rows), with id and text."""
    found = ratings.select("classificacao_capag").filter(F.col("classificacao_capag").isin(*RATING_TEXT)).distinct()
    text = label_map("classificacao_capag", RATING_TEXT, UNRATED_TEXT)
    return small_set_ids(found, "classificacao_capag", "classificacao_capag_id").withColumn("descricao_classificacao", text)
