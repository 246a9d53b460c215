"""Gold: dimensions, facts, the composite risk score and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions.keys import surrogate_key
from fiscalmill.functions.text import label_map
from fiscalmill.operators.periods import with_growth, with_previous_period

# Points of a rating, and points by growth in percent (highest first).
RATING_POINTS = {"A": 70, "B": 50, "C": 25, "D": 0}
GROWTH_POINTS = [(10, 30), (5, 24), (2, 18), (0, 12)]
SHRINKING_POINTS = 6
# Lowest score of a risk band, and the name of the rest.
RISK_BANDS = [(72, "BAIXO"), (54, "MODERADO"), (36, "ELEVADO")]
WORST_BAND, NO_BAND = "CRITICO", "INDETERMINADO"
# Population bands by exclusive upper bound; all else (NULL too) is the last.
POPULATION_BANDS = [(20000, "Pequeno (< 20k)"), (100000, "Medio (20k-100k)"), (500000, "Grande (100k-500k)")]
LARGEST_BAND = "Metropole (> 500k)"


def dim_municipality(register: DataFrame, ratings: DataFrame) -> DataFrame:
    """All municipalities of the register or the ratings; names come from the register.

    A code rated under two states gives two rows, which the unique check reports.
    """
    rated = ratings.select("cod_ibge", F.col("uf").alias("_uf")).distinct()
    both = register.join(rated, "cod_ibge", "full")
    return both.select("cod_ibge", "nome_municipio", F.coalesce("uf", "_uf").alias("uf"))


def indicators_wide(ratings: DataFrame, dim_state: DataFrame, dim_rating: DataFrame) -> DataFrame:
    """Silver ratings with both dimension keys and the dimension texts.

    A state or rating without a dimension row has neither key nor text.
    """
    states = dim_state.select(F.col("uf").alias("_uf"), "uf_id")
    # At most four rows, so this side may always be broadcast.
    grades = F.broadcast(dim_rating.withColumnRenamed("classificacao_capag", "_rating"))
    joined = ratings.join(grades, F.col("classificacao_capag") == F.col("_rating"), "left")
    joined = joined.join(states, F.col("uf") == F.col("_uf"), "left")
    return joined.select(
        surrogate_key("cod_ibge", "ano_base").alias("indicador_id"),
        "cod_ibge", "ano_base", "populacao",
        "indicador_1", "nota_1", "indicador_2", "nota_2", "indicador_3", "nota_3", "icf",
        "uf_id", "classificacao_capag_id",
        F.col("_uf").alias("uf"), F.col("_rating").alias("classificacao_capag"), "descricao_classificacao",
    )


def fact_indicators(wide: DataFrame) -> DataFrame:
    return wide.drop("uf", "classificacao_capag", "descricao_classificacao")


def fact_gdp(gdp: DataFrame, dim_state: DataFrame) -> DataFrame:
    """GDP per municipality and year with its growth over the previous row."""
    grown = with_growth(gdp, "cod_ibge", "ano", "pib", "pib_ano_anterior", "taxa_crescimento_pib")
    states = dim_state.select(F.col("uf").alias("_uf"), "uf_id")
    return grown.join(states, F.col("uf") == F.col("_uf"), "left").select(
        F.col("pib_sk").alias("pib_id"), "cod_ibge", "nome_municipio", "ano", "pib", "uf_id",
        "pib_ano_anterior", "taxa_crescimento_pib",
    )


def rating_points(rating: Column) -> Column:
    return label_map(rating, {k: F.lit(v).cast("bigint") for k, v in RATING_POINTS.items()})


def growth_points(gdp: Column, growth: Column) -> Column:
    """NULL without GDP, 0 without a growth rate, else by band."""
    points = F.when(gdp.isNull(), None).when(growth.isNull(), 0)
    for low, value in GROWTH_POINTS:
        points = points.when(growth >= low, value)
    return points.otherwise(SHRINKING_POINTS).cast("bigint")


def rescaled(points: Column, full: int) -> Column:
    return F.round(points * F.lit(100.0) / F.lit(float(full))).cast("bigint")


def risk_band(score: Column) -> Column:
    band = F.when(score.isNull(), NO_BAND)
    for low, name in RISK_BANDS:
        band = band.when(score >= low, name)
    return band.otherwise(WORST_BAND)


def population_band(population: Column) -> Column:
    (high, name), *larger = POPULATION_BANDS
    band = F.when(population < high, name)
    for high, name in larger:
        band = band.when(population < high, name)
    return band.otherwise(LARGEST_BAND)


def fact_risk(wide: DataFrame, gdp: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Composite 0-100 score per municipality and year.

    Rating points plus growth points; with one side missing the other is
    rescaled to 100; with neither the score is NULL.
    """
    known_gdp = gdp.select(F.col("cod_ibge").alias("_code"), F.col("ano").alias("_year"), "pib", "taxa_crescimento_pib")
    names = municipalities.select(F.col("cod_ibge").alias("_inst"), "nome_municipio")
    base = wide.join(known_gdp, (F.col("cod_ibge") == F.col("_code")) & (F.col("ano_base") == F.col("_year")), "left")
    base = base.join(names, F.col("cod_ibge") == F.col("_inst"), "left")

    has_gdp, rating = F.col("pib").isNotNull(), F.col("_rating_points")
    growth = F.col("score_crescimento_pib")
    rating_only, gdp_only = rescaled(rating, max(RATING_POINTS.values())), rescaled(growth, GROWTH_POINTS[0][1])
    scored = base.withColumns(
        {
            "tem_pib": has_gdp,
            "_rating_points": rating_points(F.col("classificacao_capag")),
            "score_crescimento_pib": growth_points(F.col("pib"), F.col("taxa_crescimento_pib")),
        }
    ).withColumns(
        {
            "score_capag": F.when(rating.isNotNull() & F.col("tem_pib"), rating).when(rating.isNotNull(), rating_only),
            "score_risco_fiscal": F.when(rating.isNotNull() & F.col("tem_pib"), rating + growth)
            .when(rating.isNotNull(), rating_only)
            .when(F.col("tem_pib"), gdp_only),
        }
    )
    return scored.select(
        surrogate_key("cod_ibge", "ano_base").alias("risco_fiscal_id"),
        "cod_ibge", "nome_municipio", "uf", "uf_id", "ano_base", "populacao",
        "indicador_1", "nota_1", "indicador_2", "nota_2", "indicador_3", "nota_3",
        "classificacao_capag", "icf", "classificacao_capag_id", "descricao_classificacao",
        "pib", "taxa_crescimento_pib", "tem_pib",
        "score_capag", "score_crescimento_pib", "score_risco_fiscal",
        risk_band(F.col("score_risco_fiscal")).alias("classificacao_risco"),
        population_band(F.col("populacao")).alias("faixa_populacao"),
    )


INDICATOR_NAMES = {"indicador_1": "endividamento", "indicador_2": "poupanca_corrente", "indicador_3": "liquidez"}


def _renamed_indicators() -> list[Column]:
    return [F.col(c).alias(name) for c, name in INDICATOR_NAMES.items()]


def report_municipal(risk: DataFrame) -> DataFrame:
    return risk.select(
        "risco_fiscal_id", "cod_ibge", "nome_municipio", "uf", "ano_base", "populacao", "faixa_populacao",
        "classificacao_capag", "icf", "descricao_classificacao", "score_risco_fiscal", "classificacao_risco",
        "score_capag", "score_crescimento_pib", *_renamed_indicators(), "pib", "taxa_crescimento_pib",
    )


def report_trend(risk: DataFrame) -> DataFrame:
    """Score against exactly the previous year.

    Without history the change is the whole score; a score that is NULL now
    counts as stable.
    """
    current = risk.select(
        "cod_ibge", "nome_municipio", "uf", "ano_base", "score_risco_fiscal", "classificacao_risco",
        "classificacao_capag", "pib", "populacao", "faixa_populacao",
    )
    carried = {"score_ano_anterior": "score_risco_fiscal", "classificacao_risco_anterior": "classificacao_risco"}
    both = with_previous_period(current, "cod_ibge", "ano_base", carried)
    now, before = F.col("score_risco_fiscal"), F.col("score_ano_anterior")
    trend = F.when(before.isNull(), "SEM_HISTORICO").when(now > before, "MELHORIA").when(now < before, "PIORA")
    return both.select(
        "*", (now - F.coalesce(before, F.lit(0))).alias("variacao_score"), trend.otherwise("ESTAVEL").alias("tendencia")
    )


def report_rating_vs_gdp(risk: DataFrame) -> DataFrame:
    return risk.filter("pib is not null").select(
        "cod_ibge", "nome_municipio", "uf", "ano_base", "classificacao_capag", "descricao_classificacao",
        "score_risco_fiscal", "classificacao_risco", "pib", "taxa_crescimento_pib",
        *_renamed_indicators(), "populacao", "faixa_populacao",
    )


def report_state(risk: DataFrame) -> DataFrame:
    """Counts, averages and the share of high risk per state and year."""
    band = F.col("classificacao_risco")
    return risk.groupBy("uf", "ano_base").agg(
        F.count("*").alias("total_municipios"),
        F.avg("score_risco_fiscal").alias("score_risco_medio"),
        F.avg("indicador_1").alias("endividamento_medio"),
        F.avg("indicador_2").alias("poupanca_corrente_media"),
        F.avg("indicador_3").alias("liquidez_media"),
        F.avg("pib").alias("pib_medio"),
        F.sum("pib").alias("pib_total_estado"),
        F.sum("populacao").alias("populacao_total"),
        F.count_if(band == "BAIXO").alias("municipios_risco_baixo"),
        F.count_if(band == "MODERADO").alias("municipios_risco_moderado"),
        F.count_if(band == "ELEVADO").alias("municipios_risco_elevado"),
        F.count_if(band == "CRITICO").alias("municipios_risco_critico"),
        (F.try_divide(F.count_if(band.isin("ELEVADO", "CRITICO")), F.count("*")) * 100).alias("pct_risco_alto"),
    )
