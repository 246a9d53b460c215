"""Dashboard cards over the gold reports.

Every card takes the optional year ``ano``; without it all years count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.functions.text import label_map

# Full state names.
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AP": "Amapa", "AM": "Amazonas", "BA": "Bahia", "CE": "Ceara",
    "DF": "Distrito Federal", "ES": "Espirito Santo", "GO": "Goias", "MA": "Maranhao", "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul", "MG": "Minas Gerais", "PA": "Para", "PB": "Paraiba", "PR": "Parana",
    "PE": "Pernambuco", "PI": "Piaui", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul", "RO": "Rondonia", "RR": "Roraima", "SC": "Santa Catarina", "SP": "Sao Paulo",
    "SE": "Sergipe", "TO": "Tocantins",
}
UNKNOWN_STATE = "Desconhecido"

RANKING = ["nome_municipio", "uf", "score_risco_fiscal", "classificacao_risco", "classificacao_capag"]


def in_year(df: DataFrame, ano: int | None) -> DataFrame:
    return df if ano is None else df.filter(F.col("ano_base") == ano)


def risk_distribution(report_municipal: DataFrame, ano: int | None = None) -> DataFrame:
    counts = in_year(report_municipal, ano).groupBy("classificacao_risco").agg(F.count("*").alias("total_municipios"))
    return counts.orderBy(F.desc("total_municipios"), "classificacao_risco")


def average_score(report_municipal: DataFrame, ano: int | None = None) -> DataFrame:
    return in_year(report_municipal, ano).agg(F.avg("score_risco_fiscal").alias("score_medio"))


def lowest_scores(report_municipal: DataFrame, ano: int | None = None, n: int = 10) -> DataFrame:
    """The n lowest scores; municipalities without a score come first."""
    rows = in_year(report_municipal, ano)
    return rows.orderBy(F.col("score_risco_fiscal").asc_nulls_first(), "cod_ibge", "ano_base").limit(n).select(*RANKING)


def highest_scores(report_municipal: DataFrame, ano: int | None = None, n: int = 10) -> DataFrame:
    rows = in_year(report_municipal, ano)
    return rows.orderBy(F.col("score_risco_fiscal").desc_nulls_last(), "cod_ibge", "ano_base").limit(n).select(*RANKING)


def municipality(report_municipal: DataFrame, nome_municipio: str, ano: int | None = None) -> DataFrame:
    rows = in_year(report_municipal, ano).filter(F.col("nome_municipio") == nome_municipio)
    return rows.orderBy(F.col("score_risco_fiscal").desc_nulls_last(), "cod_ibge", "ano_base").select(*RANKING)


def score_by_year(report_trend: DataFrame) -> DataFrame:
    score = F.avg("score_risco_fiscal").alias("score_medio")
    return report_trend.groupBy("ano_base").agg(score, F.count("*").alias("total_municipios")).orderBy("ano_base")


def trend_by_year(report_trend: DataFrame) -> DataFrame:
    known = report_trend.filter(F.col("tendencia").isin("MELHORIA", "PIORA", "ESTAVEL"))
    return known.groupBy("ano_base", "tendencia").agg(F.count("*").alias("total")).orderBy("ano_base", "tendencia")


def score_by_state(report_trend: DataFrame, ano: int | None = None) -> DataFrame:
    """Grouped by state code, so unknown codes give one row each."""
    scores = in_year(report_trend, ano).groupBy("uf").agg(F.avg("score_risco_fiscal").alias("score_medio"))
    return scores.select(label_map("uf", STATE_NAMES, UNKNOWN_STATE).alias("uf"), "score_medio")


def high_risk_by_state(report_state: DataFrame, ano: int | None = None) -> DataFrame:
    """High-risk municipalities per state; the last column is a count despite its name."""
    high = F.coalesce("municipios_risco_elevado", F.lit(0)) + F.coalesce("municipios_risco_critico", F.lit(0))
    rows = in_year(report_state, ano).orderBy(high.desc(), "uf", "ano_base")
    return rows.select(
        "uf", "total_municipios", "municipios_risco_elevado", "municipios_risco_critico", high.alias("pct_risco_alto_total")
    )


def gdp_vs_score(report_state: DataFrame, ano: int | None = None) -> DataFrame:
    rows = in_year(report_state, ano).orderBy(F.col("pib_total_estado").desc_nulls_last(), "uf", "ano_base")
    return rows.select("uf", "score_risco_medio", "pib_total_estado", "total_municipios")


def narratives(insights: DataFrame) -> DataFrame:
    return insights.orderBy("prioridade").select("titulo", "narrativa", "metrica_chave")
