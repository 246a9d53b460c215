"""Written insights: each yields one row, or none without data.

All texts are built from rows that are already aggregated or cut to the top
ten, so nothing large reaches one task.
"""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalmill.sources.files import LayerTables

logger = logging.getLogger(__name__)

TABLE = "insights_risco_fiscal"
SCHEMA = T.StructType(
    [
        T.StructField("gerado_em", T.TimestampType()),
        T.StructField("tipo", T.StringType()),
        T.StructField("prioridade", T.LongType()),
        T.StructField("titulo", T.StringType()),
        T.StructField("narrativa", T.StringType()),
        T.StructField("metrica_chave", T.StringType()),
        T.StructField("valor_metrica", T.DoubleType()),
        T.StructField("ano_base", T.LongType()),
    ]
)
LISTED = 5  # entries of a ranking named in the text

# The insight texts.
SUMMARY_TITLE = "Panorama Fiscal Municipal - Ano Base %s"
SUMMARY_TEXT = (
    "No ano base %s, foram analisados %s municipios brasileiros. "
    "O score medio de saude fiscal foi %s (de 0 a 100). "
    "%s municipios (%s%%) estao em situacao CRITICA, "
    "%s (%s%%) em risco ELEVADO, "
    "enquanto %s (%s%%) apresentam risco BAIXO. "
    "O endividamento medio (DC/RCL) foi de %s "
    "e a poupanca corrente media de %s."
)
WORST_TITLE = "Top %s Municipios em Situacao Fiscal Critica"
WORST_TEXT = (
    "Os municipios em pior situacao fiscal sao: %s. "
    "Esses municipios combinam classificacao CAPAG desfavoravel com "
    "indicadores economicos fracos. Atencao especial deve ser dada "
    "a municipios com alto endividamento e PIB abaixo da media."
)
BEST_TITLE = "Top %s Municipios com Melhor Saude Fiscal"
BEST_TEXT = (
    "Os municipios com melhor saude fiscal sao: %s. "
    "Esses municipios apresentam classificacao CAPAG 'A', "
    "baixo endividamento e economia solida."
)
STATES_TITLE = "Estados com Maior Concentracao de Risco Fiscal"
STATES_TEXT = (
    "Os estados com maior percentual de municipios em risco alto "
    "(ELEVADO + CRITICO) sao: %s. "
    "O estado %s lidera com %s%% "
    "dos seus %s municipios em situacao preocupante, "
    "com score medio de %s e PIB medio de "
    "R$ %s mil."
)
TREND_TITLE = "Tendencias de Evolucao Fiscal - Ano Base %s"
TREND_TEXT = (
    "No ano base %s, comparado ao ano anterior: "
    "%s municipios melhoraram seu score fiscal, "
    "%s pioraram e %s permaneceram estaveis. "
    "%s"
)
TREND_UP, TREND_DOWN = "Tendencia positiva.", "Tendencia preocupante."
SIZE_TITLE = "Analise: Porte do Municipio vs Risco Fiscal"
SIZE_TEXT = (
    "A analise por faixa populacional revela padroes interessantes: "
    "%s. "
    "Municipios menores tendem a ter maior vulnerabilidade fiscal, "
    "enquanto metropoles geralmente apresentam maior resiliencia economica."
)


def _text(value: Column) -> Column:
    """Any value in a sentence; a missing one reads 'None'."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def _decimal_text(value: Column, digits: int) -> Column:
    """A rounded double in the shortest form with at least one decimal."""
    fixed = F.format_string(f"%.{digits}f", value)
    short = F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", ".0")
    return F.when(value.isNull(), "None").otherwise(short)


def _sentence(template: str, *values: Column) -> Column:
    return F.format_string(template, *[_text(v) for v in values])


def _share(part: Column, total: Column) -> Column:
    """Percentage to one decimal, halves to even."""
    return F.bround(part / total * 100, 1)


def _latest(df: DataFrame, ano: int | None) -> DataFrame:
    """Rows of one year: the given one or the table's latest."""
    year = F.lit(ano) if ano is not None else df.agg(F.max("ano_base")).scalar()
    return df.filter(F.col("ano_base") == year)


def _insight(row: DataFrame, tipo: str, prioridade: int, titulo: Column, narrativa: Column, chave: Column, valor: Column) -> DataFrame:
    metric = valor.cast("double")
    return row.filter(metric.isNotNull()).select(
        F.lit(tipo).alias("tipo"),
        F.lit(prioridade).cast("bigint").alias("prioridade"),
        titulo.alias("titulo"),
        narrativa.alias("narrativa"),
        chave.alias("metrica_chave"),
        metric.alias("valor_metrica"),
        F.col("ano_base").cast("bigint").alias("ano_base"),
    )


def summary(risk: DataFrame, ano: int | None = None) -> DataFrame:
    band = F.col("classificacao_risco")
    row = _latest(risk, ano).groupBy("ano_base").agg(
        F.count("*").alias("n"),
        F.round(F.avg("score_risco_fiscal"), 1).alias("score"),
        F.count_if(band == "BAIXO").alias("low"),
        F.count_if(band == "ELEVADO").alias("high"),
        F.count_if(band == "CRITICO").alias("worst"),
        F.round(F.avg("indicador_1"), 4).alias("debt"),
        F.round(F.avg("indicador_2"), 4).alias("savings"),
    )
    score = _decimal_text(F.col("score"), 1)

    def counted(name: str) -> list[Column]:
        return [F.col(name), _decimal_text(_share(F.col(name), F.col("n")), 1)]

    text = _sentence(
        SUMMARY_TEXT, F.col("ano_base"), F.col("n"), score, *counted("worst"), *counted("high"), *counted("low"),
        _decimal_text(F.col("debt"), 4), _decimal_text(F.col("savings"), 4),
    )
    key = F.concat(F.lit("Score medio: "), score, F.lit("/100"))
    return _insight(row, "resumo_geral", 1, _sentence(SUMMARY_TITLE, F.col("ano_base")), text, key, F.col("score"))


def _ranked(top: DataFrame, order: list[Column], entry: Column, others: list[str]) -> DataFrame:
    """One row: the entries of an already limited ranking, and its leader's columns."""
    item = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], entry.alias("entry"), *others)
    items = top.agg(F.sort_array(F.collect_list(item)).alias("items")).filter(F.size("items") > 0)
    first = F.element_at("items", 1)
    listed = F.array_join(F.transform(F.slice("items", 1, LISTED), lambda i: i["entry"]), ", ")
    return items.select(listed.alias("listed"), *[first[c].alias(c) for c in others])


def _municipality_ranking(risk: DataFrame, band: str, best_first: bool, top_n: int, ano: int | None) -> DataFrame:
    score = F.col("score_risco_fiscal")
    order = [-score if best_first else score, F.col("cod_ibge")]
    rows = _latest(risk, ano).filter(F.col("classificacao_risco") == band)
    top = rows.orderBy(*order).limit(top_n)
    entry = F.format_string("%s-%s (score: %s)", _text(F.col("nome_municipio")), _text(F.col("uf")), _text(score))
    return _ranked(top, order, entry, ["ano_base", "score_risco_fiscal"])


def worst_municipalities(risk: DataFrame, ano: int | None = None, top_n: int = 10) -> DataFrame:
    row, score = _municipality_ranking(risk, "CRITICO", False, top_n, ano), F.col("score_risco_fiscal")
    text = _sentence(WORST_TEXT, F.col("listed"))
    return _insight(row, "alerta_risco", 2, F.lit(WORST_TITLE % top_n), text, F.concat(F.lit("Pior score: "), score), score)


def best_municipalities(risk: DataFrame, ano: int | None = None, top_n: int = 10) -> DataFrame:
    row, score = _municipality_ranking(risk, "BAIXO", True, top_n, ano), F.col("score_risco_fiscal")
    text = _sentence(BEST_TEXT, F.col("listed"))
    return _insight(row, "destaque_positivo", 3, F.lit(BEST_TITLE % top_n), text, F.concat(F.lit("Melhor score: "), score), score)


def critical_states(report_state: DataFrame, ano: int | None = None) -> DataFrame:
    rounded = _latest(report_state, ano).select(
        "ano_base", "uf", "total_municipios",
        F.round("pct_risco_alto", 1).alias("pct"),
        F.round("score_risco_medio", 1).alias("score"),
        F.round("pib_medio", 2).alias("gdp"),
    )
    top = rounded.orderBy(F.col("pct").desc_nulls_last(), F.col("uf").asc_nulls_first()).limit(10)
    pct = _decimal_text(F.col("pct"), 1)
    entry = F.format_string("%s (%s%%)", _text(F.col("uf")), pct)
    row = _ranked(top, [-F.col("pct"), F.col("uf")], entry, ["ano_base", "uf", "total_municipios", "pct", "score", "gdp"])
    row = row.filter("gdp is not null")
    text = _sentence(
        STATES_TEXT, F.col("listed"), F.col("uf"), pct, F.col("total_municipios"), _decimal_text(F.col("score"), 1),
        F.format_number("gdp", 2),
    )
    key = _sentence("UF com mais risco: %s (%s%%)", F.col("uf"), pct)
    return _insight(row, "analise_regional", 4, F.lit(STATES_TITLE), text, key, F.col("pct"))


def trends(report_trend: DataFrame) -> DataFrame:
    trend = F.col("tendencia")
    counts = report_trend.filter(trend != "SEM_HISTORICO").groupBy("ano_base").agg(
        F.count_if(trend == "MELHORIA").alias("up"),
        F.count_if(trend == "PIORA").alias("down"),
        F.count_if(trend == "ESTAVEL").alias("same"),
    )
    row = counts.orderBy(F.desc("ano_base")).limit(1)
    up, down = F.col("up"), F.col("down")
    verdict = F.when(up > down, TREND_UP).otherwise(TREND_DOWN)
    text = _sentence(TREND_TEXT, F.col("ano_base"), up, down, F.col("same"), verdict)
    key = _sentence("Melhorias: %s | Pioras: %s", up, down)
    return _insight(row, "tendencia", 5, _sentence(TREND_TITLE, F.col("ano_base")), text, key, up - down)


def size_vs_risk(report_rating_vs_gdp: DataFrame, ano: int | None = None) -> DataFrame:
    bands = _latest(report_rating_vs_gdp, ano).groupBy("ano_base", "faixa_populacao").agg(
        F.count("*").alias("n"), F.count_if(F.col("classificacao_risco") == "CRITICO").alias("worst")
    )
    entry = F.format_string(
        "%s: %s%% em risco critico", F.col("faixa_populacao"), _decimal_text(_share(F.col("worst"), F.col("n")), 1)
    )
    # At most four bands of one year.
    row = bands.groupBy("ano_base").agg(
        F.sort_array(F.collect_list(F.struct("faixa_populacao", entry.alias("entry")))).alias("items")
    )
    text = _sentence(SIZE_TEXT, F.array_join(F.transform("items", lambda i: i["entry"]), "; "))
    number = F.size("items")
    key = _sentence("%s faixas populacionais analisadas", number)
    return _insight(row, "correlacao", 6, F.lit(SIZE_TITLE), text, key, number)


def all_insights(
    risk: DataFrame,
    report_state: DataFrame,
    report_trend: DataFrame,
    report_rating_vs_gdp: DataFrame,
    ano: int | None = None,
    now: datetime | None = None,
) -> DataFrame:
    """All insights in one table; those without data are left out."""
    rows = [
        summary(risk, ano),
        worst_municipalities(risk, ano),
        best_municipalities(risk, ano),
        critical_states(report_state, ano),
        trends(report_trend),
        size_vs_risk(report_rating_vs_gdp, ano),
    ]
    stamp = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    table = reduce(DataFrame.unionByName, rows).withColumn("gerado_em", stamp)
    return table.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA])


def save_insights(tables: LayerTables, gold: dict[str, DataFrame], ano: int | None = None) -> DataFrame | None:
    """Replace the insights table; a failing insight is logged and skipped.

    The result is at most six rows.  Nothing is written when all are empty.  Without
    ``ano`` each insight takes the newest year of its stored table from the names of its
    partitions, so it reads that year alone; a table that is not stored is asked itself.
    """

    def year(table: str) -> int | None:
        if ano is not None or not tables.exists("gold", table):
            return ano
        return tables.newest("gold", table, "ano_base")

    builders = {
        "summary": lambda: summary(gold["gld_fato_risco_fiscal"], year("gld_fato_risco_fiscal")),
        "worst": lambda: worst_municipalities(gold["gld_fato_risco_fiscal"], year("gld_fato_risco_fiscal")),
        "best": lambda: best_municipalities(gold["gld_fato_risco_fiscal"], year("gld_fato_risco_fiscal")),
        "states": lambda: critical_states(gold["gld_report_agregacao_estadual"], year("gld_report_agregacao_estadual")),
        "trends": lambda: trends(gold["gld_report_tendencia_anual"]),
        "size": lambda: size_vs_risk(gold["gld_report_capag_vs_pib"], year("gld_report_capag_vs_pib")),
    }

    def rows_of(name: str, build) -> list:
        try:
            return build().collect()
        except Exception:
            logger.exception("insight %s failed", name)
            return []

    with ThreadPoolExecutor(len(builders)) as pool:
        found = pool.map(inheritable_thread_target(tables.spark)(rows_of), builders.keys(), builders.values())
        rows = [row for part in found for row in part]
    if not rows:
        return None
    now = datetime.now(timezone.utc)
    values = [tuple(now if f.name == "gerado_em" else r[f.name] for f in SCHEMA) for r in rows]
    return tables.write("gold", TABLE, tables.spark.createDataFrame(values, SCHEMA).coalesce(1))
