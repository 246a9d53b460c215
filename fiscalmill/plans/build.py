"""Build all layers as tables, with a gate after each."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from fiscalmill.operators.ranges import set_ids
from fiscalmill.operators.small import checked_broadcast
from fiscalmill.plans import bronze, gold, insights, silver
from fiscalmill.quality.runner import Watch, gate
from fiscalmill.quality.suites import BRONZE, GOLD, SILVER
from fiscalmill.session import settings
from fiscalmill.sources.files import CITY_COLUMNS, GDP_COLUMNS, RATING_COLUMNS, LayerTables, range_sorted
from fiscalmill.sources.json_feeds import assert_register, read_cities, read_gdp
from fiscalmill.sources.sheets import load_sheets

Tables = dict[str, DataFrame]

#: Shuffled bytes that a task of a build takes at once. They are compressed and become wide
#: rows that are sorted, about ten times as large: with Spark's 64 MB larger inputs spill.
PIECE = "4m"
#: Bytes of a stored table that a task of a build reads at once, for the same reason.
SPLIT = "4m"
#: Partitions of a shuffle that small ones are put together from; fewer would make larger pieces.
PARTITIONS = 200


def at_once(spark: SparkSession, jobs: dict[str, Callable[[], DataFrame]]) -> Tables:
    """Submit independent table writes together, so one's tail fills with the next."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def load_raw(
    tables: LayerTables, ratings: str | list[str], cities: str, gdp: str | list[str], register_check: bool = True, lines: bool = False
) -> Tables:
    """Sheet files, register and GDP feeds -> the three raw tables, replaced whole.

    GDP rows are stored in (year, code) order.  ``lines``: the feeds hold an array per
    line instead of one per file.
    """
    spark = tables.spark
    register = read_cities(spark, cities, lines)
    if register_check:
        register = assert_register(register)
    sources = {
        "capag_brasil": load_sheets(spark, ratings),
        "cidades_brasil": register,
        "pib_municipal": range_sorted(read_gdp(spark, gdp, lines), "ano", "cod_ibge"),
    }
    stored = at_once(spark, {name: (lambda n=name, df=df: tables.write("raw", n, df)) for name, df in sources.items()})
    if not tables.root:
        bronze_views(tables)
    return stored


def bronze_layer(raw: Tables) -> Tables:
    """Views; nothing is written."""
    return {
        "brz_capag_brasil": bronze.rating(raw["capag_brasil"]),
        "brz_cidades_brasil": bronze.cities(raw["cidades_brasil"]),
        "brz_pib_municipal": bronze.gdp(raw["pib_municipal"]),
    }


def bronze_views(tables: LayerTables) -> None:
    """In database mode: the bronze tables as stored views over the raw tables."""
    columns = {
        "brz_capag_brasil": ("capag_brasil", RATING_COLUMNS),
        "brz_cidades_brasil": ("cidades_brasil", CITY_COLUMNS),
        "brz_pib_municipal": ("pib_municipal", GDP_COLUMNS),
    }
    tables.spark.sql("CREATE DATABASE IF NOT EXISTS bronze")
    for view, (raw, names) in columns.items():
        tables.spark.sql(f"CREATE OR REPLACE VIEW bronze.{view} AS SELECT {', '.join(names)} FROM raw.{raw}")


def silver_layer(tables: LayerTables, brz: Tables, watch: Watch | None = None) -> Tables:
    def write(name: str, df: DataFrame, *layout) -> Callable[[], DataFrame]:
        return lambda: tables.write("silver", name, df, *layout, watch=watch)

    out = at_once(
        tables.spark,
        {
            "slv_capag_municipios": write("slv_capag_municipios", silver.rating(brz["brz_capag_brasil"]), "ano_base", [], ["cod_ibge"]),
            "slv_cidades": write("slv_cidades", silver.cities(brz["brz_cidades_brasil"]), None, [], ["cod_ibge"]),
            "slv_pib_municipal": write("slv_pib_municipal", silver.gdp(brz["brz_pib_municipal"]), "ano", [], ["cod_ibge"]),
        },
    )
    ratings = out["slv_capag_municipios"]
    dims = at_once(
        tables.spark,
        {
            "slv_dim_uf": write("slv_dim_uf", silver.dim_state(ratings, out["slv_cidades"], set_ids)),
            "slv_dim_classificacao_capag": write("slv_dim_classificacao_capag", silver.dim_rating(ratings)),
        },
    )
    return {**out, **dims}


def _write_risk(write: Callable, wide: DataFrame, gold_tables: Tables) -> DataFrame:
    risk = gold.fact_risk(wide, gold_tables["gld_fato_pib_municipal"], gold_tables["gld_dim_instituicoes"])
    return write("gld_fato_risco_fiscal", risk, "ano_base", ["classificacao_risco", "uf"], ["cod_ibge"])()


def gold_layer(tables: LayerTables, slv: Tables, watch: Watch | None = None) -> Tables:
    """Each table is computed from stored ones, so no chain is evaluated twice."""

    def write(name: str, df: DataFrame, *layout) -> Callable[[], DataFrame]:
        return lambda: tables.write("gold", name, df, *layout, watch=watch)

    ratings = slv["slv_capag_municipios"]
    out = at_once(
        tables.spark,
        {
            "gld_dim_uf": write("gld_dim_uf", slv["slv_dim_uf"]),
            "gld_dim_classificacao_capag": write("gld_dim_classificacao_capag", slv["slv_dim_classificacao_capag"]),
            "gld_dim_instituicoes": write("gld_dim_instituicoes", gold.dim_municipality(slv["slv_cidades"], ratings), None, [], ["cod_ibge"]),
        },
    )
    states = checked_broadcast(out["gld_dim_uf"])
    wide = gold.indicators_wide(ratings, states, out["gld_dim_classificacao_capag"])
    out |= at_once(
        tables.spark,
        {
            "gld_fato_indicadores_capag": write(
                "gld_fato_indicadores_capag", gold.fact_indicators(wide), "ano_base", ["uf_id", "classificacao_capag_id"], ["cod_ibge"]
            ),
            "gld_fato_pib_municipal": write(
                "gld_fato_pib_municipal", gold.fact_gdp(slv["slv_pib_municipal"], states), "ano", ["uf_id"], ["cod_ibge"]
            ),
        },
    )
    # tables that lie in buckets by municipality also meet on municipality and year as they lie
    with settings(tables.spark, **({"spark.sql.requireAllClusterKeysForCoPartition": "false"} if tables.buckets else {})):
        risk = _write_risk(write, wide, out)
    out["gld_fato_risco_fiscal"] = risk
    reports = {
        "gld_report_risco_fiscal_municipal": gold.report_municipal(risk),
        "gld_report_tendencia_anual": gold.report_trend(risk),
        "gld_report_capag_vs_pib": gold.report_rating_vs_gdp(risk),
        "gld_report_agregacao_estadual": gold.report_state(risk),
    }
    # by year, so that what asks for one year reads that year
    return out | at_once(tables.spark, {name: write(name, df, "ano_base", [], ["cod_ibge"] if "cod_ibge" in df.columns else []) for name, df in reports.items()})


def small_tasks(tables: LayerTables) -> dict[str, str]:
    """Session settings by which a task of a build takes a bounded piece."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": PIECE, "spark.sql.files.maxPartitionBytes": SPLIT}
    if not tables.buckets:  # tables in fewer buckets would be shuffled to the larger number
        number = max(PARTITIONS, int(tables.spark.conf.get("spark.sql.shuffle.partitions")))
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(number)
    return conf


def build_all(tables: LayerTables, raw: Tables, ano: int | None = None, gates: bool = True) -> Tables:
    """Raw tables -> bronze -> silver -> gold -> insights.

    A failed gate raises and leaves the layers before it as they are. The counters
    of a gate come with the writes of its layer.
    """
    with settings(tables.spark, **small_tasks(tables)):
        watches = {"silver": Watch(SILVER), "gold": Watch(GOLD)} if gates else {}
        brz = bronze_layer(raw)
        if gates:
            gate("bronze", brz, BRONZE)
        slv = silver_layer(tables, brz, watches.get("silver"))
        if gates:
            gate("silver", slv, SILVER, watches["silver"])
        gld = gold_layer(tables, slv, watches.get("gold"))
        if gates:
            gate("gold", gld, GOLD, watches["gold"])
        written = insights.save_insights(tables, gld, ano)
        if written is not None:
            gld[insights.TABLE] = written
        return {**brz, **slv, **gld}
