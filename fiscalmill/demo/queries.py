"""Registered queries: (spark, sf_dir) -> DataFrame over the generated tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.demo.derive import RAW_CITY, RAW_GDP, RAW_RATING, derived, raw_tables, table
from fiscalmill.functions import arith, web
from fiscalmill.functions.keys import surrogate_key
from fiscalmill.functions.text import blank_null_words, decimal_comma, integer_text, state_from_code
from fiscalmill.operators import shape
from fiscalmill.operators.dedup import deduplicate
from fiscalmill.operators.periods import with_growth, with_previous_period
from fiscalmill.operators.pivot import column_values, get_column_values, pivot, unpivot
from fiscalmill.operators.ranges import dense_ids
from fiscalmill.operators.series import date_spine, generate_series
from fiscalmill.operators.small import checked_broadcast
from fiscalmill.operators.union import relations_by_pattern, relations_by_prefix, union_relations
from fiscalmill.plans import bronze, build, cards, gold, insights, legacy, silver
from fiscalmill.quality import checks, runner
from fiscalmill.quality.suites import GOLD, SILVER
from fiscalmill.session import scratch_dir
from fiscalmill.sources import json_feeds, manifest, sheets
from fiscalmill.sources.files import (
    CITY_COLUMNS,
    LAYERS,
    LayerTables,
    append_new_years,
    new_years_only,
    order_manifest,
    overlapping_files,
    range_sorted,
    read_csv,
    years_stored,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Doubles rounded for comparison; sums of doubles depend on row order."""
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


# ---- the models, each from the raw tables ----------------------------------


class Models:
    """All models of one scale, lazy; Spark reuses the shared shuffles."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        raw = raw_tables(spark, sf_dir)
        self.bronze = build.bronze_layer(raw)
        self.ratings = silver.rating(self.bronze["brz_capag_brasil"])
        self.cities = silver.cities(self.bronze["brz_cidades_brasil"])
        self.gdp = silver.gdp(self.bronze["brz_pib_municipal"])

    @cached_property  # numbering the states stores them; once is enough
    def states(self) -> DataFrame:
        return silver.dim_state(self.ratings, self.cities)

    @property
    def wide(self) -> DataFrame:
        return gold.indicators_wide(self.ratings, self.states, silver.dim_rating(self.ratings))

    @property
    def fact_gdp(self) -> DataFrame:
        return gold.fact_gdp(self.gdp, self.states)

    @property
    def municipalities(self) -> DataFrame:
        return gold.dim_municipality(self.cities, self.ratings)

    @property
    def risk(self) -> DataFrame:
        return gold.fact_risk(self.wide, self.fact_gdp, self.municipalities)


@query
def bronze_rating(spark, sf):
    return bronze.rating(derived(spark, sf, RAW_RATING))


@query
def bronze_cities(spark, sf):
    return bronze.cities(derived(spark, sf, RAW_CITY))


@query
def bronze_gdp(spark, sf):
    return bronze.gdp(derived(spark, sf, RAW_GDP))


@query
def silver_rating(spark, sf):
    return Models(spark, sf).ratings


@query
def silver_city(spark, sf):
    return Models(spark, sf).cities


@query
def silver_gdp(spark, sf):
    return Models(spark, sf).gdp


@query
def dim_state(spark, sf):
    return Models(spark, sf).states


@query
def dim_rating(spark, sf):
    return silver.dim_rating(Models(spark, sf).ratings)


@query
def dim_municipality(spark, sf):
    return Models(spark, sf).municipalities


@query
def fact_indicators(spark, sf):
    return gold.fact_indicators(Models(spark, sf).wide)


@query
def fact_gdp(spark, sf):
    return Models(spark, sf).fact_gdp


@query
def risk_fact(spark, sf):
    return Models(spark, sf).risk


@query
def risk_report(spark, sf):
    return gold.report_municipal(Models(spark, sf).risk)


@query
def trend_report(spark, sf):
    return gold.report_trend(Models(spark, sf).risk)


@query
def rating_vs_gdp(spark, sf):
    return gold.report_rating_vs_gdp(Models(spark, sf).risk)


@query
def risk_by_state(spark, sf):
    return gold.report_state(Models(spark, sf).risk)


def _raw_grades(spark, sf):
    raw = derived(spark, sf, RAW_RATING)
    return raw, legacy.dim_institution(derived(spark, sf, RAW_CITY)), legacy.dim_state(raw), legacy.dim_rating(raw)


@query
def legacy_dim_rating(spark, sf):
    return legacy.dim_rating(derived(spark, sf, RAW_RATING))


@query
def legacy_dim_state(spark, sf):
    return legacy.dim_state(derived(spark, sf, RAW_RATING))


@query
def legacy_dim_institution(spark, sf):
    return legacy.dim_institution(derived(spark, sf, RAW_CITY))


@query
def legacy_fact(spark, sf):
    return legacy.fact_indicators(*_raw_grades(spark, sf))


# ---- cards and insights: they read the stored gold tables ------------------

_stored: dict[tuple[str, str], dict[str, DataFrame]] = {}


def stored_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All layers as written tables, built once per application and input.

    The dashboard and the insights are defined on the stored gold tables, so
    they share one build instead of repeating it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        tables = LayerTables(spark, scratch_dir(spark, "layers"))
        _stored[key] = build.build_all(tables, raw_tables(spark, sf_dir))
    return _stored[key]


def _report(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: stored_gold(spark, sf)[f"gld_report_{name}"]


_municipal, _trend, _state = (_report(n) for n in ("risco_fiscal_municipal", "tendencia_anual", "agregacao_estadual"))


@query
def card_1_1(spark, sf):
    return cards.risk_distribution(_municipal(spark, sf))


@query
def card_1_2(spark, sf):
    return cards.average_score(_municipal(spark, sf))


@query
def card_1_2_year(spark, sf):
    return cards.average_score(_municipal(spark, sf), 1998)


@query
def card_1_3(spark, sf):
    return cards.lowest_scores(_municipal(spark, sf))


@query
def card_1_4(spark, sf):
    return cards.highest_scores(_municipal(spark, sf))


@query
def card_1_5(spark, sf):
    return cards.municipality(_municipal(spark, sf), "Customer#000000007")


@query
def card_2_1(spark, sf):
    return cards.score_by_year(_trend(spark, sf))


@query
def card_2_2(spark, sf):
    return cards.trend_by_year(_trend(spark, sf))


@query
def card_2_3(spark, sf):
    return cards.score_by_state(_trend(spark, sf))


@query
def card_3_1(spark, sf):
    return cards.high_risk_by_state(_state(spark, sf), 1999)


@query
def card_3_2(spark, sf):
    return cards.gdp_vs_score(_state(spark, sf))


def _insights(spark, sf, *, now=None):
    gold_tables = stored_gold(spark, sf)
    return insights.all_insights(
        gold_tables["gld_fato_risco_fiscal"], gold_tables["gld_report_agregacao_estadual"],
        gold_tables["gld_report_tendencia_anual"], gold_tables["gld_report_capag_vs_pib"], now=now,
    )


@query
def card_4_1(spark, sf):
    return cards.narratives(stored_gold(spark, sf)[insights.TABLE])


@query
def insight_1(spark, sf):
    return insights.summary(stored_gold(spark, sf)["gld_fato_risco_fiscal"])


@query
def insight_2(spark, sf):
    return insights.worst_municipalities(stored_gold(spark, sf)["gld_fato_risco_fiscal"])


@query
def insight_3(spark, sf):
    return insights.best_municipalities(stored_gold(spark, sf)["gld_fato_risco_fiscal"])


@query
def insight_4(spark, sf):
    return insights.critical_states(_state(spark, sf))


@query
def insight_5(spark, sf):
    return insights.trends(_trend(spark, sf))


@query
def insight_6(spark, sf):
    return insights.size_vs_risk(stored_gold(spark, sf)["gld_report_capag_vs_pib"])


@query
def insights_table(spark, sf):
    return _insights(spark, sf).drop("gerado_em")


@query
def build_layers(spark, sf):
    """A fresh build of all layers with their gates; rows per stored table."""
    tables = build.build_all(LayerTables(spark, scratch_dir(spark, "build")), raw_tables(spark, sf))
    counts = [df.agg(F.lit(n).alias("table_name"), F.count("*").alias("n")) for n, df in tables.items() if not n.startswith("brz_")]
    return _union_all(counts)


@query
def build_databases(spark, sf):
    """A fresh build with one database per layer, tables in buckets by municipality and stored bronze views; rows per table of the catalog."""
    root = scratch_dir(spark, "databases")
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root}/{layer}'")
    tables = LayerTables(spark, buckets=8)
    raw = {name: tables.write("raw", name, df) for name, df in raw_tables(spark, sf).items()}
    build.bronze_views(tables)
    layers = {"brz": "bronze", "slv": "silver"}
    stored = [f"{layers.get(name[:3], 'gold')}.{name}" for name in build.build_all(tables, raw)]
    return _union_all([spark.table(name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n")) for name in stored])


def _union_all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


# ---- growth and history ----------------------------------------------------


def _customer_years(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.groupBy("o_custkey", F.year("o_orderdate").cast("bigint").alias("y")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("v")
    )


@query
def gdp_growth_lag(spark, sf):
    grown = with_growth(_customer_years(spark, sf), "o_custkey", "y", "v", "v_prev", "growth")
    return rounded(grown, growth=6)


@query
def gdp_growth_gap_aware(spark, sf):
    grown = with_growth(_customer_years(spark, sf), "o_custkey", "y", "v", "v_prev", "growth", gap_aware=True)
    return rounded(grown, growth=6)


@query
def yoy_selfjoin(spark, sf):
    return with_previous_period(_customer_years(spark, sf), "o_custkey", "y", {"v_year_before": "v"})


# ---- generic operators -----------------------------------------------------


@query
def dedup_lineitem(spark, sf):
    return deduplicate(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])


def _orders_with_gaps(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")))


@query
def surrogate_keys(spark, sf):
    return _orders_with_gaps(spark, sf).select(
        "o_orderkey",
        surrogate_key("o_orderkey", "o_orderpriority").alias("sk"),
        surrogate_key("o_custkey", "o_orderpriority", nulls_as_empty=True).alias("sk_empty"),
    )


def _parties(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").cast("decimal(18,2)").alias("balance"),
        F.col("s_nationkey").cast("bigint").alias("nation"),
    )
    return {"customer": customer, "supplier": supplier}


@query
def union_superset(spark, sf):
    return union_relations(_parties(spark, sf), column_override={"nation": "bigint"}, source_column_name="src")


@query
def union_include(spark, sf):
    return union_relations(_parties(spark, sf), include=["ID", "segment"], source_column_name=None)


@query
def union_exclude(spark, sf):
    return union_relations(_parties(spark, sf), exclude=["Name", "balance"], source_column_name="src")


@query
def union_where(spark, sf):
    return union_relations(_parties(spark, sf), where="nation < 5", source_column_name="src")


@query
def pivot_status(spark, sf):
    orders = table(spark, sf, "orders")
    statuses = get_column_values(orders, "o_orderstatus", order_by=[F.col("value")])
    return orders.groupBy("o_orderpriority").agg(*pivot("o_orderstatus", statuses, prefix="n_"))


@query
def pivot_distinct(spark, sf):
    orders = table(spark, sf, "orders")
    cells = pivot("o_orderstatus", ["F", "O", "P"], agg="count", prefix="customers ", distinct=True,
                  then_value=F.col("o_custkey"), else_value=None, quote_identifiers=False)
    return orders.groupBy("o_orderpriority").agg(*cells)


@query
def column_value_counts(spark, sf):
    return column_values(table(spark, sf, "orders"), "o_custkey", max_records=25, where="o_orderstatus <> 'P'")


@query
def unpivot_mixed(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", (F.col("p_size") > 25).alias("is_large"),
        F.nullif("p_brand", F.lit("Brand#11")).alias("brand_or_null"),
    )
    return unpivot(part, exclude=["p_partkey"], remove=["P_Name"], field_name="prop", value_name="val")


@query
def star_prefix(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*shape.star(orders, except_=["O_TOTALPRICE"], prefix="a_", suffix="_z"))


@query
def nullcheck(spark, sf):
    blanked = table(spark, sf, "orders").select(
        "o_orderkey", F.regexp_replace("o_orderstatus", "P", "").alias("o_orderstatus"),
        F.regexp_replace("o_orderpriority", "^.*NOT.*$", "").alias("o_orderpriority"),
    )
    return shape.nullcheck_table(blanked)


@query
def group_by_first_two(spark, sf):
    flags = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    quantity = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity")
    return shape.group_by_n(flags, 2).agg(F.count("*").alias("n"), quantity)


@query
def series_gaps(spark, sf):
    """Every key up to the largest customer key with its number of orders."""
    top = shape.get_single_value(table(spark, sf, "customer").agg(F.max("c_custkey")), 1)
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("n")).agg(F.count("*").alias("orders"))
    series = generate_series(spark, top, "n")
    return series.join(counts, "n", "left").select("n", F.coalesce("orders", F.lit(0)).alias("orders"))


def _order_days(spark, sf, datepart):
    orders = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    first, last = orders.agg(F.min("d"), F.max("d")).first()
    unit = F.date_trunc(datepart, F.lit(first)) if datepart != "day" else F.lit(first)
    start = spark.range(1).select(unit.cast("date")).first()[0]
    # The end is excluded, so it lies one part after the last one that has orders.
    end = spark.range(1).select(F.expr(f"timestampadd({datepart}, 1, date_trunc('{datepart}', date'{last}'))").cast("date")).first()[0]
    spine = date_spine(spark, datepart, start, end)
    counts = orders.groupBy(F.trunc("d", datepart) if datepart != "day" else F.col("d")).agg(F.count("*").alias("orders"))
    counts = counts.toDF(f"date_{datepart}", "orders")
    return spine.join(counts, f"date_{datepart}", "left").select(f"date_{datepart}", F.coalesce("orders", F.lit(0)).alias("orders"))


@query
def date_spine_day(spark, sf):
    return _order_days(spark, sf, "day")


@query
def date_spine_month(spark, sf):
    return _order_days(spark, sf, "month")


@query
def haversine(spark, sf):
    lat1, lon1 = F.col("c_nationkey") * 3.0 - 36.0, F.col("c_custkey") % 360 - 180.0
    lat2, lon2 = F.lit(-15.75), F.lit(-47.75)
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.round(arith.haversine_distance(lat1, lon1, lat2, lon2), 6).alias("miles"),
        F.round(arith.haversine_distance(lat1, lon1, lat2, lon2, "km"), 6).alias("km"),
    )


def _lines_with_gaps(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.nullif("l_quantity", F.lit(7.0)).alias("q"),
        F.nullif("l_linenumber", F.lit(3)).alias("n"),
        (F.col("l_partkey") % 5).alias("d"),
    )


@query
def safe_add(spark, sf):
    return _lines_with_gaps(spark, sf).select("l_orderkey", "l_linenumber", arith.safe_add("q", "n", "d").alias("total"))


@query
def safe_subtract(spark, sf):
    return _lines_with_gaps(spark, sf).select("l_orderkey", "l_linenumber", arith.safe_subtract("q", "n", "d").alias("rest"))


@query
def safe_divide(spark, sf):
    lines = _lines_with_gaps(spark, sf)
    return lines.select(
        "l_orderkey", "l_linenumber",
        F.round(arith.safe_divide("q", "d"), 6).alias("ratio"),
        F.round(arith.safe_divide(F.col("q") * F.col("n"), F.col("d") * F.col("n")), 6).alias("weighted"),
    )


@query
def width_bucket_price(spark, sf):
    part = table(spark, sf, "part")
    return part.select("p_partkey", arith.width_bucket("p_retailprice", 1000, 1800, 8).cast("bigint").alias("bucket"))


@query
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_host("url").alias("host"))


@query
def url_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", web.url_path("url").alias("path"))


@query
def url_param(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", web.url_parameter("url", "page").alias("page"), web.url_parameter("url", "ref").alias("ref")
    )


@query
def tables_by_pattern_union(spark, sf):
    """One view per order status, found again by a name pattern."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("F", "O", "P"):
        orders.filter(F.col("o_orderstatus") == status).createOrReplaceTempView(f"fm_orders_{status.lower()}")
    found = relations_by_pattern(spark, None, "FM_orders_%", exclude="%_p")
    return union_relations(found, source_column_name="src")


@query
def tables_by_prefix_union(spark, sf):
    """One view per return flag, found again by the beginning of their names."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    for flag in ("A", "N", "R"):
        lines.filter(F.col("l_returnflag") == flag).createOrReplaceTempView(f"fm_lines_{flag.lower()}")
    return union_relations(relations_by_prefix(spark, None, "fm_LINES_", exclude="%_n"), source_column_name="src")


@query
def single_value_filter(spark, sf):
    """Orders of the last order day, through a one-row value."""
    orders = table(spark, sf, "orders")
    last = shape.single_value(orders.agg(F.max("o_orderdate")), "last_day")
    return orders.join(F.broadcast(last), F.col("o_orderdate") == F.col("last_day")).select("o_orderkey", "o_custkey")


@query
def columns_to_arrays(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return shape.results_as_arrays(counts, [F.col("o_orderpriority")]).select(
        F.array_join("o_orderpriority", "|").alias("priorities"), F.array_join(F.col("n").cast("array<string>"), "|").alias("counts")
    )


@query
def columns_to_array_chunks(spark, sf):
    """Order lines as arrays of a thousand, in order."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    chunks = shape.results_in_chunks(lines, ["l_orderkey", "l_linenumber", "q"], 1000)
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), "|")
    return chunks.select("chunk", joined("l_orderkey").alias("keys"), joined("l_linenumber").alias("numbers"), joined("q").alias("quantities"))


@query
def dense_ids_large(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")
    return dense_ids(lines, ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"], "id")


# ---- data quality ----------------------------------------------------------


@query
def dq_not_null(spark, sf):
    return checks.not_null(_orders_with_gaps(spark, sf), "o_orderpriority").select("o_orderkey", "o_orderstatus")


@query
def dq_unique(spark, sf):
    return checks.unique(table(spark, sf, "lineitem"), "l_partkey")


@query
def dq_accepted_values(spark, sf):
    return checks.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view"])


@query
def dq_relationships(spark, sf):
    return checks.relationships(table(spark, sf, "lineitem"), "l_partkey", table(spark, sf, "supplier"), "s_suppkey")


@query
def dq_relationships_where(spark, sf):
    return checks.relationships_where(
        table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey",
        "o_orderstatus <> 'P'", "c_mktsegment <> 'BUILDING'",
    )


@query
def dq_accepted_range(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("l_quantity", F.nullif("l_quantity", F.lit(50.0)))
    bad = checks.accepted_range(lines, "l_quantity", 2, 45, inclusive=False)
    return bad.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def dq_at_least_one(spark, sf):
    orders = _orders_with_gaps(spark, sf).withColumn("p", F.when(F.col("o_orderpriority") > "3", F.col("o_orderpriority")))
    return checks.at_least_one(orders, "p", ["o_custkey"])


@query
def dq_cardinality_equality(spark, sf):
    return checks.cardinality_equality(table(spark, sf, "customer"), "c_nationkey", table(spark, sf, "supplier"), "s_nationkey")


def _nations(spark, sf):
    return (
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"), F.lit("x").alias("kind")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("x").alias("kind")),
    )


@query
def dq_equal_rowcount(spark, sf):
    return checks.equal_rowcount(*_nations(spark, sf), ["nation"])


@query
def dq_fewer_rows_than(spark, sf):
    return checks.fewer_rows_than(*_nations(spark, sf), ["nation"])


@query
def dq_equality(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return checks.equality(
        orders.filter("o_orderpriority < '3'"), orders.filter("o_orderpriority > '2'"), ["o_custkey", "o_orderstatus"]
    )


@query
def dq_equality_multiset(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority")
    return checks.equality(
        orders.filter("o_orderpriority < '3'"), orders.filter("o_orderpriority > '2'"), ["o_custkey", "o_orderstatus"], multiset=True
    )


@query
def dq_expression_is_true(spark, sf):
    bad = checks.expression_is_true(table(spark, sf, "lineitem"), "l_quantity * 2 <= l_linenumber * 20")
    return bad.select("l_orderkey", "l_linenumber", "l_quantity")


@query
def dq_mutually_exclusive_ranges(spark, sf):
    """Order periods of 60 days per customer."""
    periods = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderdate").cast("date").alias("d"), F.date_add(F.col("o_orderdate").cast("date"), 60).alias("e")
    )
    return checks.mutually_exclusive_ranges(periods, "d", "e", ["o_custkey"])


@query
def dq_mutually_exclusive_ranges_global(spark, sf):
    spans = table(spark, sf, "events").select(F.col("event_id").alias("a"), (F.col("event_id") + F.col("user_id") % 3).alias("b"))
    return checks.mutually_exclusive_ranges(spans, "a", "b", gaps="not_allowed", zero_length_range_allowed=True)


@query
def dq_not_accepted_values(spark, sf):
    return checks.not_accepted_values(table(spark, sf, "events"), "event_type", ["error", "missing"])


@query
def dq_not_constant(spark, sf):
    return checks.not_constant(table(spark, sf, "orders"), "o_orderstatus", ["o_custkey"])


@query
def dq_not_empty_string(spark, sf):
    names = table(spark, sf, "orders").select("o_orderkey", F.regexp_replace("o_orderstatus", "P", "  ").alias("s"))
    return checks.not_empty_string(names, "s")


@query
def dq_not_null_proportion(spark, sf):
    bad = checks.not_null_proportion(_orders_with_gaps(spark, sf), "o_orderpriority", 0.7, 0.9, ["o_custkey"])
    return rounded(bad, not_null_proportion=6)


@query
def dq_recency(spark, sf):
    """Users whose last event is more than two days older than the newest one."""
    events = table(spark, sf, "events")
    newest = shape.get_single_value(events.agg(F.max("ts").cast("timestamp")))
    bad = checks.recency(events, "ts", "day", 2, now=newest, group_by=["user_id"])
    return bad.select("user_id", F.col("most_recent").cast("timestamp_ntz"), F.col("threshold").cast("timestamp_ntz"))


@query
def dq_sequential_values(spark, sf):
    return checks.sequential_values(table(spark, sf, "lineitem"), "l_linenumber", 1, group_by=["l_orderkey"])


@query
def dq_sequential_values_global(spark, sf):
    """Total prices of all orders, which leave gaps."""
    return checks.sequential_values(table(spark, sf, "orders").selectExpr("cast(floor(o_totalprice) as bigint) as price"), "price")


@query
def dq_sequential_values_day(spark, sf):
    days = table(spark, sf, "orders").select("o_custkey", F.col("o_orderdate").alias("day"))
    bad = checks.sequential_values(days, "day", 1, "day", ["o_custkey"])
    return bad.select("o_custkey", F.col("day").cast("date"), F.col("previous_day").cast("date").alias("previous_day"), "n_rows")


@query
def dq_unique_combination(spark, sf):
    return checks.unique_combination_of_columns(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_assert_equal(spark, sf):
    return checks.assert_equal(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey").select("l_orderkey", "l_linenumber")


SUMMARY_CHECKS = [
    runner.not_null("orders", "o_orderkey"),
    runner.accepted_range("lineitem", "l_quantity", 1, 50),
    runner.accepted_range("lineitem", "l_discount", 0, 0.05, severity="warn"),
    runner.expression_is_true("lineitem", ">= 0", "l_tax"),
    runner.not_null("lineitem", "l_shipdate", where="l_linenumber = 1"),
    runner.not_empty_string("orders", "o_orderstatus"),
    runner.has_rows("orders"),
    runner.unique("orders", "o_orderkey"),
    runner.unique("lineitem", "l_orderkey", severity="warn"),
    runner.accepted_values("orders", "o_orderstatus", ["F", "O", "P"]),
    runner.relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
    runner.equal_rowcount("orders", "orders"),
    runner.fewer_rows_than("orders", "lineitem"),
    runner.fewer_rows_than("lineitem", "orders", severity="warn"),
    runner.equality("orders", "orders", ["o_orderkey", "o_custkey"]),
    runner.unique_combination_of_columns("orders", ["o_orderkey", "o_custkey"]),
    runner.not_constant("orders", "o_orderstatus"),
    runner.at_least_one("orders", "o_custkey"),
    runner.custom("columns_match_set", "region", lambda df, _: checks.columns_match_set(df, ["R_NAME", "r_regionkey"])),
    runner.custom("sequential_values", "orders", lambda df, _: checks.sequential_values(df, "o_orderkey"), "o_orderkey", folded=True),
]


def _check_counts(tables: dict[str, DataFrame], suite: list[runner.Check]) -> DataFrame:
    """Failures per check with its name, as one lazy table."""
    counts = runner.failure_counts(tables, suite)

    def named(attribute: str):
        return F.element_at(F.lit([getattr(c, attribute) for c in suite]), F.col("position") + 1)

    return counts.select(
        named("name").alias("check_name"), named("table").alias("table_name"), named("column").alias("column_name"), "failures"
    )


@query
def dq_summary(spark, sf):
    """Passing and failing checks of several tables in one job."""
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem", "region")}
    return _check_counts(tables, SUMMARY_CHECKS)


@query
def dq_silver_suite(spark, sf):
    models = Models(spark, sf)
    tables = {
        "slv_capag_municipios": models.ratings, "slv_cidades": models.cities, "slv_pib_municipal": models.gdp,
        "slv_dim_uf": models.states, "slv_dim_classificacao_capag": silver.dim_rating(models.ratings),
    }
    return _check_counts(tables, SILVER)


@query
def dq_gold_suite(spark, sf):
    """The gold checks read the stored tables, as the gate does."""
    return _check_counts(stored_gold(spark, sf), GOLD)


# ---- sources ---------------------------------------------------------------

MANIFEST = """
select case when o_orderkey % 7 = 0 then 'Metadados ' else 'Ratings ' end || cast(year(o_orderdate) as string)
    || case when o_orderkey % 3 = 0 then ' - ' || lpad(cast(day(o_orderdate) as string), 2, '0') || '/'
       || lpad(cast(month(o_orderdate) as string), 2, '0') || '/' || cast(year(o_orderdate) as string) else '' end as name,
  'file/' || cast(o_orderkey as string) as url,
  case o_orderstatus when 'F' then 'XLSX' when 'O' then 'xlsx' else 'CSV' end as format,
  case when o_orderkey % 5 = 0 then 'soon' else cast(cast(o_orderdate as date) as string) || 'T00:00:00Z' end as created,
  o_orderkey as ord
from {orders}
"""


@query
def latest_per_year(spark, sf):
    return manifest.latest_per_year(derived(spark, sf, MANIFEST), "ord").select(
        "title", "link", "year", F.unix_seconds("sort_key").alias("sort_second")
    )


@query
def new_files(spark, sf):
    """Newest files whose base year has no rating grade yet."""
    stored = derived(spark, sf, RAW_RATING).filter("icf is not null")
    newest = manifest.latest_per_year(derived(spark, sf, MANIFEST), "ord")
    return manifest.new_files_only(newest, years_stored(stored, "ano_base")).select("title", "link", "year")


@query
def new_years(spark, sf):
    stored = derived(spark, sf, RAW_RATING).filter("icf is not null")
    return new_years_only(derived(spark, sf, RAW_GDP), "ano", stored, "ano_base")


@query
def append_years(spark, sf):
    """Store the older GDP years, then append: only the new years arrive."""
    gdp = derived(spark, sf, RAW_GDP).select("ano", "cod_ibge", "pib")
    unreadable = gdp.select(F.concat(F.lit("year "), "ano").alias("ano"), "cod_ibge", "pib")
    gdp = gdp.unionAll(unreadable)
    tables = LayerTables(spark, scratch_dir(spark, "append"))
    append_new_years(tables, "raw", "gdp", gdp.filter("ano < '1998'"), "ano")
    append_new_years(tables, "raw", "gdp", gdp, "ano")
    stored = append_new_years(tables, "raw", "gdp", gdp, "ano")  # adds nothing
    return stored.groupBy("ano").agg(F.count("*").alias("n"))


@query
def csv_load(spark, sf):
    """Write the register as CSV with its columns in another order, read it back by name as text and store it."""
    path = scratch_dir(spark, "csv")
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    derived(spark, sf, RAW_CITY).select(*reversed(CITY_COLUMNS)).write.options(**keep).csv(path)
    tables = LayerTables(spark, scratch_dir(spark, "raw"))
    return tables.write("raw", "cidades_brasil", read_csv(spark, path, CITY_COLUMNS))


@query
def global_sort(spark, sf):
    """GDP rows in (year, code) order over many tasks, with their position."""
    gdp = Models(spark, sf).gdp.select("ano", "cod_ibge", "pib")
    return range_sorted(gdp, "ano", "cod_ibge")


@query
def global_sort_ranges(spark, sf):
    """The order of the stored GDP rows, from their files: rows in the order of files and within them."""
    gdp = Models(spark, sf).gdp.select("ano", "cod_ibge", "pib")
    stored = LayerTables(spark, scratch_dir(spark, "sorted")).write("raw", "pib", range_sorted(gdp, "ano", "cod_ibge"))
    manifest = order_manifest(stored, "ano", "cod_ibge")
    ends = manifest.agg(
        F.sum("rows").alias("rows"), F.min("least.ano").alias("first_year"), F.max("greatest.ano").alias("last_year"), F.sum("unsorted").alias("unsorted")
    )
    return ends.crossJoin(overlapping_files(manifest).agg(F.count("*").alias("overlapping")))


# Order sheets per status: each has its own header names and lead-in rows.
SHEET_HEADERS = {
    "F": (["Instituição", " Cod.IBGE ", "UF", "População", "Indicador_1", "CAPAG_2021", "Ano_Base"], 0),
    "O": (["Ignored", "Município", "Código Município Completo", "Indicador 1", "Classificação_CAPAG", "CAPAG_Oficial"], 2),
    "P": (["Cod.IBGE", "Nome_Município", "População", "Ranking da CCONF", "Ano_Base"], 1),
}
SHEET_YEARS = {"F": 2020, "O": 2019, "P": 2022}


def _sheets(spark, sf):
    orders = table(spark, sf, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    priority = F.nullif("o_orderpriority", F.lit("5-LOW"))
    cells = {
        "F": [priority, F.concat(key, F.lit(".0")), F.lit("SP"), F.when(F.col("o_custkey") % 2 == 0, "nan").otherwise(cust), F.lit("0,5"),
              F.lit("B"), F.lit("2019.0")],
        "O": [F.lit("x"), priority, key, F.lit("n.d."), F.lit("C"), F.lit("A")],
        "P": [key, priority, F.concat(cust, F.lit(".0")), F.lit("None"), F.lit("2022")],
    }
    status = F.col("o_orderstatus")
    years = F.element_at(F.create_map(*[F.lit(x) for p in SHEET_YEARS.items() for x in p]), status).cast("bigint")
    row = F.when(status == "F", F.array(*cells["F"])).when(status == "O", F.array(*cells["O"])).otherwise(F.array(*cells["P"]))
    data = orders.select(status.alias("file"), years.alias("year"), F.lit(None).cast("bigint").alias("row_index"), row.alias("cells"))
    heads = []
    for name, (header, lead_in) in SHEET_HEADERS.items():
        heads += [(name, SHEET_YEARS[name], i, ["report", None]) for i in range(lead_in)]
        heads.append((name, SHEET_YEARS[name], lead_in, header))
    return data.unionAll(spark.createDataFrame(heads, data.schema))


@query
def header_row(spark, sf):
    found = checked_broadcast(sheets.header_rows(_sheets(spark, sf)))
    rows = _sheets(spark, sf).groupBy("file").agg(F.count("*").alias("n"))
    return rows.join(found, "file").select("file", "header_row", (F.col("n") - F.col("header_row") - 1).alias("data_rows"))


@query
def unify_headers(spark, sf):
    return sheets.unify_sheets(_sheets(spark, sf))


@query
def int_clean(spark, sf):
    text = F.when(F.col("o_custkey") % 4 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
    text = text.when(F.col("o_custkey") % 4 == 1, F.concat(F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".75")))
    text = text.when(F.col("o_custkey") % 4 == 2, F.concat(F.col("o_custkey").cast("string"), F.lit(" hab"))).otherwise(None)
    return table(spark, sf, "orders").select("o_orderkey", integer_text(text).alias("clean"))


@query
def null_words(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", "nan").when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", blank_null_words(text).alias("clean"))


@query
def decimal_commas(spark, sf):
    return derived(spark, sf, RAW_RATING).select("cod_ibge", "ano_base", decimal_comma("indicador_1").alias("indicador_1"))


@query
def code_prefix_states(spark, sf):
    code = F.lpad((F.col("c_custkey") % 60).cast("string"), 2, "0")
    return table(spark, sf, "customer").select("c_custkey", state_from_code(F.concat(code, F.lit("00017"))).alias("uf"))


CITY_FEED = """
select s_suppkey as feed, '[{{"id":' || cast(s_suppkey * 10 as string) || ',"nome":"' || s_name
  || '","microrregiao":{{"mesorregiao":{{"UF":{{"sigla":"SP"}}}}}}}},{{"id":' || cast(s_suppkey * 10 + 1 as string)
  || ',"nome":"no region","microrregiao":null}},{{"id":' || cast(s_suppkey * 10 + 2 as string)
  || ',"nome":"third","microrregiao":{{"mesorregiao":{{"UF":{{"sigla":"RJ"}}}}}}}}]' as json
from {supplier}
"""

GDP_FEED = """
select '[{{"D3C":"' || case when event_id % 17 = 0 then 'year' else cast(2015 + event_id % 9 as string) end
  || '","D1C":"' || cast(1100000 + (event_id * 7919) % 4400000 as string) || '","D1N":"' || event_type || '","V":'
  || case when event_id % 5 = 0 then '"..."' when event_id % 5 = 1 then '"-"' when event_id % 5 = 2 then 'null'
     when event_id % 5 = 3 then '"1e3x"' else '"' || cast(user_id as string) || '.25"' end || '}}]' as json
from {events}
"""


@query
def json_flatten_ordinal(spark, sf):
    return json_feeds.cities_from_json(derived(spark, sf, CITY_FEED))


@query
def json_coerce(spark, sf):
    return json_feeds.gdp_from_records(json_feeds.gdp_records(derived(spark, sf, GDP_FEED)))


@query
def load_files(spark, sf):
    """Files -> raw tables: sheets with three layouts of header, a register and a GDP feed with an array per line."""
    root = scratch_dir(spark, "files")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    year, name = F.lit("2021.0"), F.col("o_orderpriority")
    layouts = {
        "F": {"Instituição": name, "Cod.IBGE": key, "População": cust, "Ano_Base": year},
        "O": {"Ano_Base": year, "CAPAG_2023": F.lit("A"), "Código Município Completo": F.concat(key, F.lit(".0")), "Município": name},
        "P": {"Cod.IBGE": key, "Ignored": cust, "População": cust, "Nome_Município": name, "Ano_Base": year},
    }
    for status, cells in layouts.items():  # every file begins with its header
        rows = table(spark, sf, "orders").filter(F.col("o_orderstatus") == status)
        rows.select(*cells.values()).toDF(*cells).write.option("header", True).csv(f"{root}/sheets/{status}")
    derived(spark, sf, CITY_FEED).select("json").write.text(f"{root}/cities")
    derived(spark, sf, GDP_FEED).select("json").write.text(f"{root}/gdp")
    sheet_folders = [f"{root}/sheets/{status}" for status in layouts]
    raw = build.load_raw(LayerTables(spark, f"{root}/lake"), sheet_folders, f"{root}/cities", f"{root}/gdp", register_check=False, lines=True)

    def rows(name, code, label, *detail):
        texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in detail]
        return raw[name].select(F.lit(name).alias("source"), F.col(code).cast("string").alias("code"), F.col(label).alias("name"), F.concat_ws("|", *texts).alias("detail"))

    return _union_all(
        [
            rows("capag_brasil", "cod_ibge", "instituicao", "populacao", "classificacao_capag", "ano_base"),
            rows("cidades_brasil", "Codigo", "Nome", "Id", "UF"),
            rows("pib_municipal", "cod_ibge", "nome_municipio", "ano", "uf", (F.col("pib") * 100).cast("bigint")),
        ]
    )


@query
def register_assertions(spark, sf):
    """The register passes its sanity bounds (scaled down) and comes through whole."""
    cities = Models(spark, sf).cities.withColumnRenamed("uf", "UF")
    checked = json_feeds.assert_register(cities, min_rows=50, states=25)
    return checked.groupBy("UF").agg(F.count("*").alias("n"))
