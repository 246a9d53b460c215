"""Frequent values, results in chunks, order that files prove, years from the names of partitions."""

import pytest
from pyspark.sql import functions as F

from fiscalmill.operators import pivot, shape
from fiscalmill.plans import build
from fiscalmill.session import settings
from fiscalmill.sources import files
from fiscalmill.sources.files import LayerTables

# ---- frequent values ---------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows in one value, some frequent ones (NULL among them), and many that occur once."""
    v = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).when(F.col("id") % 10 == 2, F.col("id") % 4).otherwise(F.col("id"))
    return spark.range(60_000).select(v.alias("v"))


def by_hand(df, k):
    rows = df.groupBy("v").count().orderBy(F.desc("count"), F.col("v").asc_nulls_first()).limit(k)
    return [tuple(r) for r in rows.collect()]


def test_frequent_values_are_exact_where_the_summary_can_tell_them(skewed):
    for k in (1, 3, 4):
        found = pivot.frequent_values(skewed, "v", k, tracked=1000)
        assert found is not None and [tuple(r) for r in found.collect()] == by_hand(skewed, k)
    for kind in ("string", "double", "decimal(20,2)", "timestamp"):
        typed = skewed.select(F.col("v").cast(kind).alias("v"))
        assert [tuple(r) for r in pivot.frequent_values(typed, "v", 3, tracked=1000).collect()] == by_hand(typed, 3)


def test_what_the_summary_cannot_tell_is_counted_in_full(skewed, spark):
    assert pivot.frequent_values(skewed, "v", 50, tracked=1000) is None
    even = spark.range(20_000).select((F.col("id") % 9000).alias("v"))
    assert pivot.frequent_values(even, "v", 5, tracked=100) is None
    for df, k in ((skewed, 50), (even, 5), (skewed.limit(0), 3)):
        assert [tuple(r) for r in pivot.column_values(df, "v", max_records=k).collect()] == by_hand(df, k)
    assert pivot.column_values(skewed.select(F.col("v").cast("string").cast("binary").alias("v")), "v", max_records=2).count() == 2


def test_few_values_are_all_found(frame):
    df = frame("v string", ("a",), ("a",), (None,), ("b",))
    assert [tuple(r) for r in pivot.column_values(df, "v", max_records=10).collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert pivot.get_column_values(df, "v", max_records=1) == ["a"]
    with pytest.raises(ValueError, match="more than 2 values"):
        pivot.get_column_values(df, "v", most=2)


# ---- results in chunks -------------------------------------------------------


def test_a_million_rows_come_back_in_order(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("k"), (F.col("id") % 5).cast("string").alias("s"))
    chunks = shape.results_in_chunks(df, ["k"], 50_000)
    rows = chunks.orderBy("chunk").select("chunk", F.size("k").alias("n"), F.element_at("k", 1).alias("a"), F.element_at("k", -1).alias("b")).collect()
    assert [r["chunk"] for r in rows] == list(range(1, 21)) and all(r["n"] == 50_000 for r in rows)
    assert all(p["b"] < q["a"] for p, q in zip(rows, rows[1:]))
    assert chunks.where("k <> array_sort(k)").count() == 0


def test_odd_chunks(frame, values):
    df = frame("k int, v string", (2, "b"), (None, "n"), (1, None), (2, "b"))
    assert values(shape.results_in_chunks(df, ["k", "v"], 3)) == [(1, [None, 1, 2], ["n", None, "b"]), (2, [2], ["b"])]
    assert shape.results_in_chunks(df.limit(0), ["k"]).count() == 0


# ---- order that files prove --------------------------------------------------


def test_order_is_read_from_the_files(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 37 % 501).alias("k"), F.col("id").alias("v"))
    tables = LayerTables(spark, str(tmp_path))
    with settings(spark, **{"spark.sql.adaptive.enabled": "false"}):  # small ranges stay apart
        stored = tables.write("raw", "sorted", files.range_sorted(df, "k", "v"))
    manifest = files.order_manifest(stored, "k", "v")
    total = manifest.agg(F.sum("rows").alias("n"), F.sum("unsorted").alias("u"), F.count("*").alias("f")).first()
    assert (total["n"], total["u"]) == (5000, 0) and total["f"] > 1
    assert files.overlapping_files(manifest).count() == 0
    mixed = files.order_manifest(tables.write("raw", "mixed", df.repartition(3)), "k", "v")
    assert files.overlapping_files(mixed).count() == 2 and mixed.agg(F.sum("unsorted")).first()[0] > 0


# ---- newest year -------------------------------------------------------------


@pytest.mark.parametrize("mode", ["folder", "database"])
def test_newest_year_comes_from_the_partitions(spark, tmp_path, frame, mode):
    tables = LayerTables(spark, str(tmp_path / "a b")) if mode == "folder" else LayerTables(spark)
    try:
        stored = tables.write("raw", "y", frame("v int, ano bigint", (1, 2019), (2, 2021), (3, None), (4, 2020)), partition_by="ano")
        before = spark._jsc.sc().statusTracker().getJobIdsForGroup(None)
        assert tables.partition_values("raw", "y", "ano") == ["2019", "2020", "2021"]
        assert tables.newest("raw", "y", "ano") == 2021
        assert len(spark._jsc.sc().statusTracker().getJobIdsForGroup(None)) == len(before)  # no job ran
        plan = stored.where("ano = 2021")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(ano" in plan
    finally:
        if mode == "database":
            spark.sql("drop database if exists raw cascade")


def test_cards_read_one_year(spark, sf_dir, tmp_path):
    from fiscalmill.demo.derive import raw_tables
    from fiscalmill.plans import cards

    built = build.build_all(LayerTables(spark, str(tmp_path)), raw_tables(spark, sf_dir))
    plan = cards.average_score(built["gld_report_risco_fiscal_municipal"], 1997)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_base" in plan and "(ano_base" in plan
    newest = built["gld_fato_risco_fiscal"].agg(F.max("ano_base")).first()[0]
    assert {r["ano_base"] for r in built["insights_risco_fiscal"].where("tipo <> 'x' and prioridade <= 3").collect()} == {newest}
