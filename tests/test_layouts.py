"""Layouts and lost jobs: bucketed layers, years that are replaced as a whole, files by their own header, hot keys."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.operators.periods import with_growth, with_previous_period
from fiscalmill.plans import build, gold
from fiscalmill.session import settings
from fiscalmill.sources import files
from fiscalmill.sources.files import LayerTables, append_new_years, committed, read_csv

# ---- CSV folders -------------------------------------------------------------


def test_each_file_goes_by_its_own_header(spark, tmp_path, values):
    (tmp_path / "a.csv").write_text("id,codigo,nome,uf\n1,11,A,RO\n2,12,B,SP\n")
    (tmp_path / "b c.csv").write_text("codigo,id,extra,nome,uf\n13,3,x,C,MG\n")
    (tmp_path / "d.csv").write_text(" id , codigo,nome,uf\n4,14,,\n")
    (tmp_path / "empty.csv").write_text("")
    df = read_csv(spark, str(tmp_path), ["id", "codigo", "nome", "uf"])
    assert values(df) == [("1", "11", "A", "RO"), ("2", "12", "B", "SP"), ("3", "13", "C", "MG"), ("4", "14", None, None)]
    both = read_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b c.csv")], ["codigo"])
    assert values(both) == [("11",), ("12",), ("13",)]
    with pytest.raises(ValueError, match="no column extra"):
        read_csv(spark, str(tmp_path), ["extra"])
    with pytest.raises(ValueError, match="no header"):
        read_csv(spark, str(tmp_path / "empty.csv"), ["id"])


# ---- appended years ----------------------------------------------------------


@pytest.fixture(params=["folder", "database"])
def layers(request, spark, tmp_path):
    yield LayerTables(spark, str(tmp_path)) if request.param == "folder" else LayerTables(spark)
    if request.param == "database":
        spark.sql("drop database if exists raw cascade")


def rows_by_year(df):
    return sorted((str(r["ano"]), r["n"]) for r in df.groupBy("ano").agg(F.count("*").alias("n")).collect())


def test_a_run_lost_before_its_mark_is_done_again(layers, frame, monkeypatch):
    rows = frame("v int, ano string", (1, "2019"), (2, "2019"), (3, "2020"), (4, "x"))
    append_new_years(layers, "raw", "y", rows.where("ano = '2019'"), "ano")
    real = LayerTables.write

    def fails(self, layer, name, df, *a, **k):
        if name == "y_years" and k.get("mode") == "append":
            raise RuntimeError("driver lost")
        return real(self, layer, name, df, *a, **k)

    monkeypatch.setattr(LayerTables, "write", fails)
    with pytest.raises(RuntimeError):
        append_new_years(layers, "raw", "y", rows, "ano")
    assert rows_by_year(layers.read("raw", "y")) == [("2019", 2), ("2020", 1)]  # written, not marked
    assert rows_by_year(committed(layers, "raw", "y", "ano")) == [("2019", 2)]
    monkeypatch.setattr(LayerTables, "write", real)
    more = rows.unionAll(frame("v int, ano string", (5, "2020"), (6, "2021")))
    for _ in range(2):
        assert rows_by_year(append_new_years(layers, "raw", "y", more, "ano")) == [("2019", 2), ("2020", 2), ("2021", 1)]
    assert rows_by_year(layers.read("raw", "y")) == [("2019", 2), ("2020", 2), ("2021", 1)]


def test_a_half_written_year_is_replaced(layers, frame):
    rows = frame("v int, ano string", *[(i, "2020") for i in range(10)])
    append_new_years(layers, "raw", "h", rows.limit(0), "ano")
    layers.replace_years("raw", "h", rows.where("v < 4"), "ano")  # what a lost first run may leave
    assert rows_by_year(append_new_years(layers, "raw", "h", rows, "ano")) == [("2020", 10)]
    assert layers.read("raw", "h_years").collect()[0]["rows"] == 10


def test_years_left_behind_and_not_sent_again_stay_without_a_mark(layers, frame):
    rows = frame("v int, ano string", (1, "2020"), (2, "2021"))
    append_new_years(layers, "raw", "l", rows.limit(0), "ano")
    layers.replace_years("raw", "l", rows.where("v = 1"), "ano")
    assert rows_by_year(append_new_years(layers, "raw", "l", rows.where("v = 2"), "ano")) == [("2021", 1)]
    assert rows_by_year(append_new_years(layers, "raw", "l", rows, "ano")) == [("2020", 1), ("2021", 1)]


def test_a_table_from_before_the_marks_keeps_its_years(layers, frame):
    layers.write("raw", "old", frame("v int, ano string", (1, "2018"), (2, "2018")), partition_by="ano")
    rows = frame("v int, ano string", (9, "2018"), (3, "2019"))
    assert rows_by_year(append_new_years(layers, "raw", "old", rows, "ano")) == [("2018", 2), ("2019", 1)]


# ---- buckets -----------------------------------------------------------------


def test_joins_on_the_municipality_read_buckets_without_a_shuffle(spark, frame, tmp_path):
    ratings = frame(
        "instituicao string, cod_ibge string, uf string, populacao string, indicador_1 string, nota_1 string, indicador_2 string, nota_2 string, "
        "indicador_3 string, nota_3 string, classificacao_capag string, icf string, ano_base string",
        *[(f"m{i}", str(1100000 + i), "RO", "100", "0,5", "A", "1", "B", "2", "C", "ABCD"[i % 4], "x", str(2018 + i % 3)) for i in range(60)],
    )
    register = frame("id long, codigo string, nome string, uf string", *[(i, str(1100000 + i), f"m{i}", "RO") for i in range(60)])
    gdp = frame(
        "ano string, cod_ibge string, nome_municipio string, uf string, pib string",
        *[(str(y), str(1100000 + i), f"m{i}", "RO", str(100 + i + y)) for i in range(60) for y in (2018, 2019, 2020)],
    )
    raw = {"capag_brasil": ratings, "cidades_brasil": register, "pib_municipal": gdp}
    plain = build.build_all(LayerTables(spark, str(tmp_path)), raw)
    try:
        with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            tables = LayerTables(spark, buckets=4)
            built = build.build_all(tables, raw)
            for name in ("gld_fato_risco_fiscal", "gld_fato_pib_municipal", "gld_report_tendencia_anual"):
                assert sorted(map(str, built[name].collect())) == sorted(map(str, plain[name].select(*built[name].columns).collect()))
            wide = gold.indicators_wide(built["slv_capag_municipios"], F.broadcast(built["gld_dim_uf"]), built["gld_dim_classificacao_capag"])
            risk = gold.fact_risk(wide, built["gld_fato_pib_municipal"], built["gld_dim_instituicoes"])
            grown = gold.fact_gdp(built["slv_pib_municipal"], F.broadcast(built["gld_dim_uf"]))
            with settings(spark, **{"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
                for df in (risk, grown):
                    plan = df._jdf.queryExecution().executedPlan().toString()
                    assert "Exchange hashpartitioning" not in plan and "Bucketed: true" in plan
            one = built["gld_fato_risco_fiscal"].where("cod_ibge = 1100007")
            with settings(spark, **{"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}):  # a scan that shows its buckets
                shown = built["gld_fato_risco_fiscal"].where("cod_ibge = 1100007")
                assert "SelectedBucketsCount: 1 out of 4" in shown._jdf.queryExecution().executedPlan().toString()
            assert one.count() == 1
    finally:
        for layer in files.LAYERS:
            spark.sql(f"drop database if exists {layer} cascade")
    with pytest.raises(ValueError, match="catalog"):
        LayerTables(spark, str(tmp_path), buckets=4)


# ---- hot keys ----------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """Half of the rows in one key, which has many periods; some repeat, some have no key or period."""
    return spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 97 != 0, F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 89 != 0, (F.col("id") * 7 % 1009).cast("int")).alias("p"), F.col("id").alias("v"),
    )


@pytest.mark.parametrize("step", [1, 3])
def test_previous_period_of_a_hot_key(spark, skewed, values, step):
    earlier = skewed.select(F.col("k").alias("k2"), (F.col("p") + step).alias("p2"), F.col("v").alias("before"), F.col("p").alias("p_before"))
    want = skewed.join(earlier, (F.col("k") == F.col("k2")) & (F.col("p") == F.col("p2")), "left").select("k", "p", "v", "before", "p_before")
    with settings(spark, **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false"}):
        got = with_previous_period(skewed, "k", "p", {"before": "v", "p_before": "p"}, step)
        assert got.dtypes == want.dtypes
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
    assert values(got) == values(want)
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]  # the hot key does not fill one task


@pytest.mark.parametrize("gap_aware", [False, True])
def test_growth_of_a_hot_key(skewed, values, gap_aware):
    rows = skewed.where("k is not null and p is not null").groupBy("k", "p").agg(F.max("v").cast("double").alias("v"))
    plain = with_growth(rows, "k", "p", "v", "before", "rate", gap_aware)
    assert values(with_growth(rows, "k", "p", "v", "before", "rate", gap_aware, split_keys=True)) == values(plain)
    lagged = F.lag("v").over(Window.partitionBy("k").orderBy("p"))
    if not gap_aware:
        assert values(plain.select("k", "p", "before")) == values(rows.select("k", "p", lagged.alias("b")))
