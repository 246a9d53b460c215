import json

import pytest
from pyspark.sql import functions as F

from fiscalmill.session import scratch_dir
from fiscalmill.sources import json_feeds, manifest, sheets
from fiscalmill.sources.files import LayerTables, append_new_years, new_years_only, range_sorted, read_csv, years_stored


def test_csv_is_read_as_text(spark, tmp_path, values):
    (tmp_path / "x.csv").write_text("id,codigo,nome,uf\n1,0012,São João,SP\n2,,X,\n")
    df = read_csv(spark, str(tmp_path / "x.csv"), ["id", "codigo", "nome", "uf"])
    assert values(df) == [("1", "0012", "São João", "SP"), ("2", None, "X", None)]


def test_layer_tables(spark, values):
    rows = spark.range(200).select(F.lit(2020).cast("bigint").alias("y"), F.col("id").alias("k"))
    rows = rows.unionAll(spark.createDataFrame([(2021, 7)], "y bigint, k bigint"))
    tables = LayerTables(spark, scratch_dir(spark, "t"))
    stored = tables.write("silver", "x", rows, "y", ["k"])
    assert stored.schema["y"].dataType.simpleString() == "bigint" and stored.columns == ["y", "k"]
    assert values(stored) == values(rows) and tables.exists("silver", "x") and not tables.exists("gold", "x")
    again = tables.write("silver", "x", rows.filter("y = 2021"), "y")
    assert values(again) == [(2021, 7)]  # replaced whole
    plan = stored.filter("y = 2021")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    with pytest.raises(ValueError):
        tables.write("platinum", "x", rows)


def test_database_tables(spark, values):
    tables = LayerTables(spark)
    stored = tables.write("gold", "db_table", spark.range(3).withColumn("y", F.lit(1)), "y")
    assert values(spark.table("gold.db_table").select("id")) == [(0,), (1,), (2,)]
    assert stored.columns == ["id", "y"] and tables.exists("gold", "db_table")


def test_new_years(spark, frame, values):
    stored = frame("ano string", ("2019",), (" 2020 ",), ("old",), (None,))
    assert values(years_stored(stored, "ano")) == [(2019,), (2020,)]
    incoming = frame("ano string, v int", ("2020", 1), ("2021", 2))
    assert values(new_years_only(incoming, "ano", stored, "ano")) == [("2021", 2)]
    tables = LayerTables(spark, scratch_dir(spark, "a"))
    append_new_years(tables, "raw", "x", frame("ano string, v int", ("2019", 1)), "ano")
    both = append_new_years(tables, "raw", "x", frame("ano string, v int", ("2019", 9), ("2020", 2)), "ano")
    assert values(both) == [("2019", 1), ("2020", 2)]


def test_range_sorted(spark):
    df = range_sorted(spark.range(1000).select((F.col("id") % 2).alias("y"), F.col("id").alias("k")), "y", "k")
    rows = [tuple(r) for r in df.collect()]
    assert rows == sorted(rows)


FILES = [
    ("CAPAG 2020 - 01/02/2020", "u1", "XLSX", "2021-01-01T00:00:00Z", 1),
    ("CAPAG 2020 - 15/10/2020", "u2", "xlsx", "2019-01-01T00:00:00Z", 2),
    ("CAPAG 2020 - 15/10/2020 again", "u3", "XLSX", "2022-01-01T00:00:00Z", 3),
    ("CAPAG 2021", "u4", "XLSX", "2021-05-01T10:00:00", 4),
    ("CAPAG 2021", "u5", "XLSX", "2021-05-01T09:00:00+00:00", 5),
    ("CAPAG 2021 Metadados", "u6", "XLSX", "2025-05-01T00:00:00Z", 6),
    ("CAPAG 2022", "u7", "CSV", "2025-05-01T00:00:00Z", 7),
    ("CAPAG 2023", "u8", "XLSX", "soon", 8),
    ("no year", "u9", "XLSX", "2025-05-01T00:00:00Z", 9),
]


def test_manifest(frame, values):
    files = frame("name string, url string, format string, created string, ord int", *FILES)
    newest = manifest.latest_per_year(files, "ord")
    assert values(newest.select("year", "link")) == [(2020, "u2"), (2021, "u4"), (2023, "u8")]
    stored = frame("_year bigint", (2019,), (2020,))
    assert values(manifest.new_files_only(newest, stored).select("year")) == [(2023,)]


@pytest.fixture
def sheet_files(tmp_path):
    (tmp_path / "capag_2020.csv").write_text(
        "Relatório\n\nInstituição,Cod.IBGE, UF ,População,Indicador_1,Classificação_CAPAG,CAPAG_Oficial\n"
        'Município A,1100015.0,RO,7037.0,"0,5",C,A\nMunicípio B,1100016,RO,nan,n.d.,B,B\n'
    )
    (tmp_path / "capag_2022.csv").write_text("Nome_Município,Código Município Completo,Ranking,CAPAG_2021,Ano_Base\nX,1,Aicf,D,2022\n")
    (tmp_path / "capag_2019.csv").write_text("Cod.IBGE,Nota 1,Ano_Base\n5,B,2017.0\nMunicípio,A,\n")
    return str(tmp_path)


def test_sheets(spark, sheet_files, values):
    raw = sheets.read_sheets(spark, sheet_files)
    heads = {r["file"][-8:-4]: r["header_row"] for r in sheets.header_rows(raw).collect()}
    assert heads == {"2020": 2, "2022": 0, "2019": 0}
    rows = {r["cod_ibge"]: r.asDict() for r in sheets.unify_sheets(raw).collect()}
    assert set(rows) == {"1100015", "1100016", "1", "5", "Município"}
    first = rows["1100015"]
    assert (first["instituicao"], first["uf"], first["populacao"], first["indicador_1"]) == ("Município A", "RO", "7037", "0,5")
    assert (first["classificacao_capag"], first["ano_base"], first["icf"]) == ("A", "2019", "")
    assert rows["1100016"]["populacao"] == "" and rows["1100016"]["indicador_1"] == "n.d."
    assert (rows["1"]["ano_base"], rows["1"]["classificacao_capag"], rows["1"]["icf"]) == ("2021", "D", "Aicf")
    assert rows["5"]["ano_base"] == "2017" and rows["5"]["nota_1"] == "B"
    assert rows["Município"]["ano_base"] == ""  # a late row with a header word is data


def test_large_sheet_keeps_every_row(spark, tmp_path):
    lines = ["Cod.IBGE,UF"] + [f"{i},SP" for i in range(20000)]
    (tmp_path / "big_2018.csv").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = sheets.unify_sheets(sheets.read_sheets(spark, str(tmp_path)))
        assert rows.count() == 20000 and rows.select("cod_ibge").distinct().count() == 20000
        assert rows.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_city_feed(frame, values):
    def uf(sigla):
        return {"mesorregiao": {"UF": {"sigla": sigla}}}

    feed = [{"id": 11, "nome": "a", "microrregiao": uf("RO")}, {"id": 12, "nome": "b", "microrregiao": None}, {"id": 13, "nome": "c", "microrregiao": uf("SP")}]
    cities = json_feeds.cities_from_json(frame("json string", (json.dumps(feed),)))
    assert values(cities) == [(1, 11, "a", "RO"), (3, 13, "c", "SP")]
    assert json_feeds.assert_register(cities, 2, 2) is cities
    with pytest.raises(ValueError, match="municipalities"):
        json_feeds.assert_register(cities)
    with pytest.raises(ValueError, match="states"):
        json_feeds.assert_register(cities, 1)


def test_gdp_feed(frame, values):
    records = [("2020", "3550308", "SP", "12.5"), ("2020", "1100015", "RO", None), ("2021", "9900000", "?", "abc"), ("x", "1", "n", "1"), ("2020", None, "n", "1")]
    records += [("2020", "1100015", "RO", v) for v in ("...", "-", "X")]
    feed = json.dumps([dict(zip(("D3C", "D1C", "D1N", "V"), r)) for r in records])
    rows = json_feeds.gdp_from_records(json_feeds.gdp_records(frame("json string", (feed,))))
    assert values(rows) == [(2020, 3550308, "SP", "SP", 12.5), (2021, 9900000, "?", None, None)]


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text('codigo,id,nome,uf\n11,1,"Vila\nNova ""A""",RO\n')
    df = read_csv(spark, str(tmp_path / "x.csv"), ["id", "codigo", "nome", "uf"], multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("1", "11", 'Vila\nNova "A"', "RO")]
    with pytest.raises(ValueError, match="no column pib"):
        read_csv(spark, str(tmp_path / "x.csv"), ["id", "pib"])


def test_unreadable_years_are_set_aside_and_appends_repeat(spark, tmp_path, frame, values):
    tables = LayerTables(spark, str(tmp_path))
    rows = frame("ano string, v int", ("2019", 1), ("n/a", 2), (None, 3))
    for _ in range(3):
        stored = append_new_years(tables, "raw", "y", rows, "ano")
    assert values(stored.select("v")) == [(1,)]
    assert values(tables.read("raw", "y_rejected").select("v")) == [(2,), (3,)]


def test_headers_that_carry_the_target_names(spark):
    head = ("f", 2020, 0, ["COD_IBGE", "Instituição", "POPULACAO", "NOTA_1", "ANO_BASE"])
    rows = [head, ("f", 2020, None, ["1100015", "Alta Floresta", "22728", "A", "2018"])]
    df = spark.createDataFrame(rows, "file string, year long, row_index long, cells array<string>")
    row = sheets.unify_sheets(df).first()
    assert (row["cod_ibge"], row["populacao"], row["nota_1"], row["ano_base"]) == ("1100015", "22728", "A", "2018")
