import pytest
from pyspark.sql import functions as F

from fiscalmill.plans import build, cards, gold, insights, legacy, silver
from fiscalmill.quality.runner import QualityError
from fiscalmill.session import scratch_dir
from fiscalmill.sources.files import CITY_COLUMNS, GDP_COLUMNS, RATING_COLUMNS, LayerTables

GROWTHS = [12.0, 6.0, 3.0, 0.0, -1.0, None]
SCORES = {
    "A": ([100, 94, 88, 82, 76, 70], ["BAIXO"] * 5 + ["MODERADO"], 100, "BAIXO"),
    "B": ([80, 74, 68, 62, 56, 50], ["BAIXO"] * 2 + ["MODERADO"] * 3 + ["ELEVADO"], 71, "MODERADO"),
    "C": ([55, 49, 43, 37, 31, 25], ["MODERADO"] + ["ELEVADO"] * 3 + ["CRITICO"] * 2, 36, "ELEVADO"),
    "D": ([30, 24, 18, 12, 6, 0], ["CRITICO"] * 6, 0, "CRITICO"),
    None: ([100, 80, 60, 40, 20, 0], ["BAIXO", "BAIXO", "MODERADO", "ELEVADO", "CRITICO", "CRITICO"], None, "INDETERMINADO"),
}


def wide_frame(frame, rows):
    schema = (
        "cod_ibge bigint, ano_base bigint, populacao bigint, indicador_1 double, nota_1 string, indicador_2 double, nota_2 string, "
        "indicador_3 double, nota_3 string, icf string, uf_id bigint, classificacao_capag_id bigint, uf string, "
        "classificacao_capag string, descricao_classificacao string"
    )
    return frame(schema, *[(c, y, p, None, None, None, None, None, None, None, 1, 1, "SP", r, None) for c, y, p, r in rows])


def gdp_frame(frame, rows):
    return frame("cod_ibge bigint, ano bigint, pib double, taxa_crescimento_pib double", *rows)


def names_frame(frame, *codes):
    return frame("cod_ibge bigint, nome_municipio string", *[(c, f"m{c}") for c in codes])


def test_score_table(frame):
    ratings, gdp, want = [], [], {}
    for i, (rating, (scores, bands, alone, alone_band)) in enumerate(SCORES.items()):
        for j, growth in enumerate(GROWTHS):
            code = 10 * i + j
            ratings.append((code, 2020, 1000, rating))
            gdp.append((code, 2020, 5.0, growth))
            want[code] = (scores[j], bands[j])
        ratings.append((10 * i + 9, 2020, 1000, rating))
        want[10 * i + 9] = (alone, alone_band)
    risk = gold.fact_risk(wide_frame(frame, ratings), gdp_frame(frame, gdp), names_frame(frame, 1))
    have = {r["cod_ibge"]: (r["score_risco_fiscal"], r["classificacao_risco"]) for r in risk.collect()}
    assert have == want
    only_gdp = risk.filter("classificacao_capag is null and tem_pib").select("score_capag").distinct().collect()
    assert [r[0] for r in only_gdp] == [None]
    assert len(risk.columns) == 25


def test_population_bands(frame):
    people = [19999, 20000, 99999, 100000, 499999, 500000, None]
    df = frame("p bigint", *[(p,) for p in people]).select(gold.population_band(F.col("p")))
    small, medium, large, metropolis = "Pequeno (< 20k)", "Medio (20k-100k)", "Grande (100k-500k)", "Metropole (> 500k)"
    assert [r[0] for r in df.collect()] == [small, medium, medium, large, large, metropolis, metropolis]


def rating_row(**values):
    base = dict.fromkeys(RATING_COLUMNS) | {"instituicao": " X ", "cod_ibge": "1", "uf": " sp", "ano_base": "2020"}
    return tuple({**base, **values}[c] for c in RATING_COLUMNS)


def raw_rating(frame, *rows):
    return frame(", ".join(f"{c} string" for c in RATING_COLUMNS), *[rating_row(**r) for r in rows])


def test_silver_rating(frame):
    raw = raw_rating(
        frame,
        {"classificacao_capag": "A", "populacao": "10", "indicador_1": "1,25", "nota_1": "n.d.", "nota_2": " n.d.", "icf": " a "},
        {"classificacao_capag": " d "},
        {"classificacao_capag": "n.d.", "cod_ibge": "2"},
        {"classificacao_capag": "D", "cod_ibge": "2"},
        {"classificacao_capag": None, "cod_ibge": "3", "populacao": ""},
        {"cod_ibge": None},
        {"ano_base": None},
    )
    rows = {r["cod_ibge"]: r for r in silver.rating(raw).collect()}
    assert {k: r["classificacao_capag"] for k, r in rows.items()} == {1: "D", 2: "N.D.", 3: None}
    one = silver.rating(raw.limit(1)).first()
    assert (one["instituicao"], one["uf"], one["populacao"], one["indicador_1"]) == ("X", "SP", 10, 1.25)
    assert (one["nota_1"], one["nota_2"], one["icf"], rows[3]["populacao"]) == (None, "N.D.", "A", None)


def test_bad_key_fails(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        silver.rating(raw_rating(frame, {"cod_ibge": "12x"})).collect()


def test_silver_gdp_and_cities(frame, values):
    gdp = frame(
        ", ".join(f"{c} string" for c in GDP_COLUMNS), ("2020", "1", " a ", "sp ", "5"), ("2020", "1", "a", "sp", "40"),
        ("2020", "2", "b", "sp", "-"), (None, "3", "c", "sp", "1"),
    )
    assert values(silver.gdp(gdp).select("cod_ibge", "pib")) == [(1, 40.0), (2, None)]
    cities = frame(", ".join(f"{c} string" for c in CITY_COLUMNS), ("10", "1", "late", "sp"), ("9", "1", " early ", " sp"), ("1", None, "x", "sp"))
    assert values(silver.cities(cities)) == [(1, "early", "SP")]


def test_dimension_and_fan_out(frame, values):
    register = frame("cod_ibge bigint, nome_municipio string, uf string", (1, "a", "SP"), (2, "b", "RJ"))
    ratings = frame("cod_ibge bigint, uf string, classificacao_capag string", (1, "SP", "A"), (1, "MG", "N.D."), (3, "BA", None))
    dim = gold.dim_municipality(register, ratings)
    assert values(dim) == [(1, "a", "SP"), (1, "a", "SP"), (2, "b", "RJ"), (3, None, "BA")]
    assert values(silver.dim_state(ratings, register)) == [(1, "BA"), (2, "MG"), (3, "RJ"), (4, "SP")]
    assert values(silver.dim_rating(ratings)) == [(1, "A", "Boa capacidade de pagamento")]
    # The fanned-out code doubles its fact rows, and the trend pairs them all.
    wide = wide_frame(frame, [(1, 2019, 10, "A"), (1, 2020, 10, "B")])
    risk = gold.fact_risk(wide, gdp_frame(frame, []), dim)
    assert risk.count() == 4 and gold.report_trend(risk).count() == 6


def test_unknown_rating_and_state_have_no_key(frame, values):
    ratings = silver.rating(raw_rating(frame, {"classificacao_capag": "n.d."}))
    states = frame("uf_id bigint, uf string", (1, "RJ"))
    grades = frame("classificacao_capag_id bigint, classificacao_capag string, descricao_classificacao string", (1, "A", "x"))
    wide = gold.indicators_wide(ratings, states, grades)
    assert values(wide.select("uf_id", "uf", "classificacao_capag_id", "classificacao_capag")) == [(None, None, None, None)]
    assert gold.fact_indicators(wide).columns[:3] == ["indicador_id", "cod_ibge", "ano_base"]
    assert len(gold.fact_indicators(wide).columns) == 13


def test_trend(frame):
    wide = wide_frame(frame, [(1, 2018, 1, "A"), (1, 2019, 1, "B"), (1, 2021, 1, "A"), (1, 2022, 1, "A"), (1, 2023, 1, None), (1, 2024, 1, "C")])
    trend = gold.report_trend(gold.fact_risk(wide, gdp_frame(frame, []), names_frame(frame, 1)))
    have = {r["ano_base"]: (r["tendencia"], r["variacao_score"]) for r in trend.collect()}
    assert have == {
        2018: ("SEM_HISTORICO", 100), 2019: ("PIORA", -29), 2021: ("SEM_HISTORICO", 100), 2022: ("ESTAVEL", 0),
        2023: ("ESTAVEL", None), 2024: ("SEM_HISTORICO", 36),
    }
    assert len(trend.columns) == 14


@pytest.fixture(scope="module")
def raw(spark):
    ratings, gdp, cities = [], [], []
    for i in range(1, 41):
        cities.append((str(i), str(i), f"City {i}", "sp" if i % 2 else "rj"))
        for year in (2019, 2020):
            ratings.append(rating_row(cod_ibge=str(i), ano_base=str(year), uf="sp" if i % 2 else "rj", populacao=str(i * 15000),
                                      indicador_1="0,5", classificacao_capag="ABCD"[(i + year) % 4]))
            if i % 5:
                gdp.append((str(year), str(i), f"City {i}", "sp" if i % 2 else "rj", str(100 + i * (year - 2018))))

    def text(columns):
        return ", ".join(f"{c} string" for c in columns)

    return {
        "capag_brasil": spark.createDataFrame(ratings, text(RATING_COLUMNS)),
        "pib_municipal": spark.createDataFrame(gdp, text(GDP_COLUMNS)),
        "cidades_brasil": spark.createDataFrame(cities, text(CITY_COLUMNS)),
    }


@pytest.fixture(scope="module")
def layers(spark, raw):
    return build.build_all(LayerTables(spark, scratch_dir(spark, "layers")), raw)


def test_build(layers):
    assert layers["gld_fato_risco_fiscal"].count() == 80
    assert len(layers["gld_report_agregacao_estadual"].columns) == 15
    assert len(layers["gld_report_risco_fiscal_municipal"].columns) == 19
    assert len(layers["gld_report_capag_vs_pib"].columns) == 15
    table = layers[insights.TABLE]
    assert [f.name for f in table.schema] == [f.name for f in insights.SCHEMA] and table.count() == 6
    assert [r["tipo"] for r in table.orderBy("prioridade").collect()] == [
        "resumo_geral", "alerta_risco", "destaque_positivo", "analise_regional", "tendencia", "correlacao",
    ]


def test_failed_gate_stops(spark, raw):
    tables = LayerTables(spark, scratch_dir(spark, "gate"))
    broken = {**raw, "cidades_brasil": raw["cidades_brasil"].withColumn("nome", F.lit(None).cast("string"))}
    with pytest.raises(QualityError, match="silver"):
        build.build_all(tables, broken)
    assert tables.exists("silver", "slv_cidades") and not tables.exists("gold", "gld_dim_uf")
    empty = {**raw, "pib_municipal": raw["pib_municipal"].limit(0)}
    with pytest.raises(QualityError, match="bronze"):
        build.build_all(LayerTables(spark, scratch_dir(spark, "gate")), empty)


def test_insight_years_and_gaps(layers, values):
    risk = layers["gld_fato_risco_fiscal"]
    assert insights.summary(risk, 2019).first()["ano_base"] == 2019
    assert insights.summary(risk).first()["titulo"] == "Panorama Fiscal Municipal - Ano Base 2020"
    assert insights.summary(risk, 1900).count() == 0
    assert insights.worst_municipalities(risk, 1900).count() == 0
    assert insights.summary(risk.withColumn("score_risco_fiscal", F.lit(None).cast("bigint"))).count() == 0
    state = layers["gld_report_agregacao_estadual"].withColumn("pib_medio", F.lit(None).cast("double"))
    assert insights.critical_states(state).count() == 0
    text = insights.best_municipalities(risk, top_n=3).first()
    assert text["titulo"].startswith("Top 3 ") and text["narrativa"].count("(score: ") == 3


def test_save_insights_skips_failures(spark, layers):
    tables = LayerTables(spark, scratch_dir(spark, "insights"))
    broken = {**layers, "gld_report_tendencia_anual": layers["gld_dim_uf"]}
    assert insights.save_insights(tables, broken).count() == 5
    nothing = {n: df.limit(0) for n, df in layers.items()}
    assert insights.save_insights(LayerTables(spark, scratch_dir(spark, "insights")), nothing) is None


def test_decimal_text(frame):
    df = frame("x double", (12.0,), (0.5,), (0.0001,), (100.0,), (None,), (53.25,))
    assert [r[0] for r in df.select(insights._decimal_text(F.col("x"), 4)).collect()] == ["12.0", "0.5", "0.0001", "100.0", "None", "53.25"]
    half = frame("a int, b int", (49, 400), (51, 400)).select(insights._share(F.col("a"), F.col("b")))
    assert [r[0] for r in half.collect()] == [12.2, 12.8]


def test_cards(layers, values):
    municipal, state = layers["gld_report_risco_fiscal_municipal"], layers["gld_report_agregacao_estadual"]
    assert sum(r["total_municipios"] for r in cards.risk_distribution(municipal, 2020).collect()) == 40
    assert cards.lowest_scores(municipal).count() == 10 and cards.highest_scores(municipal, 2019, 3).count() == 3
    assert cards.municipality(municipal, "City 7").count() == 2 and cards.municipality(municipal, "City 7", 2020).count() == 1
    assert {r["uf"] for r in cards.score_by_state(layers["gld_report_tendencia_anual"], 2020).collect()} == {"Sao Paulo", "Rio de Janeiro"}
    assert [r["ano_base"] for r in cards.score_by_year(layers["gld_report_tendencia_anual"]).collect()] == [2019, 2020]
    for row in cards.high_risk_by_state(state).collect():
        assert row["pct_risco_alto_total"] == row["municipios_risco_elevado"] + row["municipios_risco_critico"]
    assert cards.narratives(layers[insights.TABLE]).columns == ["titulo", "narrativa", "metrica_chave"]


def test_stored_year_filter_prunes(layers):
    plan = cards.in_year(layers["gld_fato_risco_fiscal"], 2020)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano_base" in plan


def test_legacy(raw):
    ratings = raw["capag_brasil"]
    fact = legacy.fact_indicators(
        ratings, legacy.dim_institution(raw["cidades_brasil"]), legacy.dim_state(ratings), legacy.dim_rating(ratings)
    )
    rows = fact.collect()
    assert sorted(r["id"] for r in rows) == list(range(1, 81))
    assert all(r["uf_id"] and r["classificacao_capag_id"] and r["cod_ibge"] for r in rows)


def test_files_to_gold(spark, tmp_path):
    """Sheets and JSON files through all layers, then plain SQL on the databases."""
    (tmp_path / "r_2021.csv").write_text(
        "Relatório\nInstituição,Cod.IBGE,UF,População,Indicador 1,CAPAG\nX,3550308.0,SP,500.0,\"0,5\",A\nY,1100015,RO,nan,n.d.,C\n\n"
    )
    (tmp_path / "cities.json").write_text(
        '[{"id": 3550308, "nome": "X", "microrregiao": {"mesorregiao": {"UF": {"sigla": "SP"}}}},\n {"id": 9, "nome": "?", "microrregiao": null},'
        ' {"id": 1100015, "nome": "Y", "microrregiao": {"mesorregiao": {"UF": {"sigla": "RO"}}}}]'
    )
    (tmp_path / "gdp.json").write_text(
        '[{"D3C": "2019", "D1C": "3550308", "D1N": "X", "V": "100"},\n {"D3C": "2020", "D1C": "3550308", "D1N": "X", "V": "112.5"},'
        ' {"D3C": "2020", "D1C": "1100015", "D1N": "Y", "V": "..."}]'
    )
    tables = LayerTables(spark)
    paths = [str(tmp_path / n) for n in ("r_2021.csv", "cities.json", "gdp.json")]
    raw = build.load_raw(tables, *paths, register_check=False)
    assert [r["Id"] for r in raw["cidades_brasil"].orderBy("Id").collect()] == [1, 3]
    with pytest.raises(ValueError):
        build.load_raw(tables, *paths)
    risk = {r["cod_ibge"]: r for r in build.build_all(tables, raw)["gld_fato_risco_fiscal"].collect()}
    assert set(risk) == {3550308, 1100015}  # the blank sheet row has no code
    x, y = risk[3550308], risk[1100015]
    assert (x["ano_base"], x["score_risco_fiscal"], x["nome_municipio"], x["populacao"]) == (2020, 100, "X", 500)
    assert (y["score_risco_fiscal"], y["tem_pib"], y["indicador_1"], y["populacao"]) == (36, False, None, None)
    assert spark.table("bronze.brz_capag_brasil").columns == RATING_COLUMNS and spark.table("bronze.brz_cidades_brasil").count() == 2
    card = "SELECT classificacao_risco, count(*) AS n FROM gold.gld_report_risco_fiscal_municipal WHERE (:ano IS NULL OR ano_base = :ano) GROUP BY 1"
    for ano, rows in ((2020, 2), (None, 2), (1999, 0)):
        assert sum(r["n"] for r in spark.sql(card, args={"ano": ano}).collect()) == rows
    assert spark.table("gold.insights_risco_fiscal").count() > 0


def test_a_build_bounds_what_a_task_takes_and_restores_the_session(spark, monkeypatch):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before, seen = [spark.conf.get(n, None) for n in names], []

    def step(*_):
        seen.append([spark.conf.get(n, None) for n in names])
        return {}

    for layer in ("silver_layer", "gold_layer"):
        monkeypatch.setattr(build, layer, step)
    monkeypatch.setattr(build, "bronze_layer", step)
    monkeypatch.setattr(build.insights, "save_insights", lambda *_: step() or None)
    build.build_all(LayerTables(spark, "/nowhere"), {}, gates=False)
    assert seen == [[build.PIECE, build.SPLIT, str(build.PARTITIONS)]] * 4
    assert [spark.conf.get(n, None) for n in names] == before
