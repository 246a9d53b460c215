"""The checks configured for each layer."""

from __future__ import annotations

from fiscalmill.functions.text import STATE_BY_PREFIX
from fiscalmill.quality.runner import accepted_range, accepted_values, has_rows, not_null, relationships, unique


def _key(table: str, column: str) -> list:
    return [unique(table, column), not_null(table, column)]


BRONZE = [
    not_null("brz_capag_brasil", "cod_ibge"),
    not_null("brz_capag_brasil", "instituicao"),
    not_null("brz_capag_brasil", "ano_base"),
    has_rows("brz_capag_brasil"),
    not_null("brz_cidades_brasil", "codigo"),
    not_null("brz_pib_municipal", "cod_ibge"),
    not_null("brz_pib_municipal", "ano"),
    has_rows("brz_pib_municipal"),
]

SILVER = [
    *_key("slv_capag_municipios", "capag_sk"),
    not_null("slv_capag_municipios", "cod_ibge"),
    not_null("slv_capag_municipios", "ano_base"),
    not_null("slv_capag_municipios", "uf"),
    accepted_values("slv_capag_municipios", "uf", sorted(STATE_BY_PREFIX.values()), severity="warn"),
    has_rows("slv_capag_municipios"),
    *_key("slv_cidades", "cod_ibge"),
    not_null("slv_cidades", "nome_municipio"),
    not_null("slv_cidades", "uf"),
    *_key("slv_pib_municipal", "pib_sk"),
    not_null("slv_pib_municipal", "cod_ibge"),
    not_null("slv_pib_municipal", "ano"),
    accepted_range("slv_pib_municipal", "pib", min_value=0, severity="warn"),
    has_rows("slv_pib_municipal"),
    *_key("slv_dim_uf", "uf_id"),
    *_key("slv_dim_uf", "uf"),
    *_key("slv_dim_classificacao_capag", "classificacao_capag_id"),
    *_key("slv_dim_classificacao_capag", "classificacao_capag"),
]

GOLD = [
    *_key("gld_dim_instituicoes", "cod_ibge"),
    *_key("gld_dim_uf", "uf_id"),
    *_key("gld_dim_uf", "uf"),
    *_key("gld_dim_classificacao_capag", "classificacao_capag_id"),
    accepted_values("gld_dim_classificacao_capag", "classificacao_capag", ["A", "B", "C", "D"]),
    *_key("gld_fato_indicadores_capag", "indicador_id"),
    not_null("gld_fato_indicadores_capag", "cod_ibge"),
    relationships("gld_fato_indicadores_capag", "uf_id", "gld_dim_uf", "uf_id", severity="warn"),
    relationships(
        "gld_fato_indicadores_capag", "classificacao_capag_id",
        "gld_dim_classificacao_capag", "classificacao_capag_id", severity="warn",
    ),
    *_key("gld_fato_pib_municipal", "pib_id"),
    not_null("gld_fato_pib_municipal", "cod_ibge"),
    relationships("gld_fato_pib_municipal", "uf_id", "gld_dim_uf", "uf_id", severity="warn"),
    accepted_range("gld_fato_pib_municipal", "pib", min_value=0, severity="warn"),
    *_key("gld_fato_risco_fiscal", "risco_fiscal_id"),
    not_null("gld_fato_risco_fiscal", "cod_ibge"),
    relationships(
        "gld_fato_risco_fiscal", "classificacao_capag_id",
        "gld_dim_classificacao_capag", "classificacao_capag_id", severity="warn",
    ),
    accepted_range("gld_fato_risco_fiscal", "score_risco_fiscal", min_value=0, max_value=100, severity="warn"),
    accepted_values(
        "gld_fato_risco_fiscal", "classificacao_risco",
        ["BAIXO", "MODERADO", "ELEVADO", "CRITICO", "INDETERMINADO"], severity="warn",
    ),
    has_rows("gld_fato_risco_fiscal"),
    accepted_values(
        "gld_report_tendencia_anual", "tendencia", ["MELHORIA", "PIORA", "ESTAVEL", "SEM_HISTORICO"], severity="warn"
    ),
]
