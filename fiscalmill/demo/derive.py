"""Dirty raw tables derived from the generated order tables.

The SQL text runs unchanged on Spark and on the oracle engine; table names are
filled in by the caller.  Municipality = customer, year = order year, GDP = sum
of the customer's orders of that year in whole units.  Indicators are multiples of
1/64, so sums of doubles are exact and do not depend on the row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fiscalmill.functions.text import STATE_BY_PREFIX

# State codes by nation key, in the order of the code prefixes; the last nation keeps its own name.
STATE = (
    "case n_nationkey "
    + " ".join(f"when {key} then lower('{code}')" for key, code in enumerate(list(STATE_BY_PREFIX.values())[:24]))
    + " else lower(n_name) end"
)

BASE = """
select o_custkey as k, year(o_orderdate) as y,
       count(*) as c, sum(cast(floor(o_totalprice) as bigint)) as v
from {orders} group by o_custkey, year(o_orderdate)
"""


def _indicator(factor: int) -> str:
    return (
        f"case when k % 13 = 0 then 'n.d.' else replace(cast(cast(((k * {factor} + y) % 100) / 64.0 "
        "as decimal(12,6)) as string), '.', ',') end"
    )


def _grade(shift: int) -> str:
    return (
        "case when k % 31 = 0 then ' n.d. ' when k % 37 = 0 then 'n.d.' when k % 41 = 0 then '' "
        f"when (k + {shift}) % 4 = 0 then 'A' when (k + {shift}) % 4 = 1 then ' b' "
        f"when (k + {shift}) % 4 = 2 then 'C ' else 'd' end"
    )


def _copies(divisor: int) -> str:
    """A second copy (n = 1) of every key that the divisor divides."""
    return (
        "join (values (0, 0), (1, 0), (1, 1)) as copies(twice, n) "
        f"on twice = case when k % {divisor} = 0 then 1 else 0 end"
    )


RAW_RATING = f"""
with base as ({BASE})
select '  ' || c_name || ' ' as instituicao, cast(k as string) as cod_ibge, ' ' || {STATE} as uf,
  case when k % 17 = 0 then '' else cast(c * 7000 + k * 300 as string) end as populacao,
  {_indicator(7)} as indicador_1, {_grade(0)} as nota_1,
  {_indicator(11)} as indicador_2, {_grade(1)} as nota_2,
  {_indicator(13)} as indicador_3, {_grade(2)} as nota_3,
  case when n = 1 then 'A' when (k + y) % 6 = 0 then 'A' when (k + y) % 6 = 1 then ' b '
    when (k + y) % 6 = 2 then 'C' when (k + y) % 6 = 3 then 'D' when (k + y) % 6 = 4 then 'n.d.' end
    as classificacao_capag,
  case when y < 1998 then null else 'B' end as icf,
  cast(y as string) as ano_base
from base join {{customer}} on k = c_custkey join {{nation}} on c_nationkey = n_nationkey {_copies(11)}
"""

RAW_GDP = f"""
with base as ({BASE})
select cast(y as string) as ano, cast(k as string) as cod_ibge, ' ' || c_name as nome_municipio,
  {STATE} || ' ' as uf,
  case when n = 1 then cast(v + 1 as string) when k % 43 = 0 then '...' else cast(v as string) end as pib
from base join {{customer}} on k = c_custkey join {{nation}} on c_nationkey = n_nationkey {_copies(19)}
where k % 10 <> 3
"""

RAW_CITY = f"""
with listed as (
  select c_custkey as k, ' ' || c_name || '  ' as nome, ' ' || {STATE} as uf
  from {{customer}} join {{nation}} on c_nationkey = n_nationkey where c_custkey % 23 <> 0
)
select cast(case when n = 1 then k + 10000000 else k end as string) as id, cast(k as string) as codigo,
  case when n = 1 then 'copy of ' || nome else nome end as nome, uf
from listed {_copies(29)}
"""

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run shared SQL text over the generated tables it names."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def oracle_text(text: str) -> str:
    """The shared SQL text with plain table names (and single braces)."""
    return text.format(**{name: name for name in TABLES})


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "capag_brasil": derived(spark, sf_dir, RAW_RATING),
        "cidades_brasil": derived(spark, sf_dir, RAW_CITY),
        "pib_municipal": derived(spark, sf_dir, RAW_GDP),
    }
