"""The two JSON feeds: the municipality register and the GDP table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.functions.text import safe_double, state_from_code

# Markers of a missing GDP value.
GDP_MISSING = ["...", "-", "X"]
# Sanity bounds of the register.
MIN_CITIES, STATES = 5000, 27

CITY_SCHEMA = "array<struct<id: bigint, nome: string, microrregiao: struct<mesorregiao: struct<UF: struct<sigla: string>>>>>"
GDP_RECORD = "D3C string, D1C string, D1N string, V string"
GDP_SCHEMA = f"array<struct<{GDP_RECORD}>>"


def read_cities(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """Register files, each one JSON array; positions count within an array.

    An array is one row and must fit a task.  With ``lines`` every line of a file is an
    array of its own (a state's, say), so files of any size are split among tasks.
    """
    return cities_from_json(spark.read.text(path, wholetext=not lines), "value")


def read_gdp(spark: SparkSession, path: str | list[str], lines: bool = False) -> DataFrame:
    """GDP files, each a JSON array of records; files are read in parallel.

    With ``lines`` every line is a record or an array of them, so large files are split
    among tasks as well; without, a file is read by one task.
    """
    return gdp_from_records(spark.read.schema(GDP_RECORD).json(path, multiLine=not lines))


def cities_from_json(feed: DataFrame, json: str = "json") -> DataFrame:
    """Municipalities of a nested JSON array as (Id, Codigo, Nome, UF).

    Id is the 1-based position in the array; entries without a state are
    skipped afterwards, so their numbers stay unused.
    """
    entries = feed.select(F.posexplode(F.from_json(F.col(json), CITY_SCHEMA)).alias("at", "city"))
    return entries.select(
        (F.col("at") + 1).cast("bigint").alias("Id"),
        F.col("city.id").alias("Codigo"),
        F.col("city.nome").alias("Nome"),
        F.col("city.microrregiao.mesorregiao.UF.sigla").alias("UF"),
    ).filter(F.col("UF").isNotNull())


def assert_register(cities: DataFrame, min_rows: int = MIN_CITIES, states: int = STATES) -> DataFrame:
    """Fail unless the register is large enough and covers every state."""
    rows, found = cities.agg(F.count("*"), F.count_distinct("UF")).first()
    if rows < min_rows:
        raise ValueError(f"only {rows} municipalities, expected at least {min_rows}")
    if found != states:
        raise ValueError(f"{found} states, expected {states}")
    return cities


def gdp_records(feed: DataFrame, json: str = "json") -> DataFrame:
    """The flat records of a JSON array."""
    return feed.select(F.inline(F.from_json(F.col(json), GDP_SCHEMA)))


def gdp_from_records(records: DataFrame) -> DataFrame:
    """Typed GDP rows from (D3C year, D1C code, D1N name, V value).

    Missing-value markers are dropped; numbers that cannot be read become NULL;
    rows without a code or year are dropped.
    """
    valid = records.filter(F.col("V").isNotNull() & ~F.col("V").isin(GDP_MISSING))
    typed = valid.select(
        safe_double("D3C").try_cast("bigint").alias("ano"),
        safe_double("D1C").try_cast("bigint").alias("cod_ibge"),
        F.col("D1N").alias("nome_municipio"),
        state_from_code("D1C").alias("uf"),
        safe_double("V").alias("pib"),
    )
    return typed.dropna(subset=["cod_ibge", "ano"])
