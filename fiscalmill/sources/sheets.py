"""Yearly rating sheets whose headers change from year to year.

A sheet is held as rows (file, year, row_index, cells).  Every file's header
row is found by keyword, its names are mapped to the target columns, and one
pass over all rows picks the cells by position: no loop over files, no union.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.functions.text import blank_null_words, integer_text, strip
from fiscalmill.operators.shape import nullcheck_table
from fiscalmill.operators.small import checked_broadcast
from fiscalmill.sources.files import RATING_COLUMNS

# Words that mark a header row.
HEADER_WORDS = ["Cod.IBGE", "Código", "Município", "Indicador", "Instituição"]
# Fixed value: a header is looked for in this many leading rows.
HEADER_ROWS = 5
# Target column for every known header name.
HEADER_NAMES = {
    "Instituição": "instituicao",
    "Município": "instituicao",
    "Nome_Município": "instituicao",
    "Cod.IBGE": "cod_ibge",
    "Código Município Completo": "cod_ibge",
    "UF": "uf",
    "População": "populacao",
    "Indicador_1": "indicador_1",
    "Indicador 1": "indicador_1",
    "Nota_1": "nota_1",
    "Nota 1": "nota_1",
    "Indicador_2": "indicador_2",
    "Indicador 2": "indicador_2",
    "Nota_2": "nota_2",
    "Nota 2": "nota_2",
    "Indicador_3": "indicador_3",
    "Indicador 3": "indicador_3",
    "Nota_3": "nota_3",
    "Nota 3": "nota_3",
    "Classificação_CAPAG": "classificacao_capag",
    "Classificação da CAPAG": "classificacao_capag",
    "CAPAG_Oficial": "classificacao_capag",
    "CAPAG": "classificacao_capag",
    "ICF": "icf",
    "Ranking da CCONF": "icf",
    "Ranking": "icf",
    "Ano_Base": "ano_base",
}
# Fixed value: rating columns named after a year, such as CAPAG_2023.
RATING_BY_YEAR = r"^CAPAG_\d{4}"
# The file published in 2022 holds wrong base years.
WRONG_YEAR_FILE, ITS_BASE_YEAR = 2022, 2021
INTEGER_COLUMNS = ["populacao", "cod_ibge", "ano_base"]


def read_sheets(spark: SparkSession, path: str | list[str], separator: str = ",") -> DataFrame:
    """Text sheets as (file, year, row_index, cells); the year is in the file name.

    Only the leading rows of a file need their index, and they lie in its first
    block, so the rows of later blocks get none.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
        "value",
    )
    # The ids of a block are consecutive, so the index is a difference to the
    # file's smallest one: one row per file is joined, nothing is sorted.
    width = F.length("value") - F.length(F.replace("value", F.lit(separator), F.lit(""))) + 1
    files = checked_broadcast(
        lines.groupBy("file").agg(F.min(F.when(F.col("_start") == 0, F.col("_at"))).alias("_first"), F.max(width).alias("_width"))
    )
    widest = files.agg(F.max("_width")).first()[0] or 1
    parsed = F.from_csv("value", F.lit(", ".join(f"c{i} string" for i in range(widest))), {"sep": separator})
    name = F.element_at(F.split("file", "/"), -1)
    return lines.join(files, "file").select(
        "file",
        F.regexp_extract(name, r"(\d{4})", 1).try_cast("bigint").alias("year"),
        F.when(F.col("_start") == 0, F.col("_at") - F.col("_first")).alias("row_index"),
        F.array(*[parsed[f"c{i}"] for i in range(widest)]).alias("cells"),
    )


def header_rows(sheets: DataFrame) -> DataFrame:
    """(file, header_row): the first leading row holding a header word, else 0."""
    text = F.array_join("cells", " ")
    has_word = F.lit(False)
    for word in HEADER_WORDS:
        has_word = has_word | F.contains(text, F.lit(word))
    leading = sheets.filter(F.col("row_index") < HEADER_ROWS)
    found = F.min(F.when(has_word, F.col("row_index")))
    return leading.groupBy("file").agg(F.coalesce(found, F.lit(0)).cast("bigint").alias("header_row"))


def header_positions(sheets: DataFrame) -> DataFrame:
    """(file, header_row, positions): cell position of every known target column.

    Names are trimmed; of several names for one target the last one counts.
    """
    rows = header_rows(sheets)
    leading = sheets.filter(F.col("row_index") < HEADER_ROWS)
    headers = leading.join(rows, "file").filter("row_index = header_row")
    cells = headers.select("file", "header_row", F.posexplode("cells").alias("at", "cell"))
    name = strip("cell")
    # A header may carry a target's own name already, in capitals.
    names = {**HEADER_NAMES, **{c.upper(): c for c in RATING_COLUMNS}}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    target = F.when(name.rlike(RATING_BY_YEAR), "classificacao_capag").otherwise(F.try_element_at(known, name))
    last = [F.max(F.when(target == c, F.col("at"))).alias(c) for c in RATING_COLUMNS]
    return cells.groupBy("file", "header_row").agg(*last).select("file", "header_row", F.struct(*RATING_COLUMNS).alias("positions"))


def unify_sheets(sheets: DataFrame) -> DataFrame:
    """All data rows of all sheets with the target columns, as text.

    Rows without any cell content are no data.
    """
    rows = sheets.join(checked_broadcast(header_positions(sheets)), "file")
    data = rows.filter(F.col("row_index").isNull() | (F.col("row_index") > F.col("header_row")))
    data = data.filter(F.exists("cells", lambda c: c != ""))

    def cell(column: str):
        return F.try_element_at("cells", (F.col(f"positions.{column}") + 1).cast("int"))

    picked = data.select("year", *[cell(c).alias(c) for c in RATING_COLUMNS], F.col("positions.ano_base").isNotNull().alias("_has_year"))
    return clean_rows(picked.withColumn("ano_base", base_year("year", "ano_base", "_has_year")))


def base_year(file_year: str, year: str, has_year_column: str):
    """Base year: the file's own column, else the published year - 1."""
    derived = F.when(F.col(has_year_column), F.col(year)).otherwise((F.col(file_year) - 1).cast("string"))
    return F.when(F.col(file_year) == WRONG_YEAR_FILE, str(ITS_BASE_YEAR)).otherwise(derived)


def clean_rows(df: DataFrame) -> DataFrame:
    """Clean integers and left-over null words in the target columns."""
    ints = df.withColumns({c: integer_text(c) for c in INTEGER_COLUMNS})
    return ints.select(*[blank_null_words(c).alias(c) for c in RATING_COLUMNS])


def load_sheets(spark: SparkSession, path: str | list[str], separator: str = ",") -> DataFrame:
    """Raw ratings from sheet files; an empty cell is NULL, as in any load."""
    return nullcheck_table(unify_sheets(read_sheets(spark, path, separator)))
