"""Union of tables whose columns differ."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: default name of the column that holds the input's name.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(
    relations: dict[str, DataFrame],
    column_override: dict[str, str] | None = None,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of columns, missing ones filled with NULL.

    Columns come in first-seen order and take the first-seen type unless
    ``column_override`` names another; a wider text type wins over a narrower.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    if not relations:
        raise ValueError("no relations to union")
    wanted = {c.lower() for c in include or []}
    unwanted = {c.lower() for c in exclude or []}

    def kept(name: str) -> bool:
        return (not wanted or name.lower() in wanted) and name.lower() not in unwanted

    types: dict[str, T.DataType] = {}
    for df in relations.values():
        for field in df.schema:
            if kept(field.name):
                types[field.name] = _wider_text(types.get(field.name), field.dataType)
    if not types and (include or exclude):
        raise ValueError(f"no columns left to union for {', '.join(relations)}")

    override = column_override or {}
    parts = []
    for name, df in relations.items():
        rows = df.filter(where) if where else df
        own = set(df.columns)
        columns = [
            (F.col(f"`{c}`") if c in own else F.lit(None)).cast(override.get(c, t)).alias(c)
            for c, t in types.items()
        ]
        if source_column_name:
            columns.insert(0, F.lit(name).alias(source_column_name))
        parts.append(rows.select(*columns))
    return reduce(DataFrame.union, parts)


def _wider_text(seen: T.DataType | None, new: T.DataType) -> T.DataType:
    if seen is None:
        return new
    lengths = [getattr(t, "length", None) for t in (seen, new)]
    if all(lengths):
        return new if lengths[1] > lengths[0] else seen
    if lengths[0] and isinstance(new, T.StringType):
        return new
    return seen


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str | None, table_pattern: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Tables and temporary views whose name matches an ILIKE pattern.

    ``schema_pattern=None`` looks at the current database and the temporary
    views; otherwise all databases matching the pattern are searched.
    """
    if schema_pattern is None:
        databases = [spark.catalog.currentDatabase()]
    else:
        databases = [d.name for d in spark.catalog.listDatabases() if _ilike(d.name, schema_pattern)]
    found = {}
    for database in databases:
        for table in spark.catalog.listTables(database):
            if table.isTemporary and schema_pattern is not None:
                continue
            if _ilike(table.name, table_pattern) and not _ilike(table.name, exclude):
                name = table.name if table.isTemporary else f"{database}.{table.name}"
                found[name] = spark.table(name)
    return dict(sorted(found.items()))


def relations_by_prefix(
    spark: SparkSession, schema_pattern: str | None, prefix: str, exclude: str = ""
) -> dict[str, DataFrame]:
    """Tables whose name starts with ``prefix``."""
    return relations_by_pattern(spark, schema_pattern, f"{prefix}%", exclude)


def _ilike(text: str, pattern: str) -> bool:
    regex = "".join(".*" if ch == "%" else "." if ch == "_" else re.escape(ch) for ch in pattern)
    return re.fullmatch(regex, text, re.IGNORECASE | re.DOTALL) is not None
