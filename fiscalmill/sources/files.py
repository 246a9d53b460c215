"""CSV sources and layer tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fiscalmill.operators.shape import nullcheck_table
from fiscalmill.operators.small import checked_broadcast
from fiscalmill.quality.runner import Watch
from fiscalmill.session import settings

RATING_COLUMNS = [
    "instituicao", "cod_ibge", "uf", "populacao",
    "indicador_1", "nota_1", "indicador_2", "nota_2", "indicador_3", "nota_3",
    "classificacao_capag", "icf", "ano_base",
]
CITY_COLUMNS = ["id", "codigo", "nome", "uf"]
GDP_COLUMNS = ["ano", "cod_ibge", "nome_municipio", "uf", "pib"]

LAYERS = ("raw", "bronze", "silver", "gold")


def _headers(spark: SparkSession, path: str | list[str], options: dict) -> dict[tuple[str, ...], list[str]]:
    """The files by their header; a look at each file's first line."""
    files = [unquote(f) for f in spark.read.text(path).inputFiles()]
    with ThreadPoolExecutor(16) as pool:
        found = pool.map(inheritable_thread_target(spark)(lambda f: tuple(spark.read.csv(f, **options).columns)), files)
    out: dict[tuple[str, ...], list[str]] = {}
    for file, header in sorted(zip(files, found)):
        if header:  # a file without a line has no rows either
            out.setdefault(header, []).append(file)
    return out


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str], multi_line: bool = False) -> DataFrame:
    """Header CSV, its columns taken by name and kept as text, so keys keep their raw spelling.

    Every file's own header counts: files that order their columns in other ways, or
    hold more of them, are read together with others of the same header.  A missing
    column raises, and so does a path without any header.  Empty cells are NULL, quoted
    or not.  Cells that hold line breaks need ``multi_line``; such files cannot be split
    between tasks.
    """
    options = {"header": True, "inferSchema": False, "multiLine": multi_line, "escape": '"'}
    by_header = _headers(spark, path, options)
    if not by_header:
        raise ValueError(f"no header in {path}")
    parts = []
    for header, files in by_header.items():
        names = {c.strip(): c for c in header}
        missing = [c for c in columns if c not in names]
        if missing:
            raise ValueError(f"no column {', '.join(missing)} in the header of {', '.join(files)}")
        raw = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(files, **{**options, "enforceSchema": True})
        parts.append(raw.select(*[F.col(f"`{names[c]}`").alias(c) for c in columns]))
    return nullcheck_table(reduce(DataFrame.unionAll, parts))


def range_sorted(df: DataFrame, *columns: str) -> DataFrame:
    """Global order over many tasks: range partitions, each sorted.

    The caller lists enough columns to tell rows apart, so that one frequent
    leading value spreads over several partitions.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def order_manifest(stored: DataFrame, *columns: str) -> DataFrame:
    """One row per file of a table of Parquet files: (file, rows, least, greatest, unsorted).

    ``least`` and ``greatest`` are the keys at its ends, NULLs first, and ``unsorted`` the
    rows that are smaller than the one before them in the file.
    """
    key = F.struct(*[F.col(f"`{c}`") for c in columns])
    rows = stored.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), key.alias("key"))
    before = F.lag("key").over(Window.partitionBy("file").orderBy("at"))
    falls = rows.withColumn("falls", F.coalesce(F.col("key") < before, F.lit(False)))
    ends = falls.groupBy("file").agg(F.count("*").alias("rows"), F.min("key").alias("least"), F.max("key").alias("greatest"), F.count_if("falls").alias("unsorted"))
    return ends


def overlapping_files(manifest: DataFrame) -> DataFrame:
    """Neighbouring files whose ranges overlap: none when the table is in order. One row per file is looked at."""
    following = Window.orderBy("least", "greatest", "file")
    near = manifest.withColumn("next_file", F.lead("file").over(following)).withColumn("next_least", F.lead("least").over(following))
    return near.where("greatest > next_least").select("file", "next_file", "greatest", "next_least")


class LayerTables:
    """Tables of the layers, below a folder or in one database per layer.

    With ``buckets``, tables of a database that are written with a key are dealt into
    that many buckets by it: joins and windows on the key then read them without a
    shuffle, and a filter on it reads one bucket.  Only a catalog knows of buckets.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, buckets: int = 0):
        if root and buckets:
            raise ValueError("buckets need the catalog: leave out the folder")
        self.spark, self.root, self.buckets = spark, root.rstrip("/") if root else None, buckets

    def _path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def write(
        self,
        layer: str,
        name: str,
        df: DataFrame,
        partition_by: str | None = None,
        cluster_by: list[str] | None = None,
        key: list[str] | None = None,
        mode: str = "overwrite",
        watch: Watch | None = None,
    ) -> DataFrame:
        """Replace (or append to) a table and return it as stored.

        ``watch`` counts failing rows of its checks on the way.

        With ``partition_by`` the rows are rebalanced on that column: a year
        with most of the rows is split over many tasks of a sensible size, and
        small years do not leave a file per task.  Rows are sorted inside every
        file, so its row groups skip by the cluster columns.
        """
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        bucketed = bool(self.buckets and key and mode == "overwrite")
        if bucketed:
            df = df.repartition(self.buckets, *key)  # one file per bucket (and year)
        elif partition_by:
            df = df.hint("rebalance", partition_by)
        schema = df.schema
        if watch:
            df = watch.on(name, df)
        if partition_by or bucketed:
            order = [*(key or []), *(cluster_by or [])] if bucketed else [*(cluster_by or []), *(key or [])]
            df = df.sortWithinPartitions(*([partition_by] if partition_by else []), *order)
        writer = df.write.mode(mode).format("parquet")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        if bucketed:
            writer = writer.bucketBy(self.buckets, *key).sortBy(*key)
        if self.root:
            writer.option("partitionOverwriteMode", "static").save(self._path(layer, name))
        else:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            writer.saveAsTable(f"{layer}.{name}")
        return self.read(layer, name, schema)

    def replace_years(self, layer: str, name: str, df: DataFrame, year: str) -> None:
        """Replace just the years that ``df`` holds, each as a whole.

        Spark writes to a folder of its own first and moves the years at the end, so a
        job that fails leaves the table as it was.
        """
        df = df.hint("rebalance", year).sortWithinPartitions(year)
        if not self.root and not self.exists(layer, name):
            self.write(layer, name, df.limit(0), partition_by=year)
        with settings(self.spark, **{"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            if self.root:
                df.write.mode("overwrite").partitionBy(year).parquet(self._path(layer, name))
            else:
                df.select(*self.spark.table(f"{layer}.{name}").columns).write.mode("overwrite").insertInto(f"{layer}.{name}")

    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame:
        """A stored table; a schema fixes the type of the partition column."""
        if not self.root:
            df = self.spark.table(f"{layer}.{name}")
            return df.select(*schema.names) if schema else df
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        df = reader.parquet(self._path(layer, name))
        return df.select(*schema.names) if schema else df

    def partition_values(self, layer: str, name: str, column: str) -> list[str]:
        """The values of a partition column, from the names of the partitions: no rows are read."""
        if self.root:
            listed = self.read(layer, name, T.StructType([T.StructField(column, T.StringType())])).inputFiles()
            parts = [unquote(part) for file in listed for part in unquote(file).split("/")]
        else:
            parts = [part for r in self.spark.sql(f"SHOW PARTITIONS {layer}.{name}").collect() for part in r[0].split("/")]
        return sorted({p.removeprefix(f"{column}=") for p in parts if p.startswith(f"{column}=") and not p.endswith("__HIVE_DEFAULT_PARTITION__")})

    def newest(self, layer: str, name: str, column: str) -> int | None:
        """The largest value of a whole-number partition column, such as the newest year."""
        return max(map(int, self.partition_values(layer, name, column)), default=None)

    def exists(self, layer: str, name: str) -> bool:
        if not self.root:
            return self.spark.catalog.tableExists(f"{layer}.{name}")
        try:
            self.read(layer, name)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True


def years_stored(stored: DataFrame, year: str) -> DataFrame:
    """Distinct numeric years; text that is not an integer is left out."""
    number = F.trim(F.col(year).cast("string")).try_cast("bigint")
    return stored.select(number.alias("_year")).filter("_year is not null").distinct()


def new_years_only(incoming: DataFrame, year: str, stored: DataFrame, stored_year: str) -> DataFrame:
    """Incoming rows whose year the stored table does not hold yet.

    The years are few, so they are broadcast and a year with most of the rows
    is not gathered in one task.
    """
    number = F.trim(F.col(year).cast("string")).try_cast("bigint")
    have = checked_broadcast(years_stored(stored, stored_year))
    return incoming.withColumn("_year", number).join(have, "_year", "left_anti").select(*incoming.columns)


def _commits(tables: LayerTables, layer: str, name: str, year: str, incoming: DataFrame) -> DataFrame:
    """The years that are stored for good: (year, rows).

    A table from before these marks has all its years marked; that happens before
    anything is appended, so a half-written year never gets a mark by it.
    """
    marks = f"{name}_years"
    if not tables.exists(layer, marks):
        empty = incoming.limit(0).select(year)
        stored = tables.read(layer, name).select(F.col(year).cast(incoming.schema[year].dataType).alias(year)) if tables.exists(layer, name) else empty
        tables.write(layer, marks, stored.groupBy(year).agg(F.count("*").alias("rows")))
    return tables.read(layer, marks)


def committed(tables: LayerTables, layer: str, name: str, year: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a table that years are appended to, but for years of a job that has not come to its end."""
    stored = tables.read(layer, name, schema)
    marks = tables.read(layer, f"{name}_years").select(F.col(year).cast(stored.schema[year].dataType).alias("_year")).distinct()
    return stored.join(checked_broadcast(marks), stored[year].eqNullSafe(F.col("_year")), "left_semi")


def append_new_years(tables: LayerTables, layer: str, name: str, incoming: DataFrame, year: str) -> DataFrame:
    """Append the years not stored yet; years stored for good are never rewritten.

    A year counts as stored when it has its mark in ``<name>_years``, which is written
    after its rows.  A job that is lost between, or while its files move, leaves years without a
    mark; the next run replaces them as a whole, so each row is there once.

    Rows whose year cannot be read go to the table ``<name>_rejected``, which is
    replaced each time; they are never appended, so a second run adds nothing.
    """
    number = F.trim(F.col(year).cast("string")).try_cast("bigint")
    tables.write(layer, f"{name}_rejected", incoming.filter(number.isNull()))
    incoming = incoming.filter(number.isNotNull())
    marks = _commits(tables, layer, name, year, incoming)
    new = new_years_only(incoming, year, marks, year)
    tables.replace_years(layer, name, new, year)
    stored = tables.read(layer, name, new.schema)
    fresh = new_years_only(stored, year, marks, year).groupBy(year).agg(F.count("*").alias("rows"))
    years = new.select(F.col(year).alias("_new")).distinct()  # not those that an earlier job left behind
    fresh = fresh.join(years, F.col(year) == F.col("_new"), "left_semi")
    tables.write(layer, f"{name}_years", fresh, mode="append")
    return committed(tables, layer, name, year, new.schema)
