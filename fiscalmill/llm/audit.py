"""How five text filters act together, in every order of them.

A filter is a letter; a document's mask has the bits of the filters that it fails:

A  under 50 words             B  100 * distinct words < 65 * words
C  100 * A-Z > 5 * characters D  holds one of # $ % & * |
E  the same text has a row of smaller id, in the whole table

A to D follow from the text alone. E is kept up to date while the files come in as
available-now micro-batches. The state of a text (by its SHA-256) is its smallest id so
far, with what the rows of that id add to the counters of their parts. When a smaller id
comes, those rows are taken back from the counters and added again with E set. Texts lie in
buckets by their hash, as many as the table's size asks for, so that the state of a bucket stays
small; a call for each single text would cost more than all else. Every
micro-batch writes its changes, by its number, so a repeated batch replaces them; their
sum is the number of documents by part, mask and labels, from which all figures follow.

Before rows are dealt by text, each task folds those it reads: of a text's rows in a batch
of the task only those of the smallest id ask for state, the others have E for certain
and are counters already. So a text that a third of all rows share moves a few rows per task.

Null text counts as empty, and null source as the empty part. A row without an id never
fails E, as nothing is smaller than its id, and makes no other row fail it. Rows that share the
smallest id do not fail it either. Repeated rows count each. A document's labels are the
largest of its rows in ``labels``. Empty texts have no words, fail A alone, and E by the same
rule. Other columns, whatever their names, are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.llm.common import stored
from fiscalmill.session import scratch_dir

FILTERS = "ABCDE"
LATER = 1 << FILTERS.index("E")
#: Micro-batches that the files of a table make, about.
BATCHES = 4
#: Texts whose state is kept together, on average, and rows for a partition of the state.
BUCKET = 512
STATE_ROWS = 8192
_WHITE = " \t\n\x0b\x0c\r"
_FOLDED = "key binary, doc_id long, part string, mask int, good boolean, toxic boolean, asks boolean, n long"
_DELTA = "part string, mask int, good boolean, toxic boolean, n long"
#: One entry for each text and part of the rows that hold its smallest id.
_STATE = "keys array<binary>, ids array<long>, masks array<int>, good array<boolean>, toxic array<boolean>, parts array<string>, counts array<long>"
#: State on disk, so that it need not fit in memory; the shared folder gets its changes. No disk is taken ahead of use.
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_COLUMNS = ["key", "doc_id", "part", "mask", "good", "toxic", "asks", "n"]


def text_mask(text: str, words: str) -> Column:
    """Bits of A to D; ``words`` is the array of the text's words."""
    n, distinct = F.size(words), F.size(F.array_distinct(F.col(words)))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = (n < 50, F.lit(100) * distinct < F.lit(65) * n, F.lit(100) * capitals > F.lit(5) * F.length(text).cast("long"), F.col(text).rlike(r"[#$%&*|]"))
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return sum(bits[1:], bits[0]).cast("int")


def masked(docs: DataFrame) -> DataFrame:
    """(key, doc_id, part, mask): a small row for each document, E not yet known."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    bare = F.btrim("text", F.lit(_WHITE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \t-\r]+"))
    return rows.withColumn("words", words).select(F.unhex(F.sha2("text", 256)).alias("key"), "doc_id", "part", text_mask("text", "words").alias("mask"))


def labels_of(labels: DataFrame) -> DataFrame:
    """(id, good, toxic): one row per labelled document."""
    found = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    one = lambda c: F.coalesce(F.max(F.col(c)) == 1, F.lit(False))
    return found.agg(one("quality").alias("good"), one("toxic").alias("toxic"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows without an id match nothing; a salt deals them over all tasks."""
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("key")).otherwise(F.lit(0).cast("long"))
    known = labels.withColumn("zero", F.lit(0).cast("long"))
    joined = rows.withColumn("salt", salt).join(known, (F.col("doc_id") == F.col("id")) & (F.col("salt") == F.col("zero")), "left")
    return joined.select("key", "doc_id", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows with their number; a row asks for state if its id is the smallest of its text here."""
    names = [f.split()[0] for f in _FOLDED.split(", ")]
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        least = rows.group_by("key").aggregate([("doc_id", "min")])
        place = pc.index_in(rows.column("key"), value_set=least.column("key").combine_chunks())
        least = least.column("doc_id_min").take(place)
        own = rows.column("doc_id")
        later = pc.fill_null(pc.greater(own, least), False)
        mask = pc.bit_wise_or(rows.column("mask"), pc.multiply(later.cast(pa.int32()), pa.scalar(LATER, pa.int32())))
        asks = pc.and_(pc.is_valid(own), pc.invert(later))
        rows = rows.set_column(3, "mask", mask).append_column("asks", asks).set_column(1, "doc_id", pc.if_else(asks, own, pa.scalar(None, pa.int64())))
        folded = rows.group_by(["key", "doc_id", "part", "mask", "good", "toxic", "asks"]).aggregate([([], "count_all")]).rename_columns(names)
        yield from folded.cast(pa.schema([(f.name, pa.int64() if f.name == "n" else f.type) for f in folded.schema])).to_batches()


def settle(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Changes of the part counters by the new rows of a bucket of texts."""
    texts: dict[bytes, list] = {}  # least id, mask, good, toxic, number of rows by part
    if state.exists:
        for text, doc_id, mask, good, toxic, part, n in zip(*state.get):
            texts.setdefault(bytes(text), [doc_id, mask, good, toxic, {}])[4][part] = n
    changes: dict[tuple, int] = {}
    moved = False

    def count(part: str, mask: int, good: bool, toxic: bool, n: int) -> None:
        changes[part, mask, good, toxic] = changes.get((part, mask, good, toxic), 0) + n

    for frame in frames:
        for text, doc_id, part, mask, good, toxic, asks, n in zip(*[frame[c].tolist() for c in _COLUMNS]):
            held = texts.get(text) if asks else None
            if not asks or held and doc_id > held[0]:
                count(part, mask | LATER if asks else mask, good, toxic, n)
                continue
            if held is None or doc_id < held[0]:
                if held:  # a smaller id: the rows before it now fail E
                    for p, c in held[4].items():
                        count(p, *held[1:4], -c)
                        count(p, held[1] | LATER, *held[2:4], c)
                held = texts[text] = [int(doc_id), mask, good, toxic, {}]
            held[4][part] = held[4].get(part, 0) + n
            count(part, mask, good, toxic, n)
            moved = True
    if moved:
        entries = [(text, *held[:4], p, c) for text, held in texts.items() for p, c in held[4].items()]
        state.update(tuple(map(list, zip(*entries))))
    rows = [(*k, n) for k, n in changes.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


@contextmanager
def _settings(spark: SparkSession, **conf: str):
    """Settings that a stream takes over when it starts, and the session's own ones after that."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(part, mask, good, toxic, n) of the documents below ``path``, by a stream over its files."""
    table = spark.read.parquet(path)
    files, rows = table.inputFiles(), table.count()
    if not rows:
        return spark.createDataFrame([], _DELTA)
    out, log = scratch_dir(spark, "counters"), scratch_dir(spark, "stream")
    known = stored(labels_of(labels), "labels")
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", -(-len(files) // batches))
    # a table may be one file or a folder of them
    stream = source.parquet(path) if len(files) > 1 else source.option("pathGlobFilter", files[0].rsplit("/", 1)[1]).parquet(files[0].rsplit("/", 1)[0])
    small = with_labels(masked(stream), known).mapInArrow(fold, _FOLDED)
    bucket = F.pmod(F.xxhash64("key"), F.lit(-(-rows // BUCKET))).alias("bucket")
    changes = small.select(bucket, *_COLUMNS).groupBy("bucket").applyInPandasWithState(settle, _DELTA, _STATE, "update", "NoTimeout")

    def save(change: DataFrame, number: int) -> None:
        total = change.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{out}/batch={number}")

    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // STATE_ROWS))
    with _settings(spark, **{"spark.sql.shuffle.partitions": str(parts), **_STATE_STORE}):
        query = changes.writeStream.outputMode("update").option("checkpointLocation", log).trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()
    saved = spark.read.schema(f"{_DELTA}, batch int").parquet(out)
    return saved.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counters; parts have at most 128 of them."""
    spark = counts.sparkSession
    steps = [
        ("".join(order), step + 1, 1 << FILTERS.index(letter), sum(1 << FILTERS.index(f) for f in order[:step]))
        for order in permutations(FILTERS)
        for step, letter in enumerate(order)
    ]
    steps = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, own int, before int"))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    earlier = F.col("mask").bitwiseAND(F.col("before")) != 0
    removed = fails & ~earlier
    of = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")
    by_mask = counts.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"),
    )
    figures = by_mask.crossJoin(steps).groupBy("part", "filter_order", "step", "own").agg(
        of(~fails & ~earlier).alias("kept"), of(removed).alias("removed"), of(fails & earlier).alias("redundant"),
        of(F.col("mask") == F.col("own")).alias("unique_fails"),
        F.sum(F.when(removed, F.col("n_good")).otherwise(0)).cast("long").alias("good_lost"),
        F.sum(F.when(removed, F.col("n_toxic")).otherwise(0)).cast("long").alias("toxic_lost"),
    )
    shares = figures.groupBy(F.col("part").alias("p"), F.col("own").alias("o")).agg(F.sum("removed").alias("shapley"))
    joined = figures.join(shares, (F.col("part") == F.col("p")) & (F.col("own") == F.col("o")))
    return joined.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    return report(counters(spark, path, labels, batches))
