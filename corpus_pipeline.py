"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``documents``. ``run`` applies them one after another.

Rows with null or repeated ids go through like any others. Of a group of near copies
the row with the smallest id stays (nulls last; of rows with that id one). Empty tables
give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.llm import decontaminate, packing, simhash, substrings, toxicity
from fiscalmill.llm.common import row_key, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels teach, and are no input of a score."""
    model = toxicity.train(toxicity.labelled_rows(docs, table(spark, sf_dir, "labels")))
    kept = toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD)
    return kept.select("rest.*").select(*docs.columns)


def dedup_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut out; texts without any stay as they are."""
    cut = substrings.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    columns = [text.alias("text") if c == "text" else F.char_length(text).cast("long").alias(c) if c == "n_chars" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    return cut.select(*columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; a row is known by id and text, as ids may be null or repeated."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key("doc_id", "text").alias("k"))
    found = decontaminate.find_items(rows.select("k", F.col("row.text").alias("text")), table(spark, sf_dir, "benchmark"), id_column="k")
    leaked = found.select(F.col("doc_id").alias("leaked")).distinct()
    return rows.join(leaked, F.col("k") == F.col("leaked"), "left_anti").select("row.*").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of ids: one row per piece, with its digest instead of the ids."""
    return packing.piece_digests(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", dedup_simhash),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: SQL cannot express tokenizers, fingerprints or learned scores; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage reads what the one before has stored, so a task that runs again reads the same rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
