"""The registered queries, their SQL, and the pipeline's stages on whole small tables."""

import collections

import pytest
from compare import difference, oracle_connection
from test_llm_operators import fingerprints_by_hand, leaks_by_hand, windows_by_hand

import __spark_entry__ as registry
import corpus_pipeline
from fiscalmill.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(registry.queries()) and set(queries.ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_its_sql(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), oracle_connection(sf_dir), queries.ORACLES[name]) is None


@pytest.fixture(scope="module")
def empty_dir(spark, sf_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("empty")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    rows = queries.QUERIES[name](spark, empty_dir).collect()
    assert len(rows) == (1 if name.startswith("op1_") else 0)  # the conversation that the query adds itself


def test_empty_pipeline(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_stages_do_what_they_say(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "substring_dedup", "decontamination", "packing"]

    kept = stage["toxicity"](spark, docs, sf_dir)
    marked = {r["doc_id"]: r["predicted"] for r in queries.op9_toxicity(spark, sf_dir).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, p in marked.items() if not p) and kept.columns == columns

    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = stage["simhash_near_dedup"](spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in fingerprints_by_hand(rows)}) and kept.columns == columns

    cut = stage["substring_dedup"](spark, docs, sf_dir)
    removed = {d: n for d, _, n, _ in windows_by_hand(rows)}
    texts = dict(rows)
    for r in cut.collect():
        assert len(r["text"].split()) == len(texts[r["doc_id"]].split()) - removed[r["doc_id"]] and r["n_chars"] == len(r["text"])
        assert removed[r["doc_id"]] or r["text"] == texts[r["doc_id"]]
    assert cut.columns == columns

    clean = stage["decontamination"](spark, docs, sf_dir)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _ in leaks_by_hand(rows, items)}
    left = {r["doc_id"] for r in clean.collect()}
    assert not leaked & left and len(texts) - len(leaked) - len(left) <= 1 and clean.columns == columns


def test_decontamination_keeps_clean_rows_of_the_same_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    odd = [(None, "a clean row without an id"), (None, f"some words {item} more words"), (5, "a clean row"), (5, f"{item} again"), (6, None), (None, None)]
    left = corpus_pipeline.drop_benchmark(spark, spark.createDataFrame(odd, docs.schema), sf_dir).collect()
    assert sorted(map(tuple, left), key=str) == sorted([odd[0], odd[2], odd[4], odd[5]], key=str)


def test_pipeline_packs_what_is_left(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    total = collections.Counter()
    for r in rows:
        total[r["doc_id"]] += r["length"]
    assert total and all(total[r["doc_id"]] == r["doc_tokens"] for r in rows)


def test_nulls_and_clashing_columns(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "a b", "en", "s", 3), (5, "a b", "en", "s", 3), (None, "x" * 200_000, "en", None, None)], docs.schema)
    docs = docs.limit(60).unionByName(odd)
    for name in ("rest", "fp", "start", "block", "score", "row", "kind"):
        docs = docs.selectExpr("*", f"doc_id as `{name}`")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert {"rest", "fp", "start", "block", "score", "row", "kind"} <= set(docs.columns), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= 1
