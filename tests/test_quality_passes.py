"""How often checks read a table: shared passes, counters that ride on the write, fingerprints."""

import re

import pytest
from pyspark.sql import functions as F

from fiscalmill.demo.queries import SUMMARY_CHECKS
from fiscalmill.quality import checks as c
from fiscalmill.quality import fingerprint, runner
from fiscalmill.sources.files import LayerTables

SUITE = [
    runner.not_null("t", "a"), runner.not_null("t", "a", where="b = 'x'"), runner.accepted_range("t", "a", 0, 2),
    runner.not_empty_string("t", "b"), runner.assert_equal("t", "a", "y"), runner.has_rows("t"), runner.has_rows("t", where="a > 99"),
    runner.at_least_one("t", "n"), runner.at_least_one("t", "a"), runner.not_constant("t", "k"), runner.not_constant("t", "a"),
    runner.not_constant("t", "a", where="a = 1"), runner.not_null_proportion("t", "b", 0.9), runner.not_null_proportion("t", "b", 0.5),
    runner.unique("t", "a"), runner.unique("t", "a", where="b = 'x'"), runner.unique("t", "n"), runner.unique_combination_of_columns("t", ["a", "n"]),
    runner.unique_combination_of_columns("t", ["y"], where="a = 1"), runner.accepted_values("t", "b", ["x"]), runner.not_accepted_values("t", "b", ["x", "q", ""]),
]


@pytest.fixture
def tables(frame):
    rows = [(1, "x", None, 7, 1), (1, "x", None, 7, 2), (None, "", None, 7, 3), (3, None, None, 7, 3), (2, "z", None, 7, 2), (1, "z", None, 7, 1), (None, "x", None, 7, 5)]
    return {"t": frame("a int, b string, n int, k int, y int", *rows)}


def one_by_one(tables, suite):
    """Failures as the number of failing rows that each check builds for itself."""
    return [check.rows(tables).count() for check in suite]


def test_shared_passes_count_what_each_check_finds(tables):
    want = one_by_one(tables, SUITE)
    assert [r["failures"] for r in runner.run_checks(tables, SUITE)] == want
    empty = {"t": tables["t"].limit(0)}
    assert [r["failures"] for r in runner.run_checks(empty, SUITE)] == one_by_one(empty, SUITE)
    for check, failures in zip(SUITE, want):  # and alone
        assert runner.run_checks(tables, [check])[0]["failures"] == failures


def test_a_table_is_read_twice_at_most(spark, sf_dir):
    own = [check for check in SUMMARY_CHECKS if check.counter() is not None or check.key]
    assert len(own) >= 13
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("orders", "lineitem")}
    plan = runner.failure_counts(tables, own)._jdf.queryExecution().executedPlan().toString()
    for name in tables:
        assert 1 <= len(re.findall(rf"FileScan parquet .*{name}\.parquet", plan)) <= 2


def test_a_watched_write_needs_no_second_read(spark, tables, tmp_path):
    suite = [check for check in SUITE if not check.key]
    watch = runner.Watch(suite)
    stored = LayerTables(spark, str(tmp_path)).write("silver", "t", tables["t"], "k", ["b"], ["a"], watch=watch)
    gone = {"t": spark.range(0).selectExpr("raise_error('read again') as a")}
    found = [r["failures"] for r in runner.run_checks(gone, suite, watch)]
    assert found == one_by_one(tables, suite)
    assert stored.columns == tables["t"].columns and stored.count() == 7


def test_unwatched_checks_are_counted_from_the_table(spark, tables, tmp_path):
    watch = runner.Watch(SUITE)
    stored = LayerTables(spark, str(tmp_path)).write("silver", "t", tables["t"], watch=watch)
    assert set(watch.failures()) == {i for i, check in enumerate(SUITE) if not check.key}
    assert [r["failures"] for r in runner.run_checks({"t": stored}, SUITE, watch)] == one_by_one(tables, SUITE)
    empty = runner.Watch(SUITE)
    stored = LayerTables(spark, str(tmp_path)).write("silver", "t", tables["t"].limit(0), watch=empty)
    assert [r["failures"] for r in runner.run_checks({"t": stored}, SUITE, empty)] == one_by_one({"t": stored}, SUITE)


# ---- equality by fingerprints -----------------------------------------------


def test_one_changed_row_in_a_million(spark, values):
    a = spark.range(1_000_000).select("id", (F.col("id") % 7).alias("v"))
    b = a.withColumn("v", F.when(F.col("id") == 777, F.lit(-1)).otherwise(F.col("v")))
    found = fingerprint.differing_buckets(*fingerprint.alike(a, b, a.columns))
    assert 1 <= len(found) <= 2
    assert fingerprint.rows_of(a, found).count() < 2000  # all that is compared row by row
    assert values(c.equality(a, b)) == [("a_minus_b", 777, 0, 1), ("b_minus_a", 777, -1, 1)]


def test_equal_tables_are_not_compared_row_by_row(spark):
    a = spark.range(1000).select("id", F.lit("x").alias("s"))
    same = c.equality(a, a.orderBy(F.desc("id")), multiset=True)
    assert same.count() == 0
    assert "LocalTableScan <empty>" in same._jdf.queryExecution().optimizedPlan().toString() or "Range" not in same._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("buckets", [1, 2, 64])
def test_fingerprints_tell_what_plain_grouping_tells(frame, values, buckets):
    nan = float("nan")
    schema = "i int, d double, t array<string>, s struct<x:int,y:int>"
    a = frame(
        schema, (1, 0.0, ["a, b"], (None, 1)), (None, 1.0, None, None), (2, nan, [None, "a"], (1, 1)), (2, nan, [None, "a"], (1, 1)), (3, 1.0, [], (1, 2))
    )
    b = frame(
        schema, (1, -0.0, ["a", "b"], (None, 1)), (None, 1.0, None, None), (2, nan, [None, "a"], (1, 1)), (2, nan, ["a", None], (1, 1)), (3, 1.0, [], (2, 1))
    )
    rows = values(c.equality(a, b, buckets=buckets))
    assert [(r[0], r[1]) for r in rows] == [("a_minus_b", 1), ("a_minus_b", 3), ("b_minus_a", 1), ("b_minus_a", 2), ("b_minus_a", 3)]
    assert c.equality(a, b, ["i", "d"], buckets=buckets).count() == 0
    assert c.equality(a, b, multiset=True, buckets=buckets).count() == 6
    assert c.equality(a, a, buckets=buckets).count() == 0


def test_types_meet_as_in_a_union(frame, values):
    a, b = frame("n int", (1,), (2,)), frame("n bigint", (2,), (1,))
    assert c.equality(a, b).count() == 0
    assert values(c.equality(a, frame("n bigint", (1,)))) == [("a_minus_b", 2, 1)]
