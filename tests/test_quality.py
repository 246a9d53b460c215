from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.quality import checks as c
from fiscalmill.quality import runner


def test_row_checks(frame):
    df = frame("id int, a double, b double, s string", (-1, 0.0, 1.0, "x"), (11, 0.5, 0.5, "  "), (None, None, 0.0, None))
    assert c.accepted_range(df, "id", -1, 11).count() == 0
    assert c.accepted_range(df, "id", -1, 11, inclusive=False).count() == 2
    assert c.accepted_range(df, "id", min_value=0).count() == 1
    assert c.accepted_range(df, "id").count() == 0
    assert c.expression_is_true(df, "a + b = 1").count() == 0
    assert c.expression_is_true(df, "= 0.5", "a").count() == 1
    assert c.not_empty_string(df, "s").count() == 1
    assert c.not_empty_string(df, "s", trim_whitespace=False).count() == 0
    assert c.not_null(df, "id").count() == 1
    assert c.assert_equal(df, "a", "b").count() == 1


def test_not_empty_string_must_fail(frame):
    rows = ["not an empty string", "also not", "trailing  ", "   ", "", None]
    assert c.not_empty_string(frame("s string", *[(r,) for r in rows]), "s").count() == 2


def test_value_checks(frame, values):
    df = frame("k int, v string", (1, "a"), (1, "b"), (2, None), (None, "a"), (None, "c"))
    assert values(c.unique(df, "k")) == [(1, 2)]
    assert values(c.unique_combination_of_columns(df, ["k"])) == [(None, 2), (1, 2)]
    assert values(c.accepted_values(df, "v", ["a", "b"])) == [("c", 1)]
    assert values(c.not_accepted_values(df, "v", ["a", "z"])) == [("a",)]
    assert c.has_rows(df).count() == 0 and values(c.has_rows(df.filter("false"))) == [(0,)]
    assert c.at_least_one(df, "v").count() == 0
    assert values(c.at_least_one(df, "v", ["k"])) == [(2, 0)]
    assert c.at_least_one(df.filter("false"), "v").count() == 1
    assert values(c.not_constant(df, "k", ["v"])) == [(None, 1), ("a", 1), ("b", 1)]
    assert c.not_constant(df, "v").count() == 0
    assert values(c.not_null_proportion(df, "v", 0.9)) == [(0.8,)]
    assert c.not_null_proportion(df, "v", 0.8, 0.8).count() == 0
    assert values(c.not_null_proportion(df, "v", 0.5, group_by=["k"])) == [(2, 0.0)]
    assert c.not_null_proportion(df.filter("false"), "v", 0.5).count() == 0


def test_recency(frame, values):
    df = frame("g int, at timestamp", (1, datetime(2024, 1, 9)), (1, datetime(2024, 1, 3)), (2, datetime(2024, 1, 1)))
    now = datetime(2024, 1, 10, 12)
    assert c.recency(df, "at", "day", 2, now).count() == 0
    assert [r["g"] for r in c.recency(df, "at", "day", 2, now, group_by=["g"]).collect()] == [2]
    assert c.recency(df, "at", "day", 1, now).count() == 1  # midnight of yesterday is too old …
    assert c.recency(df, "at", "day", 1, now, ignore_time_component=True).count() == 0  # … unless only days count


def test_table_comparisons(frame, values):
    a = frame("same_name int", (1,), (2,), (3,))
    b = frame("same_name int, different_name int", (1, 2), (2, 3), (3, 1))
    assert c.cardinality_equality(a, "same_name", b, "different_name").count() == 0
    assert values(c.cardinality_equality(a.union(a.filter("same_name = 1")), "same_name", b, "same_name")) == [(1, 1), (1, 2)]
    t1 = frame("g int, f int", (1, 1), (1, 2), (1, 3), (None, 4))
    t2 = frame("g int, f int", (1, 1), (1, 2), (1, 3), (1, 4), (2, 5))
    assert c.equal_rowcount(t1, t1, ["g"]).count() == 0
    assert values(c.equal_rowcount(t1, t2, ["g"])) == [(None, 1, 0, 1), (1, 3, 4, 1), (2, 0, 1, 1)]
    assert c.fewer_rows_than(t1, t2).count() == 0
    assert values(c.fewer_rows_than(t2, t1).select("row_count_delta")) == [(1,)]
    assert values(c.fewer_rows_than(t1, t1).select("row_count_delta")) == [(1,)]
    assert values(c.equality(t1, t2, ["g"])) == [("a_minus_b", None, 1), ("b_minus_a", 2, 1)]
    assert c.equality(t1, t1.union(t1)).count() == 0
    assert c.equality(t1, t1.union(t1), multiset=True).count() == 4
    assert c.columns_match_set(t1, ["G", "F"]).count() == 0
    assert values(c.columns_match_set(t1, ["g", "h"])) == [("f", "unexpected"), ("h", "missing")]


def test_relationships(frame, values):
    child, parent = frame("id int", (1,), (2,), (4,), (4,), (None,)), frame("id int", (1,), (2,), (3,))
    assert values(c.relationships(child, "id", parent, "id")) == [(4, 2)]
    assert c.relationships_where(child, "id", parent, "id", from_condition="id <> 4").count() == 0
    assert values(c.relationships_where(child, "id", parent, "id", "id <> 4", "id <> 1")) == [(1, 1)]


def test_relationships_fold_before_the_join(spark):
    child, parent = spark.range(100).selectExpr("id % 7 as k"), spark.range(5)
    plan = c.relationships(child, "k", parent, "id")._jdf.queryExecution().optimizedPlan().toString()
    join, fold = plan.index("Join LeftOuter"), plan.index("Aggregate [k")
    assert join < fold  # the tree prints the join above its inputs


def test_ranges_golden(frame):
    df = frame("l int, u int", (0, 1), (1, 2), (2, 4))
    assert c.mutually_exclusive_ranges(df, "l", "u", gaps="not_allowed").count() == 0
    assert c.mutually_exclusive_ranges(df, "l", "u", gaps="required").count() == 2
    with_gaps = frame(
        "s int, f string, t string", (1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"),
        (2, "2019-05-06", "2019-07-02"), (2, "2019-07-03", None),
    )
    bounds = ("cast(f as date)", "coalesce(cast(t as date), date'2099-01-01')", ["s"])
    for gaps in ("allowed", "required"):
        assert c.mutually_exclusive_ranges(with_gaps, *bounds, gaps=gaps).count() == 0
    assert c.mutually_exclusive_ranges(with_gaps, *bounds, gaps="not_allowed").count() == 2
    assert c.mutually_exclusive_ranges(with_gaps, "f", "t", ["s"]).count() == 1  # the NULL bound
    zero = frame("s int, f int, t int", (3, 506, 507), (3, 508, 510), (3, 508, 508), (3, 512, 515), (4, 608, 608), (4, 606, 607))
    assert c.mutually_exclusive_ranges(zero, "f", "t", ["s"], zero_length_range_allowed=True).count() == 0
    assert c.mutually_exclusive_ranges(zero, "f", "t", ["s"]).count() == 2
    with pytest.raises(ValueError):
        c.mutually_exclusive_ranges(df, "l", "u", gaps="maybe")


def test_sequential_golden(frame, values):
    df = frame("g int, n int", (1, 2), (1, 4), (1, 6), (2, 8), (2, 10))
    assert c.sequential_values(df, "n", 2).count() == 0
    assert c.sequential_values(df, "n", 2, group_by=["g"]).count() == 0
    assert values(c.sequential_values(df.filter("n <> 4"), "n", 2)) == [(6, 2, 1)]
    assert values(c.sequential_values(df.union(df), "n", 2)) == [(n, n, 1) for n in (10, 2, 4, 6, 8)]
    times = frame("t timestamp", *[(datetime(2021, 1, 1, h),) for h in range(4)])
    assert c.sequential_values(times, "t", 1, "hour").count() == 0
    assert c.sequential_values(times, "t", 1, "day").count() == 3


@pytest.mark.parametrize("groups", [[], ["g"]])
def test_ordered_checks_on_skewed_data(spark, groups, values):
    """A third of the rows in one group and a third with one value."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 90).alias("g"),
        F.when(F.col("id") % 3 == 1, 50).otherwise((F.col("id") * 7919) % 1999).alias("v"),
    )
    window = Window.partitionBy(*groups).orderBy("v")
    want = df.withColumn("p", F.lag("v").over(window)).filter("not (v = p + 1)").groupBy(*groups, "v", "p").count()
    assert values(c.sequential_values(df, "v", group_by=groups)) == values(want)

    spans = df.select("g", "v", (F.col("v") + F.col("g") % 3).alias("e"))
    following = F.lead("v").over(Window.partitionBy(*groups).orderBy("v", "e"))
    rows = spans.withColumn("nxt", following)
    bad = rows.filter("not (v < e and coalesce(e <= nxt, nxt is null))").groupBy(*groups, "v", "e", "nxt").count()
    assert values(c.mutually_exclusive_ranges(spans, "v", "e", groups)) == values(bad)


def test_runner(frame):
    tables = {
        "t": frame("id int, v string", (1, "a"), (1, ""), (None, "b")),
        "p": frame("id int", (2,)),
        "empty": frame("id int"),
    }
    suite = [
        runner.not_null("t", "id"),
        runner.not_null("t", "id", where="v = 'a'"),
        runner.not_empty_string("t", "v", severity="warn"),
        runner.unique("t", "id"),
        runner.relationships("t", "id", "p", "id", severity="warn"),
        runner.has_rows("empty"),
        runner.has_rows("t"),
        runner.equal_rowcount("t", "p"),
        runner.equality("t", "p", ["id"]),
        runner.accepted_values("t", "v", ["a"], error_if=(">", 5)),
        runner.expression_is_true("t", "id = 0", error_if=("<", 1)),
    ]
    results = runner.run_checks(tables, suite)
    assert [r["failures"] for r in results] == [1, 0, 1, 1, 2, 1, 0, 2, 4, 2, 2]
    assert [r["status"] for r in results] == [
        "error", "pass", "warn", "error", "warn", "error", "pass", "error", "error", "warn", "warn",
    ]
    assert suite[0].rows(tables).count() == 1
    assert suite[3].warn().severity == "warn"
    with pytest.raises(runner.QualityError, match="not_null"):
        runner.gate("silver", tables, suite)
    assert runner.gate("silver", tables, [suite[1], suite[2]])[1]["status"] == "warn"


def test_row_checks_share_one_scan(frame):
    tables = {"t": frame("a int, b int", (1, 2))}
    suite = [runner.not_null("t", "a"), runner.not_null("t", "b"), runner.accepted_range("t", "a", 0, 1)]
    plan = runner.failure_counts(tables, suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 1
