from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.operators import ranges, shape
from fiscalmill.operators.dedup import deduplicate
from fiscalmill.operators.periods import with_growth, with_previous_period
from fiscalmill.operators.pivot import column_values, get_column_values, pivot, slugify, unpivot
from fiscalmill.operators.series import date_spine, generate_series
from fiscalmill.operators.small import checked_broadcast
from fiscalmill.operators.union import relations_by_pattern, relations_by_prefix, union_relations


def test_deduplicate(frame, values):
    df = frame("user_id int, event string, version int", (1, "play", 1), (1, "play", 2), (2, "pause", 1))
    assert values(deduplicate(df.filter("user_id = 1"), ["user_id"], [F.desc("version")])) == [(1, "play", 2)]
    plan = deduplicate(df, ["user_id"], [F.desc("version")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once before the shuffle


T1 = ("id int, name string, favorite_number string", (1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4"))
T2 = ("id int, favorite_color string, favorite_number string", (1, "green", "7"), (2, "pink", "13"))


def test_union(frame, values):
    tables = {"t1": frame(*T1), "t2": frame(*T2)}
    whole = union_relations(tables)
    assert whole.columns == ["_dbt_source_relation", "id", "name", "favorite_number", "favorite_color"]
    rows = values(whole.select("id", "name", "favorite_color", "favorite_number"))
    assert rows == [
        (1, None, "green", "7"), (1, "drew", None, "pi"), (2, None, "pink", "13"), (2, "bob", None, "e"), (3, "alice", None, "4"),
    ]
    assert union_relations(tables, exclude=["NAME"], source_column_name=None).columns == ["id", "favorite_number", "favorite_color"]
    assert union_relations(tables, include=["Id"], source_column_name="src").columns == ["src", "id"]
    assert values(union_relations(tables, where="id = 1", include=["id"], source_column_name=None)) == [(1,), (1,)]
    assert union_relations(tables, column_override={"id": "bigint"}).schema["id"].dataType.simpleString() == "bigint"
    with pytest.raises(ValueError):
        union_relations(tables, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        union_relations(tables, include=["nothing"])


def test_relations_by_pattern(spark, frame):
    for i, day in enumerate(("20180101", "20180102", "20180103")):
        frame("user_id int, event string", (2 * i + 1, "play"), (2 * i + 2, "pause")).createOrReplaceTempView(f"data_events_{day}")
    found = relations_by_pattern(spark, None, "DATA_EVENTS_%")
    assert union_relations(found).count() == 6
    assert list(relations_by_pattern(spark, None, "data_events_%", exclude="%03")) == ["data_events_20180101", "data_events_20180102"]
    assert len(relations_by_prefix(spark, None, "data_events_2018010")) == 3
    spark.sql("create database if not exists pattern_db")
    frame("a int", (1,)).write.mode("overwrite").saveAsTable("pattern_db.data_events_x")
    assert list(relations_by_pattern(spark, "pattern%", "data_events_%")) == ["pattern_db.data_events_x"]


def test_pivot(frame, values):
    df = frame("size string, color string", ("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red"))
    assert values(df.groupBy("size").agg(*pivot("color", ["red", "blue"]))) == [("M", 1, 0), ("S", 1, 1)]
    named = df.groupBy("size").agg(*pivot("color", ["red", "blue", "blue's"], quote_identifiers=False))
    assert named.columns == ["size", "red", "blue", "blues"]
    assert values(named) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    odd = df.groupBy("size").agg(*pivot("color", ["red"], agg="max", cmp="!=", prefix="not ", suffix="?", then_value=5, else_value=-5))
    assert odd.columns == ["size", "not red?"] and values(odd) == [("M", -5), ("S", 5)]


def test_slugify():
    assert slugify("!Hell0 world-hi") == "hell0_world_hi"
    assert slugify("0Hell0 world-hi") == "_0hell0_world_hi"


def test_column_values(frame):
    df = frame("field string, side string", *[(x, "left" if x in "aceg" else "right") for x in "abcdefggggg"])
    assert get_column_values(df, "field")[0] == "g"
    assert get_column_values(df, "field", order_by=[F.col("value")]) == list("abcdefg")
    assert get_column_values(df, "field", order_by=[F.col("value")], where="side = 'left'") == list("aceg")
    assert get_column_values(df, "field", max_records=2) == ["g", "a"]
    assert get_column_values(df, "field", where="false", default=["z"]) == ["z"]
    assert get_column_values(None, "field", default=[]) == []
    assert [tuple(r) for r in column_values(df, "field", max_records=1).collect()] == [("g", 5)]
    with pytest.raises(ValueError):
        get_column_values(None, "field")


def test_unpivot(frame, values):
    df = frame(
        "customer_id int, created_at string, status string, segment string, is_updated boolean, name string",
        (123, "2017-01-01", "active", "tier 1", True, "n1"), (234, "2017-02-01", "active", "tier 3", False, "n2"),
        (567, "2017-03-01", "churned", "tier 2", None, "n3"),
    )
    melted = unpivot(df, exclude=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert melted.columns == ["customer_id", "created_at", "prop", "val"]
    rows = values(melted)
    assert len(rows) == 9
    assert (567, "2017-03-01", "is_updated", None) in rows and (123, "2017-01-01", "is_updated", "true") in rows


def test_star_and_nullcheck(frame, values):
    df = frame("field_1 string, field_2 string, field_3 int", ("a", "", 1), ("", "b", 2), ("", "", 3))
    assert df.select(*shape.star(df, ["FIELD_3"], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s"]
    assert shape.filtered_columns(df, ["field_1"]) == ["field_2", "field_3"]
    assert values(shape.nullcheck_table(df)) == [(None, None, 3), (None, "b", 2), ("a", None, 1)]
    grouped = frame("g1 string, g2 string, v int", ("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4))
    assert values(shape.group_by_n(grouped, 2).agg(F.sum("v"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    with pytest.raises(ValueError):
        shape.group_by_n(grouped, 9)


def test_single_values_and_arrays(frame):
    df = frame("col_1 int, col_2 string, col_3 boolean", (1, "a", True), (2, "b", False), (3, "c", None))
    assert shape.results_as_dict(df, [F.col("col_1")]) == {"col_1": [1, 2, 3], "col_2": ["a", "b", "c"], "col_3": [True, False, None]}
    with pytest.raises(Exception, match="more than 2 rows"):
        shape.results_as_arrays(df, [F.col("col_1")], max_rows=2).collect()
    one = df.filter("col_1 = 3")
    assert shape.get_single_value(one.select("col_2")) == "c"
    assert shape.get_single_value(df.filter("false"), default="none") == "none"
    assert shape.single_value(one.select("col_3"), "x", default=True).collect()[0][0] is None
    assert shape.single_value(one.filter("false").select("col_3"), "x", default=True).collect()[0][0] is True


def test_series(spark, values):
    assert [r[0] for r in generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        generate_series(spark, 0)
    days = values(date_spine(spark, "day", date(2018, 1, 1), date(2018, 1, 10)))
    assert days == [(date(2018, 1, d),) for d in range(1, 10)]
    months = values(date_spine(spark, "month", date(2019, 11, 1), date(2020, 3, 1)))
    assert months == [(date(2019, 11, 1),), (date(2019, 12, 1),), (date(2020, 1, 1),), (date(2020, 2, 1),)]
    hours = values(date_spine(spark, "hour", datetime(2020, 1, 1, 22), datetime(2020, 1, 2, 1)))
    assert hours == [(datetime(2020, 1, 1, 22),), (datetime(2020, 1, 1, 23),), (datetime(2020, 1, 2, 0),)]
    assert values(date_spine(spark, "day", date(2018, 1, 2), date(2018, 1, 1))) == []


def test_periods(frame, values):
    df = frame("k int, y bigint, v double", (1, 2000, 10.0), (1, 2002, 20.0), (1, 2003, 0.0), (1, 2004, 5.0))
    grown = with_growth(df, "k", "y", "v", "prev", "rate").select("y", "prev", "rate")
    assert values(grown) == [(2000, None, None), (2002, 10.0, 100.0), (2003, 20.0, -100.0), (2004, 0.0, None)]
    strict = with_growth(df, "k", "y", "v", "prev", "rate", gap_aware=True).select("y", "prev")
    assert values(strict) == [(2000, None), (2002, None), (2003, 20.0), (2004, 0.0)]
    twice = df.union(df.filter("y = 2002"))
    joined = twice.alias("c").join(
        twice.select(F.col("k").alias("pk"), (F.col("y") + 1).alias("py"), F.col("v").alias("before")),
        F.expr("k = pk and y = py"), "left",
    ).select("k", "y", "v", "before")
    assert values(with_previous_period(twice, "k", "y", {"before": "v"})) == values(joined)


# ---- order-aware operators, against plain windows ---------------------------


def skewed(spark, n=4000):
    """A third of the rows in one group, a third of the values equal, some NULLs."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), (F.col("id") % 40).cast("string"))).alias("g"),
        F.when(F.col("id") % 3 == 1, 777).when(F.col("id") % 97 == 0, None).otherwise((F.col("id") * 7919) % 3001).cast("int").alias("a"),
        ((F.col("id") * 31) % 503).cast("int").alias("b"),
        F.when(F.col("id") % 3 == 2, "a rather long and frequent text").otherwise(F.concat(F.lit("text "), ((F.col("id") * 13) % 1009).cast("string"))).alias("t"),
    )
    return rows


ORDERS = [["a", "b", "t", "g"], ["t", "a", "b", "g"], ["b", "a", "t", "g"]]


@pytest.mark.parametrize("order", ORDERS)
def test_dense_ids_match_a_global_window(spark, order, values):
    df = skewed(spark).distinct()
    number = F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])).cast("bigint")
    assert values(ranges.dense_ids(df, order, "id")) == values(df.select(number.alias("id"), *df.columns))


@pytest.mark.parametrize("kind", ["int", "double", "decimal(10,2)", "decimal(30,2)", "date", "timestamp", "timestamp_ntz", "string", "boolean"])
def test_dense_ids_of_every_type(spark, kind, values):
    base = spark.range(500).select(((F.col("id") * 7919) % 499 + 1).cast("int").alias("x"), F.col("id").alias("tie"))
    if kind in ("date", "timestamp", "timestamp_ntz"):
        value = F.expr("timestamp_ntz'1969-12-31 23:59:59' + make_interval(0, 0, 0, x, 0, 0, x / 1000)").cast(kind)
    else:
        value = (F.col("x") % 2).cast(kind) if kind == "boolean" else F.col("x").cast(kind)
    df = base.select(value.alias("x"), "tie")
    number = F.row_number().over(Window.orderBy(F.col("x").asc_nulls_first(), "tie")).cast("bigint")
    assert values(ranges.dense_ids(df, ["x", "tie"], "id")) == values(df.select(number.alias("id"), "x", "tie"))


@pytest.mark.parametrize("groups", [[], ["g"], ["g", "b"]])
@pytest.mark.parametrize("following", [False, True])
def test_neighbours_match_a_window(spark, groups, following, values):
    df = skewed(spark).select("g", "a", "b").distinct()
    near = ranges.with_neighbour(df, groups, ["a", "b"], "near", following)
    window = Window.partitionBy(*groups).orderBy("a", "b")
    # Ties on (a, b) within a group only differ in other columns.
    want = df.withColumn("near", (F.lead if following else F.lag)("a").over(window))
    assert values(near.groupBy(*groups, "a", "near").count()) == values(want.groupBy(*groups, "a", "near").count())


BALANCE = {
    "hot group": (["case when id % 2 = 0 then 'hot' else concat('g', id % 5) end as k", "id as v"], ["k", "v"]),
    "hot text": (["case when id % 2 = 0 then repeat('Customer', 9) else concat('c', id) end as k", "id as v"], ["k", "v"]),
    "shared prefix": (["concat('https://www.example.com/page/', id) as k"], ["k"]),
    "large numbers": (["case when id % 2 = 0 then 9007199254740993 else id end as k", "id as v"], ["k", "v"]),
}


@pytest.mark.parametrize("case", list(BALANCE))
def test_no_part_holds_a_large_share(spark, case):
    columns, order = BALANCE[case]
    parts = ranges.ordered_parts(spark.range(20_000).selectExpr(*columns), order).groupBy("_part").count().collect()
    assert sum(r["count"] for r in parts) == 20_000
    assert max(r["count"] for r in parts) < 2 * 20_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_texts_that_differ_by_a_zero_byte(spark, values):
    df = spark.range(4000).selectExpr("case when id % 2 = 0 then 'a' else concat('a', chr(0)) end as t", "id % 2000 as v", "id")
    number = F.row_number().over(Window.orderBy("t", "v", "id")).cast("bigint")
    assert values(ranges.dense_ids(df, ["t", "v", "id"], "n")) == values(df.select(number.alias("n"), *df.columns))


def test_set_ids(spark, values):
    df = spark.range(50).selectExpr("concat('v', id * 7 % 50) as v")
    assert values(ranges.set_ids(df, "v", "id")) == values(ranges.small_set_ids(df, "v", "id"))


def test_checked_broadcast(spark, values):
    df = spark.range(20)
    assert values(checked_broadcast(df)) == values(df)
    assert checked_broadcast(df, max_rows=5) is df
