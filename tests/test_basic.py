from pyspark.sql import functions as F

from sparkwright.operators import agg, joins, topk
from sparkwright.functions import scalar


def test_count_min_max_sum(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), ("b", 2.0)], "k string, v double")
    assert {r["k"]: r["count"] for r in agg.count_values(df, "k").collect()} == {"a": 2, "b": 2}
    assert {r["k"]: r["m"] for r in agg.min_by_key(df, "k", "v", "m").collect()} == {"a": 1.0, "b": 2.0}
    assert {r["k"]: r["m"] for r in agg.max_by_key(df, "k", "v", "m").collect()} == {"a": 3.0, "b": 2.0}
    s = {r["k"]: (r["t"], r["n"]) for r in agg.sum_by_key(df, "k", "v", "t", "n").collect()}
    assert s == {"a": (4.0, 2), "b": (2.0, 1)}


def test_int_mean_truncates_toward_zero(spark):
    df = spark.createDataFrame([("a", 3), ("a", 4), ("b", -3), ("b", -4), ("c", None)], "k string, v int")
    got = {r["k"]: r["m"] for r in agg.int_mean(df, "k", "v", "m").collect()}
    assert got == {"a": 3, "b": -3, "c": None}


def test_max_row_ties_go_to_larger_id(spark):
    df = spark.createDataFrame([(5, 1), (5, 9), (4, 20)], "n int, id int")
    r = agg.max_row(df, ["n", "id"]).collect()[0]
    assert (r["n"], r["id"]) == (5, 9)


def test_top_k_is_take_ordered(spark):
    df = spark.range(100).withColumn("n", F.col("id") % 7)
    out = topk.top_k(df, ["n"], 3, tie_break=["id"])
    assert [r["id"] for r in out.collect()] == [6, 13, 20]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_with_names_missing_modes(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (3, None)], "k int, name string")
    assert sorted(r["name"] or "" for r in joins.with_names(df, dim, "k", "name").collect()) == ["", "one"]
    assert joins.with_names(df, dim, "k", "name", missing="drop").count() == 1
    ok = spark.createDataFrame([(1,), (3,)], "k int")
    assert sorted((r["k"], r["name"]) for r in joins.with_names(ok, dim, "k", "name", missing="error").collect()) \
        == [(1, "one"), (3, None)]
    try:
        joins.with_names(df, dim, "k", "name", missing="error").collect()
        raise AssertionError("expected failure")
    except Exception as e:  # noqa: BLE001
        assert "no name for k=2" in str(e)


def test_split_matched_counts_null_owner_as_missing(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, owner string")
    right = spark.createDataFrame([(1, "a"), (2, None)], "id int, owner string")
    j = joins.left_join_suffixed(left, right, "id")
    assert set(j.columns) == {"id", "owner_x", "owner_y"}
    m, miss = joins.split_matched(j, "owner_y")
    assert [r["id"] for r in m.collect()] == [1]
    assert sorted(r["id"] for r in miss.collect()) == [2, 3]


def test_java_split_semantics(spark):
    df = spark.createDataFrame([("a b  ",), ("hi, you!",), ("",), (",,,",), (" x",)], "s string")
    sp = [r[0] for r in df.select(scalar.java_split("s", " ")).collect()]
    assert sp == [["a", "b"], ["hi,", "you!"], [""], [",,,"], ["", "x"]]
    w = [r[0] for r in df.select(scalar.java_split("s", r"\W+")).collect()]
    assert w == [["a", "b"], ["hi", "you"], [""], [], ["", "x"]]
    more = spark.createDataFrame([(x,) for x in ["a b  ", "hi, you!", "", ",,,", " x", ",x,", "  ", "a  b"]],
                                 "s string")
    for sep in (" ", r"\W+"):
        slow = [r[0] for r in more.select(scalar.java_split("s", sep)).collect()]
        fast = [r[0] for r in more.select(scalar.java_split_fast(F.col("s"), F.split("s", sep), sep)).collect()]
        assert fast == slow, sep


def test_null_safe_helpers(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 3)], "a int, b int")
    out = df.select(scalar.greatest_strict("a", 2).alias("g"),
                    scalar.not_equal_null_safe("a", "b").alias("ne"),
                    joins.agree_flag(F.col("a"), F.col("b")).alias("ag")).collect()
    assert [tuple(r) for r in out] == [(2, True, 0), (None, True, 0), (3, False, 1)]
    assert scalar.exclude_where(spark.createDataFrame([(True,), (False,), (None,)], "f boolean"),
                                F.col("f")).count() == 2
