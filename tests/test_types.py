import pytest
from pyspark.sql import functions as F

from sparkwright.operators import agg, distinct, types


def test_type_plan_and_apply(spark):
    df = spark.createDataFrame(
        [(1, -5, 0.5, 1e300, "a", "x1", "z"), (200, 7, 0.25, 2.0, "a", "x2", "z"),
         (60000, 100, None, 3.0, None, "x3", "z"), (7, 0, 1.0, 4.0, "b", "x4", "z")],
        "u long, s long, f double, big double, cat string, uniq string, low string")
    plan = {r["column_name"]: (r["after"], r["spark_type"]) for r in types.type_plan(df).collect()}
    assert plan == {"u": ("uint16", "int"), "s": ("int64", "tinyint"), "f": ("float32", "float"),
                    "big": ("float64", "double"), "cat": ("object", "string"),
                    "uniq": ("object", "string"), "low": ("category", "string+code")}
    out = types.apply_types(df, [(k, v[1]) for k, v in plan.items()])
    assert dict(out.dtypes) == {"u": "int", "s": "tinyint", "f": "float", "big": "double",
                                "cat": "string", "uniq": "string", "low": "string"}
    assert sorted(r["u"] for r in out.collect()) == [1, 7, 200, 60000]
    st = {r["column_name"]: r for r in types.column_stats(df).collect()}
    assert st["f"]["f32_exact"] is True and st["big"]["f32_exact"] is False
    assert st["cat"]["n_nulls"] == 1 and st["cat"]["n_distinct"] == 2 and st["uniq"]["bytes"] == 8
    assert st["u"]["bytes"] == 32 and st["u"]["min_value"] == 1.0 and st["u"]["max_value"] == 60000.0


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    got = [(r["c"], r["c_code"]) for r in types.category_codes(df, ["c"]).orderBy(F.col("c").asc_nulls_first()).collect()]
    assert got == [(None, -1), ("a", 0), ("b", 1), ("b", 1)]


def test_unsigned_bounds_are_exact(spark):
    top = (1 << 63) - 1
    df = spark.createDataFrame([(5_000_000_000, top - 1, 1 << 53, -1, None), (1, top, (1 << 53) + 1, 0, None)],
                               "u64 long, top long, odd long, neg long, none long")
    plan = {r["column_name"]: r["after"] for r in types.type_plan(df).collect()}
    assert plan == {"u64": "uint64", "top": "uint64", "odd": "uint64", "neg": "int64", "none": "int64"}
    st = {r["column_name"]: (r["min_int"], r["max_int"]) for r in types.column_stats(df).collect()}
    assert st["top"] == (top - 1, top) and st["odd"] == (1 << 53, (1 << 53) + 1)


def test_rewritten_table_has_category_codes(spark):
    df = spark.createDataFrame([(k, "ab"[k % 2] if k else None) for k in range(10)], "k long, c string")
    plan = [(r["column_name"], r["spark_type"]) for r in types.type_plan(df).collect()]
    out = types.apply_types(df, plan, categories=True)
    assert dict(out.dtypes) == {"k": "tinyint", "c_code": "int"}
    assert {r["k"]: r["c_code"] for r in out.collect()} == {0: -1} | {k: k % 2 for k in range(1, 10)}


def _mixed(spark, n=3000):
    return spark.range(n).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 50).alias("some"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") % 3 == 0, -0.0).when(F.col("id") % 3 == 1, 0.0).otherwise(float("nan")).alias("zero"),
        F.concat(F.lit("long text " * 6), (F.col("id") % 400).cast("string")).alias("text"), (F.col("id") % 2 == 0).alias("flag"),
        (F.col("id") / 8).cast("decimal(20,3)").alias("money"), F.timestamp_seconds(F.col("id") % 90).alias("at"),
        F.array(F.col("id") % 5, F.lit(None)).alias("list"), F.col("id").alias("a.b"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 11).cast("int")).alias("day"))


@pytest.mark.parametrize("parts", [1, 7])
def test_distinct_counts_equal_count_distinct(spark, parts):
    df = _mixed(spark).repartition(parts)
    got = {r["column_name"]: (r["n_distinct"], r["n_null"]) for r in distinct.distinct_counts(df).collect()}
    for c in df.columns:
        want = df.agg(F.count_distinct(F.col(f"`{c}`")), F.max(F.col(f"`{c}`").isNull().cast("int"))).first()
        assert got[c] == tuple(want), c
    row = agg.n_distinct_all(df).first()
    assert [row[c] for c in df.columns] == [sum(got[c]) for c in df.columns]
    assert agg.n_distinct_all(df.limit(0)).first()["some"] == 0
    assert distinct.distinct_counts(df.limit(0), ["some", "none"]).count() == 2


def test_distinct_counts_expand_nothing(spark):
    for frame in (agg.n_distinct_all(_mixed(spark)), types.column_stats(_mixed(spark).drop("list"))):
        assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_to_the_union(spark):
    df = spark.range(60_000).select((F.col("id") % 12).alias("month"), (F.col("id") * 7 % 20_011).alias("many"),
                                    F.when(F.col("id") % 5 > 0, (F.col("id") % 9).cast("string")).alias("few"))
    stored = distinct.sketches(df, "month").cache()
    whole = {r["column_name"]: r["n_distinct"] for r in distinct.merged(stored).collect()}
    assert abs(whole["many"] - 20_011) < 0.03 * 20_011 and whole["few"] == 9
    half = distinct.merged(stored.where("month < 6")).where("column_name = 'many'").first()["n_distinct"]
    exact = df.where("month < 6").select("many").distinct().count()
    assert abs(half - exact) < 0.03 * exact
    by = {r["month"]: r["n_distinct"] for r in distinct.merged(stored, "month").where("column_name = 'many'").collect()}
    assert len(by) == 12 and all(abs(n - 5000) < 200 for n in by.values())
    stored.unpersist()
