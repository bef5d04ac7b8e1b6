import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import agg, stats, windows


def _hexbin_numpy(x, y, gridsize, mincnt):
    """Cell counts by the documented two-lattice rule (reference for the test)."""
    nx, ny = gridsize, int(gridsize / math.sqrt(3))
    xmin, xmax, ymin, ymax = x.min(), x.max(), y.min(), y.max()
    pad = 1e-9 * (xmax - xmin)
    xmin, xmax = xmin - pad, xmax + pad
    sx, sy = (xmax - xmin) / nx, (ymax - ymin) / ny
    ix, iy = (x - xmin) / sx, (y - ymin) / sy
    ix1, iy1 = np.round(ix), np.round(iy)
    ix2, iy2 = np.floor(ix), np.floor(iy)
    d1 = (ix - ix1) ** 2 + 3.0 * (iy - iy1) ** 2
    d2 = (ix - ix2 - 0.5) ** 2 + 3.0 * (iy - iy2 - 0.5) ** 2
    first = d1 < d2
    c = Counter()
    for i in range(len(x)):
        if first[i]:
            a, b = int(ix1[i]), int(iy1[i])
            if 0 <= a <= nx and 0 <= b <= ny:
                c[(1, a, b)] += 1
        else:
            a, b = int(ix2[i]), int(iy2[i])
            if 0 <= a < nx and 0 <= b < ny:
                c[(2, a, b)] += 1
    return {k: v for k, v in c.items() if v >= mincnt}


def test_hexbin_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=5000), rng.normal(size=5000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    got = {(r["lattice"], r["ix"], r["iy"]): r["n"] for r in stats.hexbin(df, "x", "y", 20, 7).collect()}
    assert got == _hexbin_numpy(x, y, 20, 7)


def test_pivot_takes_first_value_by_order(spark):
    rows = [("c1", "d1", "f.a", "3", 2, 9), ("c1", "d1", "f.a", "1", 1, 5), ("c1", "d1", "f.b", "7", 1, 1),
            ("c2", "d1", "f.b", "4", 5, 2)]
    df = spark.createDataFrame(rows, "cust string, dt string, feature string, value string, t long, id long")
    p = df.withColumn("feature", F.translate("feature", ".", "_")).withColumn("value", F.col("value").cast("double")) \
        .groupBy("cust", "dt").pivot("feature").agg(windows.first_by_order("value", ["t", "id"]))
    got = {r["cust"]: (r["f_a"], r["f_b"]) for r in p.collect()}
    assert got == {"c1": (1.0, 7.0), "c2": (None, 4.0)}


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.5, 2.5, 3.5, -2.5, 2.4999)], "v double")
    assert [r[0] for r in df.select(scalar.round_half_even("v")).collect()] == [0.0, 2.0, 2.0, 4.0, -2.0, 2.0]


def test_n_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "b")], "x int, s string")
    r = agg.n_distinct_all(df).collect()[0]
    assert (r["x"], r["s"]) == (3, 3)


def test_describe_strings_top_ties_to_smallest(spark):
    rnd = random.Random(0)
    vals = ["b"] * 5 + ["a"] * 5 + ["c"] * 2 + [None]
    rnd.shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    r = stats.describe_strings(df, ["s"]).collect()[0]
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (12, 3, "a", 5)


def test_schema_helpers_and_small_functions(spark):
    from sparkwright.operators import joins, types
    df = spark.createDataFrame([(20180102, True, 1.5, "x")], "`Game Date` int, alone boolean, f double, s string")
    clean = scalar.clean_names(df)
    assert clean.columns == ["game_date", "alone", "f", "s"]
    assert scalar.select_by_type(clean, ["int", "double"]) == ["game_date", "f"]
    r = clean.select(scalar.int_date("game_date").alias("d"), scalar.recode_bool("alone").alias("a")).collect()[0]
    assert str(r["d"]) == "2018-01-02" and r["a"] == 1
    st = {row["column_name"]: row["data_type"] for row in joins.schema_table(clean).collect()}
    assert st == {"game_date": "int", "alone": "boolean", "f": "double", "s": "string"}
    after = clean.withColumn("f", F.col("f").cast("float"))
    cmp = {row["column_name"]: (row["before"], row["after"]) for row in joins.compare_types(clean, after).collect()}
    assert cmp["f"] == ("double", "float") and cmp["s"] == ("string", "string")
    tc = {row["data_type"]: row["count"] for row in types.type_counts(clean).collect()}
    assert tc == {"int": 1, "boolean": 1, "double": 1, "string": 1}


def test_customers_are_joined_with_all_their_orders(spark, tmp_path):
    from sparkwright.plans import format_jobs
    spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, "C")], "c_custkey long, c_mktsegment string") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, None)], "o_orderkey long, o_custkey long") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    got = format_jobs.customers_without_orders(spark, str(tmp_path)).collect()
    assert {(r.c_mktsegment, r.n_rows, r.n_kept) for r in got} == {("A", 4, 4), ("B", 1, 1), ("C", 1, 0)}


def test_sessionize_splits_a_hot_day(spark, monkeypatch):
    from collections import Counter

    from sparkwright.operators import windows
    from sparkwright.plans import shape_jobs
    from tests.conftest import SF001
    used, plain = [], windows.sessionize
    monkeypatch.setattr(shape_jobs.windows, "sessionize", lambda *a, bucket_seconds: used.append(bucket_seconds) or plain(
        *a, bucket_seconds=bucket_seconds))
    split = Counter(map(tuple, shape_jobs.sessionize(spark, SF001).collect()))
    assert used[0] and used[0] < 86_400
    monkeypatch.setattr(shape_jobs.windows, "sessionize", lambda *a, bucket_seconds: plain(*a, bucket_seconds=None))
    assert split == Counter(map(tuple, shape_jobs.sessionize(spark, SF001).collect()))
