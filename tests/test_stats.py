import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkwright.operators import interpolate, quantiles as Q, stats


def test_quantiles_hot_group_many_pieces_match_numpy(spark):
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 400))) for _ in range(4000)]
    rows += [(f"g{i % 5}", float(rnd.gauss(0, 10))) for i in range(500)] + [("one", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.1]
    got = {r["g"]: [r[f"q{i}"] for i in range(len(probs))] + [r["n"]]
           for r in Q.quantiles(df, ["g"], "v", probs, partitions=13).collect()}
    for g in {r[0] for r in rows}:
        vals = np.array([v for k, v in rows if k == g])
        exp = list(np.percentile(vals, [p * 100 for p in probs])) + [len(vals)]
        assert np.allclose(got[g], exp, rtol=0, atol=1e-9), g


def test_weighted_quantile_equals_repeated_rows(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 0), (5.0, 2), (7.0, 1)], "v double, w long")
    r = Q.quantiles(df, None, "v", [0.5, 0.3], weight="w").collect()[0]
    exp = np.percentile([1, 1, 1, 5, 5, 7], [50, 30])
    assert np.allclose([r["q0"], r["q1"]], exp)


def test_positions_and_dense_codes(spark):
    df = spark.createDataFrame([(i, ["b", "a", None, "c"][i % 4]) for i in range(40)], "id long, s string")
    pos = {r["id"]: r["pos"] for r in Q.positions(df, ["id"], partitions=7).collect()}
    assert pos == {i: i for i in range(40)}
    codes = {(r["s"], r["code"]) for r in Q.dense_codes(df, "s", partitions=3).collect()}
    assert codes == {("a", 0), ("b", 1), ("c", 2), (None, -1)}


def test_histogram_counts_and_density(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]], "v double")
    h = stats.histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in h] == [2, 2, 2, 2, 3]
    assert abs(sum(r["density"] * (r["hi"] - r["lo"]) for r in h) - 1.0) < 1e-12


def test_boxplot_whiskers_and_outliers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 100.0]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v double")
    b = stats.boxplot_stats(df, "g", "v").collect()[0]
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (b["q1"], b["med"], b["q3"]) == (q1, med, q3)
    assert b["whislo"] == 1.0 and b["whishi"] == 6.0
    assert [r["v"] for r in stats.boxplot_outliers(df, "g", "v").collect()] == [100.0]


def test_spline_reproduces_cubic_and_knots():
    xk = np.array([0.0, 1.0, 2.5, 3.0, 4.5, 6.0])
    f = lambda x: 0.5 * x ** 3 - 2 * x ** 2 + x - 3
    xq = np.linspace(0, 6, 25)
    assert np.allclose(interpolate._spline_eval(xk, f(xk), xq), f(xq))
    ys = np.cos(-xk ** 2 / 9.0)
    assert np.allclose(interpolate._spline_eval(xk, ys, xk), ys)


def test_spline_solver_matches_a_dense_solve():
    gen = np.random.default_rng(1)
    for n in (4, 5, 9, 64, 1000):
        xk = np.cumsum(gen.uniform(0.1, 2, n))
        yk = gen.normal(size=n)
        h = np.diff(xk)
        a, rhs = np.zeros((n, n)), np.zeros(n)
        for i in range(1, n - 1):
            a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
            rhs[i] = 6 * ((yk[i + 1] - yk[i]) / h[i] - (yk[i] - yk[i - 1]) / h[i - 1])
        a[0, :3] = h[1], -(h[0] + h[1]), h[0]
        a[-1, -3:] = h[-1], -(h[-2] + h[-1]), h[-2]
        m = np.linalg.solve(a, rhs)
        mids = (xk[:-1] + xk[1:]) / 2
        want = (yk[:-1] + yk[1:]) / 2 - h ** 2 * (m[:-1] + m[1:]) / 16
        assert np.allclose(interpolate._spline_eval(xk, yk, mids), want, atol=1e-8)


def test_spline_edges(spark):
    k = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.0, 2.0), ("a", 1.0, 4.0), ("a", None, 9.0), ("a", 2.0, None),
                               ("b", 5.0, 7.0), (None, 0.0, 0.0), (None, 1.0, 1.0)], "s string, x double, y double")
    q = spark.createDataFrame([("a", 0.5), ("a", None), ("a", 3.0), ("b", 5.0), ("c", 1.0), (None, 0.25)],
                              "s string, x double")
    got = {(r["s"], r["x"]): r["y"] for r in interpolate.interpolate_cubic(k, q, "s", "x", "y").collect()}
    got = {k: v if v is None else round(v, 12) for k, v in got.items()}
    assert got == {("a", 0.5): 2.0, ("a", None): None, ("a", 3.0): None, ("b", 5.0): 7.0, ("c", 1.0): None,
                   (None, 0.25): 0.25}


def _cubic_values(spark, knots, queries, partitions):
    k = spark.createDataFrame(knots, "s string, x double, y double").repartition(3)
    q = spark.createDataFrame(queries, "s string, x double").repartition(2)
    return {(r["s"], r["x"]): r["y"] for r in interpolate.interpolate_cubic(k, q, "s", "x", "y", partitions).collect()}


@pytest.mark.parametrize("partitions", [1, 2, 5, 16, 64])
def test_spline_over_partitions_equals_one_solve(spark, partitions):
    """Series over many partitions, with runs of one, two, ... knots, of queries alone, and of few knots in all."""
    gen = np.random.default_rng(7)
    knots, queries, want = [], [], {}
    for s, n in (("a", 90), ("b", 4), ("c", 3), ("d", 2), ("e", 1), ("f", 25), ("g", 7), (None, 40)):
        xk = np.cumsum(gen.uniform(0.1, 3, n))
        yk = gen.normal(size=n)
        xq = np.r_[xk[:5], gen.uniform(xk[0] - 1, xk[-1] + 1, 60), np.full(3, xk[n // 2])]
        knots += [(s, float(a), float(b)) for a, b in zip(xk, yk)]
        queries += [(s, float(v)) for v in xq]
        want |= {(s, float(v)): y for v, y in zip(xq, interpolate._spline_eval(xk, yk, xq))}
    got = _cubic_values(spark, knots, queries, partitions)
    assert got.keys() == want.keys()
    for key, y in want.items():
        assert (got[key] is None) == np.isnan(y) and (got[key] is None or abs(got[key] - y) < 1e-9 * max(1, abs(y))), key


def test_spline_of_a_long_series_over_tasks(spark):
    """A million knots of one series in 16 partitions against one solve; no partition holds them all."""
    from pyspark.sql import functions as F
    n = 1_000_000
    x = F.col("id") + F.pmod(F.col("id") * 7, F.lit(5)) / 10.0
    y = F.sin(F.col("id") / 50.0) + F.pmod(F.col("id") * 31, F.lit(17)) / 9.0
    k = spark.range(n).select(F.lit(1).alias("s"), x.alias("x"), y.alias("y"))
    q = spark.range(0, n - 1, 997).select(F.lit(1).alias("s"), (F.col("id") + 0.7).alias("x"))
    got = {r["x"]: r["y"] for r in interpolate.interpolate_cubic(k, q, "s", "x", "y", 16).collect()}
    ids = np.arange(n)
    xk, yk = ids + (ids * 7 % 5) / 10.0, np.sin(ids / 50.0) + (ids * 31 % 17) / 9.0
    xq = np.array(sorted(got))
    want = interpolate._spline_eval(xk, yk, xq)
    assert len(got) == len(range(0, n - 1, 997)) and np.max(np.abs(np.array([got[v] for v in xq]) - want)) < 1e-9


def test_linear_interpolation_on_knot_and_between(spark):
    k = spark.createDataFrame([(1, 0.0, 0.0), (1, 2.0, 4.0), (1, 3.0, 1.0)], "s int, x double, y double")
    q = spark.createDataFrame([(1, 0.0), (1, 1.0), (1, 2.0), (1, 2.5), (1, 5.0)], "s int, x double")
    got = {r["x"]: r["y"] for r in interpolate.interpolate_linear(k, q, "s", "x", "y").collect()}
    assert got == {0.0: 0.0, 1.0: 2.0, 2.0: 4.0, 2.5: 2.5, 5.0: None}


def test_bootstrap_is_reproducible_and_brackets_median(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(i, "a", rnd.lognormvariate(1.5, 1.75)) for i in range(300)],
                               "id long, g string, v double")
    a = stats.bootstrap_median_ci(df, "g", "v", replicates=50).collect()[0]
    b = stats.bootstrap_median_ci(df.repartition(5), "g", "v", replicates=50).collect()[0]
    assert (a["cilo"], a["cihi"]) == (b["cilo"], b["cihi"])
    med = float(np.median([r["v"] for r in df.collect()]))
    assert a["cilo"] <= med <= a["cihi"] and a["replicates"] == 50


def test_bootstrap_follows_the_law_of_direct_resampling(spark):
    """Odd, even, tied and one-row groups, 10,000 replicates by default, against resampled rows."""
    gen = np.random.default_rng(9)
    groups = {"odd": gen.lognormal(size=37), "even": gen.lognormal(size=40), "ties": gen.integers(0, 4, 51) * 1.0,
              "one": np.array([2.5]), "two": np.array([1.0, 5.0])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("odd", None), (None, 3.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in stats.bootstrap_median_ci(df, "g", "v").collect()}
    assert set(got) == {"odd", "even", "ties", "one", "two", None} and got["odd"]["replicates"] == 10_000
    assert got[None]["cilo"] == got[None]["cihi"] == 3.0 and got["one"]["cilo"] == 2.5
    for g, vs in groups.items():
        med = np.median(vs[gen.integers(0, len(vs), (40_000, len(vs)))], axis=1)
        for name, p in (("cilo", 2.5), ("cihi", 97.5)):
            near = np.percentile(med, [p - 0.6, p + 0.6])  # four standard errors of the share
            assert near[0] - 1e-12 <= got[g][name] <= near[1] + 1e-12, (g, name)
    box = {r["g"]: r for r in stats.boxplot_stats(df, "g", "v", bootstrap=10_000).collect()}
    assert (box["even"]["cilo"], box["even"]["cihi"]) == (got["even"]["cilo"], got["even"]["cihi"])


def test_median_ranks_match_sorted_draws():
    for n in (5, 6):
        lower, upper = stats._median_ranks(n, 60_000, 3)
        draws = np.sort(np.random.default_rng(4).integers(0, n, (60_000, n)), axis=1)
        want = draws[:, (n - 1) // 2], draws[:, n // 2]
        for a, b in zip((lower, upper), want):
            assert np.abs(np.bincount(a, minlength=n) - np.bincount(b, minlength=n)).max() < 900
        assert (lower <= upper).all() and abs(np.mean(lower == upper) - np.mean(want[0] == want[1])) < 0.012


def test_approx_quantiles_close_to_exact(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).cast("double").alias("v"))
    ex = {r["g"]: (r["q0"], r["q1"]) for r in Q.quantiles(df, ["g"], "v", [0.25, 0.5]).collect()}
    ap = {r["g"]: (r["q0"], r["q1"]) for r in Q.quantiles(df, ["g"], "v", [0.25, 0.5], approx=True).collect()}
    for g in ex:
        assert all(abs(a - e) <= 2.0 for a, e in zip(ap[g], ex[g]))


def test_quantiles_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 2.0)], "g string, v double")
    got = {r["g"]: r["q0"] for r in Q.quantiles(df, ["g"], "v", [0.5], partitions=2).collect()}
    assert got == {None: 2.0, "x": 2.0}


def test_quantiles_without_preaggregation_handle_repeats(spark):
    rows = [("a", float(v), w) for v, w in [(1, 1), (1, 2), (2, 1), (3, 0), (3, 1), (5, 3), (5, 1)]]
    df = spark.createDataFrame(rows, "g string, v double, w long")
    a = Q.quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], weight="w", partitions=3).collect()[0]
    b = Q.quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], weight="w", partitions=3, preaggregate=False).collect()[0]
    exp = np.percentile([1, 1, 1, 2, 3, 5, 5, 5, 5], [10, 50, 90])
    assert np.allclose([a["q0"], a["q1"], a["q2"]], exp) and np.allclose([b["q0"], b["q1"], b["q2"]], exp)


def test_replicate_quantiles_match_direct_weighted_quantiles(spark):
    rnd = random.Random(9)
    rows = [(i, ["a", "b", None][i % 3], float(rnd.randint(0, 60))) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    got = {(r["g"], r["rep"]): (r["q0"], r["q1"])
           for r in stats.replicate_quantiles(df, "g", "v", "id", [0.5, 0.9], replicates=7, block=8).collect()}
    reps = F.sequence(F.lit(0), F.lit(6))
    x = df.select("g", "v", "id", F.explode(reps).alias("rep"))
    u = (F.pmod(F.xxhash64(F.col("id"), F.col("rep"), F.lit(42)), F.lit(1 << 53)).cast("double") / float(1 << 53))
    x = x.withColumn("w", stats.poisson1(u)).filter(F.col("w") > 0)
    exp = {(r["g"], r["rep"]): (r["q0"], r["q1"])
           for r in Q.quantiles(x, ["g", "rep"], "v", [0.5, 0.9], weight="w", partitions=5).collect()}
    assert got.keys() == exp.keys()
    for k in exp:
        assert np.allclose(got[k], exp[k]), k


def test_linear_interpolation_pieces_match_single_window(spark):
    from pyspark.sql import Window
    rnd = random.Random(12)
    knots = [("hot", float(x), rnd.uniform(-5, 5)) for x in range(0, 400, 3)]
    knots += [("s2", float(x), rnd.uniform(-5, 5)) for x in (10, 20, 40)]
    queries = [("hot", rnd.uniform(-5, 405)) for _ in range(500)] + [("s2", q) for q in (5.0, 10.0, 15.0, 39.0, 50.0)]
    queries += [("hot", 0.0), ("hot", 399.0), ("empty", 1.0)]
    k = spark.createDataFrame(knots, "s string, x double, y double")
    q = spark.createDataFrame(queries, "s string, x double")
    got = {(r["s"], r["x"]): r["y"] for r in interpolate.interpolate_linear(k, q, "s", "x", "y", partitions=9).collect()}
    u = k.withColumn("_q", F.lit(0)).unionByName(q.withColumn("y", F.lit(None).cast("double")).withColumn("_q", F.lit(1)))
    w = Window.partitionBy("s").orderBy("x", "_q")
    kx, ky = F.when(F.col("_q") == 0, F.col("x")), F.when(F.col("_q") == 0, F.col("y"))
    e = u.select("s", "x", "_q",
                 F.last(kx, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("x0"),
                 F.last(ky, True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("y0"),
                 F.first(kx, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("x1"),
                 F.first(ky, True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("y1")).filter("_q = 1")
    val = F.when(F.col("x0") == F.col("x"), F.col("y0")).otherwise(
        F.col("y0") + (F.col("y1") - F.col("y0")) * (F.col("x") - F.col("x0")) / (F.col("x1") - F.col("x0")))
    exp = {(r["s"], r["x"]): r["v"] for r in e.select("s", "x", val.alias("v")).collect()}
    assert got == exp


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(4)
    vals = np.round(rng.lognormal(1.5, 1.0, 3000), 2)
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    h = stats.histogram(df, "v", 100).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=100)
    dens, _ = np.histogram(vals, bins=100, density=True)
    assert [r["n"] for r in h] == list(counts)
    assert [r["lo"] for r in h] == list(edges[:-1]) and [r["hi"] for r in h] == list(edges[1:])
    assert np.allclose([r["density"] for r in h], dens, rtol=1e-12)
