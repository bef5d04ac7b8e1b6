import math
import random

import numpy as np
from pyspark.sql import functions as F

from sparkwright.operators import models


def test_gradient_descent_matches_row_by_row_numpy(spark):
    rnd = random.Random(2)
    rows = [(rnd.uniform(-1, 1), rnd.uniform(-1, 1)) for _ in range(300)]
    data = [(2 * a - b + rnd.gauss(0, 0.1), a, b) for a, b in rows]
    df = spark.createDataFrame(data, "y double, a double, b double")
    w, hist = models.fit_linear_gd(df, "y", ["a", "b"], iters=100, step=1.0, reg=0.01, tol=0.0)
    X = np.array([[a, b] for _, a, b in data])
    y = np.array([r[0] for r in data])
    v = np.zeros(2)
    for t in range(1, 101):
        grad = sum((X[i] @ v - y[i]) * X[i] for i in range(len(y))) / len(y)
        eta = 1.0 / math.sqrt(t)
        v = v * (1 - eta * 0.01) - eta * grad
    assert np.allclose(w, v, atol=1e-9)
    assert abs(hist[-1] - (1 - np.mean((X @ v - y) ** 2))) < 1e-9


def test_sample_exact_size_and_complement(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    s, c = models.sample_exact(df, "k", 0.75, 42)
    sk = {r["k"] for r in s.collect()}
    ck = {r["k"] for r in c.collect()}
    assert len(sk) == 752 and not (sk & ck) and len(sk | ck) == 1003
    s2, _ = models.sample_exact(df.repartition(7), "k", 0.75, 42)
    assert {r["k"] for r in s2.collect()} == sk


def test_hash_split_is_a_partition_and_reproducible(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = models.hash_split(df, "k", (0.7, 0.3), 1)
    ak, bk = {r["k"] for r in a.collect()}, {r["k"] for r in b.collect()}
    assert not (ak & bk) and len(ak | bk) == 2000 and 1250 < len(ak) < 1550
    a2, _ = models.hash_split(df.repartition(3), "k", (0.7, 0.3), 1)
    assert {r["k"] for r in a2.collect()} == ak


def test_linear_shap_is_additive(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -1.0), (0.5, 0.5)], "x1 double, x2 double")
    coef, b0 = [0.7, -1.3], 0.2
    means = {"x1": 1.5, "x2": 0.5}
    out = models.linear_shap(df, coef, b0, ["x1", "x2"], means).collect()
    for r in out:
        score = b0 + coef[0] * r["x1"] + coef[1] * r["x2"]
        assert abs(r["base"] + r["phi_x1"] + r["phi_x2"] - score) < 1e-12


def test_recommend_returns_k_ranked_items(spark):
    rnd = random.Random(4)
    rows = {(u, i): float(rnd.randint(1, 5)) for u in range(30) for i in range(20) if rnd.random() < 0.5}
    df = spark.createDataFrame([(u, i, r) for (u, i), r in rows.items()], "user int, item int, rating double")
    users = df.filter(F.col("user") == 3).select("user").distinct()
    recs = models.recommend(df, "user", "item", "rating", users, k=5, iters=5).collect()
    assert [r["rank"] for r in recs] == [1, 2, 3, 4, 5]
    assert all(recs[i]["score"] >= recs[i + 1]["score"] for i in range(4))


def test_recommend_deals_many_ratings_into_more_blocks(spark, monkeypatch):
    from pyspark.ml import recommendation
    fits, fit = [], recommendation.ALS.fit
    monkeypatch.setattr(recommendation.ALS, "fit", lambda als, ratings: (
        fits.append((als.getNumUserBlocks(), als.getNumItemBlocks(), als.getIntermediateStorageLevel())), fit(als, ratings))[1])
    likes = {(u, i): 5.0 if (u + i) % 2 else 1.0 for u in range(24) for i in range(16) if (3 * u + i) % 5}
    df = spark.createDataFrame([(u, i, x) for (u, i), x in likes.items()], "user int, item int, rating double")
    users = df.where("user = 3").select("user").distinct()
    for most, blocks in ((models.ALS_BLOCK, 10), (20, -(-len(likes) // 20))):
        monkeypatch.setattr(models, "ALS_BLOCK", most)
        recs = models.recommend(df, "user", "item", "rating", users, k=8, rank=2, iters=10).collect()
        assert fits.pop() == (blocks, blocks, "DISK_ONLY")
        assert sorted(r["item"] for r in recs) == list(range(0, 16, 2)) and all(abs(r["score"] - 5) < 0.5 for r in recs)


def test_gram_stats_leave_out_rows_with_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 5.0)], "x double, y double")
    g, b, yy, n = models.gram_stats(df, "y", ["x"])
    assert (g[0, 0], b[0], yy, n) == (5.0, 10.0, 20.0, 2)


def _points(spark, n=400, seed=3):
    gen = np.random.default_rng(seed)
    x = gen.normal(size=(n, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + gen.normal(scale=0.1, size=n)
    df = spark.createDataFrame([(int(i), float(a), float(b), float(c)) for i, (a, b, c) in
                                enumerate(zip(x[:, 0], x[:, 1], y))], "id long, a double, b double, y double")
    return models.assemble(df, ["a", "b"]), x, y


def test_linear_fit_matches_least_squares_and_coordinate_descent(spark):
    df, x, y = _points(spark)
    m = models.fit_linear(df, "y", reg=0.0, elastic=0.0)
    want, *_ = np.linalg.lstsq(np.c_[x, np.ones(len(y))], y, rcond=None)
    assert np.allclose([*m.coefficients, m.intercept], want, atol=1e-6)
    # elastic net: standardised features and label, coordinate descent
    reg, mix = 0.3, 0.8
    m = models.fit_linear(df, "y", reg=reg, elastic=mix, tol=1e-9)
    sx, sy = x.std(axis=0, ddof=1), y.std(ddof=1)
    z, t = (x - x.mean(axis=0)) / sx, (y - y.mean()) / sy
    w, lam = np.zeros(2), reg / sy
    for _ in range(500):
        for j in range(2):
            r = t - z @ w + z[:, j] * w[j]
            rho = (z[:, j] @ r) / len(t)
            w[j] = np.sign(rho) * max(abs(rho) - lam * mix, 0) / ((z[:, j] @ z[:, j]) / len(t) + lam * (1 - mix))
    assert np.allclose(m.coefficients, w * sy / sx, atol=1e-3)  # n or n - 1 in the moments


def test_metrics_match_numpy_and_the_evaluator(spark):
    df, x, y = _points(spark)
    pred = models.fit_linear(df, "y", reg=0.1, elastic=0.0).transform(df)
    p = np.array([r["prediction"] for r in pred.orderBy("id").collect()])
    got = models.metrics(pred, "y")
    assert np.isclose(got["rmse"], np.sqrt(np.mean((y - p) ** 2))) and np.isclose(got["mae"], np.mean(np.abs(y - p)))
    assert np.isclose(got["r2"], 1 - np.mean((y - p) ** 2) / y.var())
    for k, v in got.items():
        assert np.isclose(models.evaluate(pred, "y", k), v)
    assert math.isnan(models.metrics(pred.limit(0), "y")["rmse"])


def test_trees_on_a_hand_sized_step(spark):
    df = models.assemble(spark.createDataFrame([(float(k), 0.0, 1.0 if k < 5 else 4.0) for k in range(10)],
                                               "a double, b double, y double"), ["a", "b"])
    for m in (models.fit_tree(df, "y"), models.fit_gbt(df, "y", iters=3)):
        assert np.allclose([r["prediction"] for r in m.transform(df).orderBy("a").collect()], [1.0] * 5 + [4.0] * 5)
    assert list(models.fit_tree(df, "y").featureImportances.toArray()) == [1.0, 0.0]


def test_logistic_and_glm_match_newton_steps(spark):
    gen = np.random.default_rng(8)
    x = gen.normal(size=(500, 2))
    y = (gen.random(500) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1] + 0.2)))).astype(float)
    df = models.assemble(spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x[:, 0], x[:, 1], y)],
                                               "a double, b double, y double"), ["a", "b"])
    X = np.c_[x, np.ones(500)]

    def newton(penalty):
        w, keep = np.zeros(3), np.diag([penalty, penalty, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-X @ w))
            w = w - np.linalg.solve((X * (p * (1 - p))[:, None]).T @ X + keep, X.T @ (p - y) + keep @ w)
        return w, p
    w, _ = newton(1.0)  # C = 1: penalty 1/2 |w|^2 on the summed loss
    m = models.fit_logistic(df, "y", c=1.0)
    assert np.allclose([*m.coefficients, m.intercept], w, atol=1e-4)
    w, p = newton(0.0)
    g = models.fit_glm_binomial(df, "y")
    assert np.allclose([*g.coefficients, g.intercept], w, atol=1e-5)
    dev = -2 * np.sum(y * np.log(p) + (1 - y) * np.log(1 - p))
    assert np.isclose(g.summary.deviance, dev, rtol=1e-6)


def test_sample_exact_settles_ties_by_counting(spark, monkeypatch):
    monkeypatch.setattr(models, "_FEW", 3)
    df = spark.range(700).withColumnRenamed("id", "k")
    rows = sorted((r["h"], r["k"]) for r in df.select(models.key_hash("k", 5).alias("h"), "k").collect())
    for frac in (0.0, 0.1, 0.5, 1.0):
        s, c = models.sample_exact(df, "k", frac, 5)
        want = {k for _, k in rows[:math.floor(700 * frac)]}
        assert {r["k"] for r in s.collect()} == want and c.count() == 700 - len(want)


def test_model_reports(spark):
    from sparkwright.plans import model_jobs
    from tests.conftest import SF001
    rep = {r["term"]: r["value"] for r in model_jobs.glm_summary(spark, SF001).collect()}
    assert rep["deviance"] < rep["null_deviance"] and 0 <= rep["p_log_chars"] <= 1
    rows = model_jobs.glm_scored(spark, SF001).collect()
    assert {r["part"] for r in rows} == {"train", "test"}
    for r in rows:
        assert abs(r["probability"] - 1 / (1 + math.exp(-r["eta"]))) < 1e-9
        assert r["pred_label"] == int(r["probability"] >= 0.5)
    for job in (model_jobs.linear_elastic, model_jobs.tree_regression, model_jobs.gbt_regression):
        rep = {r["term"]: r["value"] for r in job(spark, SF001).collect()}
        assert rep["test_rmse"] > 0
