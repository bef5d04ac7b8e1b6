"""Model jobs: regressions, trees, recommendations, classifiers, SHAP, splits.

Stand-ins: regression points -> lineitem (price from quantity, discount, tax,
all scaled to about [0, 1]); passengers / flowers -> labelled documents
(quality from length, line and word counts and language); ratings -> the
customer x supplier ratings of the similarity jobs.

Results of model fits are small report frames (one row per coefficient or
metric); the fitting itself runs on the whole tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import joins, models, quantiles as Q, stats
from sparkwright.plans.graph_jobs import ratings
from sparkwright.session import write_shared
from sparkwright.sources.tables import table

REG_FEATURES = ["qty", "disc", "tax"]
CLS_FEATURES = ["log_chars", "n_lines", "k_words", "is_en", "is_fr", "is_de"]
SEED = 42
ALS_USER = 1


def _reg_data(spark, root):
    li = table(spark, root, "lineitem")
    return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
                     (F.col("l_extendedprice") / 100000.0).alias("label"),
                     (F.col("l_quantity") / 50.0).alias("qty"), (F.col("l_discount") * 10.0).alias("disc"),
                     (F.col("l_tax") * 10.0).alias("tax"))


def _cls_data(spark, root):
    d = table(spark, root, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, root, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    return j.select("doc_id", F.col("quality").cast("double").alias("label"),
                    F.log1p("n_chars").alias("log_chars"),
                    F.size(scalar.text_lines(F.col("text"))).cast("double").alias("n_lines"),
                    (F.regexp_count(F.col("text"), F.lit(r"\S+")) / 1000.0).alias("k_words"),
                    *[(F.col("lang") == lg).cast("double").alias(f"is_{lg}") for lg in ("en", "fr", "de")])


def _report(spark, rows):
    return spark.createDataFrame([(k, float(v)) for k, v in rows], "term string, value double")


def linear_sgd(spark, root):
    """Least squares by gradient descent (100 iterations, step 1, L2 0.01, no intercept)."""
    w, hist = models.fit_linear_gd(_reg_data(spark, root), "label", REG_FEATURES)
    rows = [(f"w_{f}", v) for f, v in zip(REG_FEATURES, w)]
    rows += [("one_minus_mse", hist[-1] if hist else float("nan")), ("iterations", len(hist))]
    return _report(spark, rows).withColumn("value", scalar.round_half_away("value", 9))


def linear_ols(spark, root):
    """Unregularised simple regression of price on quantity (slope, intercept, r2)."""
    li = table(spark, root, "lineitem")
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return li.agg(scalar.round_half_away(F.regr_slope(y, x), 6).alias("slope"),
                  scalar.round_half_away(F.regr_intercept(y, x), 6).alias("intercept"),
                  scalar.round_half_away(F.regr_r2(y, x), 6).alias("r2"), F.regr_count(y, x).alias("n"))


def _split_reg(spark, root):
    df = models.assemble(_reg_data(spark, root), REG_FEATURES)
    return models.hash_split(df, "row_id", (0.7, 0.3), SEED)


def _test_rows(m, test):
    got = models.metrics(m.transform(test), "label")
    return [("test_rmse", got["rmse"]), ("test_r2", got["r2"])]


def linear_elastic(spark, root):
    """Elastic-net regression (reg 0.3, mix 0.8) on a 70/30 hash split: coefficients and test metrics."""
    train, test = _split_reg(spark, root)
    with models.cached(train) as t:
        m = models.fit_linear(t, "label", max_iter=100)
        rows = [(f"coef_{f}", c) for f, c in zip(REG_FEATURES, m.coefficients)]
        rows += [("intercept", m.intercept), ("train_rmse", m.summary.rootMeanSquaredError),
                 ("train_r2", m.summary.r2), ("iterations", m.summary.totalIterations)]
        rows += [(f"objective_{i}", v) for i, v in enumerate(m.summary.objectiveHistory)]
    return _report(spark, rows + _test_rows(m, test))


def linear_scored(spark, root):
    """Every test row scored by the elastic-net model: label, prediction and residual."""
    train, test = _split_reg(spark, root)
    with models.cached(train) as t:
        m = models.fit_linear(t, "label", max_iter=100)
    return m.transform(test).select("row_id", "label", "prediction",
                                    (F.col("label") - F.col("prediction")).alias("residual"))


def tree_regression(spark, root):
    """Decision-tree regression: feature importances and test RMSE / r2."""
    train, test = _split_reg(spark, root)
    with models.cached(train) as t:
        m = models.fit_tree(t, "label", seed=SEED)
    rows = [(f"importance_{f}", v) for f, v in zip(REG_FEATURES, m.featureImportances.toArray())]
    return _report(spark, rows + _test_rows(m, test))


def gbt_regression(spark, root):
    """Gradient-boosted trees (10 iterations): test RMSE / r2."""
    train, test = _split_reg(spark, root)
    with models.cached(train) as t:
        m = models.fit_gbt(t, "label", iters=10, seed=SEED)
    return _report(spark, _test_rows(m, test))


def _supplier_names(spark, root):
    return table(spark, root, "supplier").select(F.col("s_suppkey").alias("item"), F.col("s_name").alias("name"))


def recommend_als(spark, root):
    """Top-10 suppliers for one customer from ALS (rank 8, 20 iterations, reg 0.01), with names."""
    r = ratings(spark, root).select(F.col("o_custkey").cast("int").alias("user"),
                                    F.col("l_suppkey").cast("int").alias("item"), "rating")
    users = r.filter(F.col("user") == ALS_USER).select("user").distinct()
    recs = models.recommend(r, "user", "item", "rating", users, 10, 8, 20, 0.01, SEED)
    names = _supplier_names(spark, root).withColumn("item", F.col("item").cast("int"))
    return joins.with_names(recs, names, "item", "name", missing="error") \
        .select("user", "rank", "item", "name", "score")


def user_ratings(spark, root):
    """The ratings the recommended-for customer gave, with names (listed beside the recommendations)."""
    r = ratings(spark, root).filter(F.col("o_custkey") == ALS_USER).select(
        F.col("l_suppkey").alias("item"), scalar.round_half_away("rating", 6).alias("rating"))
    return joins.with_names(r, _supplier_names(spark, root), "item", "name", missing="error") \
        .select("item", "name", "rating")


def _features(spark, root):
    """Assembled labelled features, written once: every fit below iterates over them."""
    return write_shared(models.assemble(_cls_data(spark, root), CLS_FEATURES), "features")


def _split_cls(spark, root):
    return models.hash_split(_features(spark, root), "doc_id", (0.7, 0.3), SEED)


def logistic_accuracy(spark, root):
    """Logistic regression (C = 1): right / wrong / accuracy on the test split and mean
    probability of the train rows."""
    from pyspark.ml.functions import vector_to_array
    train, test = _split_cls(spark, root)
    m = models.fit_logistic(train, "label", c=1.0)
    p1 = m.transform(train).agg(F.avg(vector_to_array("probability")[1])).first()[0]
    return stats.accuracy(m.transform(test), "label", "prediction").select(
        "right", "wrong", "accuracy", F.lit(p1).cast("double").alias("mean_prob"))


def linear_shap(spark, root):
    """Per-document linear SHAP values of the logistic model's margin on the test split."""
    train, test = _split_cls(spark, root)
    m = models.fit_logistic(train, "label", c=1.0)
    means_row = train.agg(*[F.avg(f).alias(f) for f in CLS_FEATURES]).collect()[0]
    means = {f: float(means_row[f]) for f in CLS_FEATURES}
    sh = models.linear_shap(test.select("doc_id", *CLS_FEATURES), list(m.coefficients), m.intercept,
                            CLS_FEATURES, means)
    return sh.select("doc_id", "base", F.exp("base").alias("exp_base"), *[f"phi_{f}" for f in CLS_FEATURES])


def shap_ranking(spark, root):
    """Features ranked by mean absolute SHAP value over the test documents."""
    sh = linear_shap(spark, root)
    long = sh.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.abs(f"phi_{f}").alias("a"))
                                        for f in CLS_FEATURES])).alias("s")).select("s.*")
    imp = long.groupBy("feature").agg(F.avg("a").alias("mean_abs_phi"))
    from pyspark.sql import Window
    return imp.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs_phi").desc(), "feature")))


def _glm(spark, root):
    train, test = models.sample_exact(_features(spark, root), "doc_id", 0.75, SEED)
    with models.cached(train) as t:
        m = models.fit_glm_binomial(t, "label")
        summary = m.summary
        names = [*CLS_FEATURES, "intercept"]
        rows = [(f"{kind}_{n}", v) for kind, values in (
            ("coef", [*m.coefficients, m.intercept]), ("stderr", summary.coefficientStandardErrors),
            ("z", summary.tValues), ("p", summary.pValues)) for n, v in zip(names, values)]
        rows += [("null_deviance", summary.nullDeviance), ("deviance", summary.deviance),
                 ("df_null", summary.residualDegreeOfFreedomNull), ("df_residual", summary.residualDegreeOfFreedom),
                 ("aic", summary.aic), ("iterations", summary.numIterations)]
    return m, train, test, rows


def glm_binomial(spark, root):
    """Binomial GLM on a 75 % exact sample, scored on the rest: label = p >= 0.5, accuracy."""
    m, _, test, _ = _glm(spark, root)
    pred = m.transform(test).withColumn("pred_label", (F.col("prediction") >= 0.5).cast("double"))
    return stats.accuracy(pred, "label", "pred_label")


def glm_summary(spark, root):
    """Fit summary of the binomial GLM: coefficients, standard errors, z and p values, deviances, AIC."""
    return _report(spark, _glm(spark, root)[3])


def glm_scored(spark, root):
    """Linear predictor, probability and label (p >= 0.5) of every train and test row of the GLM."""
    m, train, test, _ = _glm(spark, root)
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return m.transform(both).select("doc_id", "part", "label", "eta", F.col("prediction").alias("probability"),
                                    (F.col("prediction") >= 0.5).cast("int").alias("pred_label"))


def label_encode(spark, root):
    """Alphabetical integer codes of the document language."""
    d = table(spark, root, "documents").select("doc_id", "lang")
    return Q.dense_codes(d, "lang", "lang_code")


def sample_exact(spark, root):
    """Exactly floor(0.75 n) documents chosen by a seeded hash of the id."""
    s, _ = models.sample_exact(table(spark, root, "documents").select("doc_id", "lang"), "doc_id", 0.75, SEED)
    return s


def random_split(spark, root):
    """70/30 hash split of the documents (split number per row)."""
    d = table(spark, root, "documents").select("doc_id")
    a, b = models.hash_split(d, "doc_id", (0.7, 0.3), SEED)
    return a.withColumn("split", F.lit(0)).unionByName(b.withColumn("split", F.lit(1)))


JOBS = {
    "linear_sgd": linear_sgd,
    "linear_ols": linear_ols,
    "linear_elastic": linear_elastic,
    "linear_scored": linear_scored,
    "tree_regression": tree_regression,
    "gbt_regression": gbt_regression,
    "recommend_als": recommend_als,
    "user_ratings": user_ratings,
    "logistic_accuracy": logistic_accuracy,
    "linear_shap": linear_shap,
    "shap_ranking": shap_ranking,
    "glm_binomial": glm_binomial,
    "glm_summary": glm_summary,
    "glm_scored": glm_scored,
    "label_encode": label_encode,
    "sample_exact": sample_exact,
    "random_split": random_split,
}

_HASH_SQL = "('0x' || substr(md5(doc_id::VARCHAR || ':42'), 1, 13))::BIGINT"


def _sgd_sql():
    """Gradient descent (100 steps, L2 0.01) from the Gram sums, as a recursive query over the steps."""
    f = ("a", "b", "c")
    sums = ", ".join([f"sum({x} * {y}) AS g{x}{y}" for x in f for y in f] + [f"sum({x} * y) AS h{x}" for x in f])
    grad = {x: "(" + " + ".join(f"g{x}{y} * w{y}" for y in f) + f" - h{x}) / n" for x in f}
    new = {x: f"w{x} * (1 - 0.01 / sqrt(t + 1)) - {grad[x]} / sqrt(t + 1)" for x in f}
    norm = "sqrt(" + " + ".join(f"w{x} * w{x}" for x in f) + ")"
    move = "sqrt(" + " + ".join(f"(w{x} - p{x}) * (w{x} - p{x})" for x in f) + ")"
    step = ", ".join(f"{new[x]} AS w{x}" for x in f) + ", " + ", ".join(f"w{x} AS p{x}" for x in f)
    mse = "(" + " + ".join(f"w{x} * g{x}{y} * w{y}" for x in f for y in f) + " - 2 * (" + \
        " + ".join(f"w{x} * h{x}" for x in f) + ") + yy) / n"
    return f"""WITH RECURSIVE d AS (SELECT l_extendedprice / 100000.0 AS y, l_quantity / 50.0 AS a,
            l_discount * 10.0 AS b, l_tax * 10.0 AS c FROM lineitem),
        g AS (SELECT count(*)::DOUBLE AS n, sum(y * y) AS yy, {sums} FROM d),
        s AS (SELECT 0 AS t, 0.0::DOUBLE AS wa, 0.0::DOUBLE AS wb, 0.0::DOUBLE AS wc, 0.0::DOUBLE AS pa,
                     0.0::DOUBLE AS pb, 0.0::DOUBLE AS pc
              UNION ALL
              SELECT t + 1, {step} FROM s, g
              WHERE t < 100 AND NOT (t > 1 AND {move} < 0.001 * greatest({norm}, 1.0))),
        l AS (SELECT s.*, {mse} AS mse FROM s, g WHERE t = (SELECT max(t) FROM s))
        SELECT 'w_qty' AS term, round(wa, 9) AS value FROM l UNION ALL SELECT 'w_disc', round(wb, 9) FROM l
        UNION ALL SELECT 'w_tax', round(wc, 9) FROM l UNION ALL SELECT 'one_minus_mse', round(1 - mse, 9) FROM l
        UNION ALL SELECT 'iterations', t::DOUBLE FROM l"""


ORACLE = {
    "linear_ols": """SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
        round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
        round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
        CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem""",
    "user_ratings": f"""SELECT l_suppkey AS item, s_name AS name, round(avg(l_quantity), 6) AS rating
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
        WHERE o_custkey = {ALS_USER} GROUP BY 1, 2""",
    "sample_exact": f"""SELECT doc_id, lang FROM (SELECT doc_id, lang,
            row_number() OVER (ORDER BY {_HASH_SQL}, doc_id) AS n, count(*) OVER () AS total FROM documents)
        WHERE n <= floor(0.75 * total)""",
    "random_split": f"""SELECT doc_id, CASE WHEN {_HASH_SQL}::DOUBLE / 4503599627370496.0 < 0.7 THEN 0 ELSE 1 END AS split
        FROM documents""",
    "linear_sgd": _sgd_sql(),
    "label_encode": """SELECT doc_id, lang, CAST(CASE WHEN lang IS NULL THEN -1
        ELSE dense_rank() OVER (PARTITION BY lang IS NULL ORDER BY lang) - 1 END AS INTEGER) AS lang_code
        FROM documents""",
}
