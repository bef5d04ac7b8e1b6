"""Model operators (M1-M15): splits, sampling, regressions, classifiers,
recommendations, linear SHAP.

Model fitting uses Spark ML estimators (distributed). Gradient descent for a
squared loss needs only the Gram statistics (X'X, X'y, y'y, n): one aggregate
pass over the data, then the iterations run on a d x d matrix. Splits and
samples hash a key, so they are reproducible under any partitioning.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.session import copies, write_shared

HASH_BITS = 52
_RADIX = 12       # bits settled by one counting pass of ``sample_exact``
_FEW = 10_000     # rows of the last bucket that are ordered on the driver

#: Fewest blocks of users and of items that ALS deals ratings into, and the ratings of a block beyond them.
ALS_BLOCKS, ALS_BLOCK = 10, 8_000_000


def key_hash(key: str, seed: int):
    """52 bits of the MD5 of "key:seed" as a long: the same in any engine (a null key: empty)."""
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _unit_hash(key: str, seed: int):
    return key_hash(key, seed).cast("double") / float(1 << HASH_BITS)


@contextmanager
def cached(df: DataFrame):
    """A copy in the shared folder of a frame that a fit iterates over; it goes when the fit is done, also on failure."""
    with copies.scope(df.sparkSession):
        yield write_shared(df, "train")


def hash_split(df: DataFrame, key: str, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """Random split by a hash of (key, seed) (M2): same rows on every run."""
    tot = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights:
        bounds.append((acc, acc + w / tot))
        acc += w / tot
    u = _unit_hash(key, seed)
    return [df.filter((u >= lo) & ((u < hi) if i < len(bounds) - 1 else F.lit(True)))
            for i, (lo, hi) in enumerate(bounds)]


def sample_exact(df: DataFrame, key: str, frac: float, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Exactly floor(frac * n) rows without replacement, and the complement.

    The rows with the smallest (hash(key, seed), key) are kept. The largest
    pair that is kept is found by counting: each pass counts 4,096 hash
    buckets and goes on inside the one that holds the wanted rank, until few
    rows are left to order (at most 10,000, or rows of one hash). Then both
    parts are plain filters: no row is shuffled, ranked or cached. Keys must
    be unique and not null.
    """
    h = key_hash(key, seed)
    left, lo, bits = math.floor(df.count() * frac), 0, HASH_BITS
    if left == 0:
        return df.filter(F.lit(False)), df
    keys = df.select(h.alias("h"), F.col(key).alias("k"))
    while bits:
        shift = max(0, bits - _RADIX)
        inside = keys.filter((F.col("h") >= lo) & (F.col("h") < lo + (1 << bits)))
        counts = {r["b"]: r["n"] for r in inside.groupBy(F.shiftright("h", shift).alias("b"))
                  .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 4,096 rows
        for bucket in sorted(counts):
            if left <= counts[bucket]:
                break
            left -= counts[bucket]
        lo, bits = bucket << shift, shift
        if counts[bucket] <= _FEW:
            break
    last = keys.filter((F.col("h") >= lo) & (F.col("h") < lo + (1 << bits))).orderBy("h", "k").limit(left) \
        .orderBy(F.desc("h"), F.desc("k")).first()
    kept = (h < last["h"]) | ((h == last["h"]) & (F.col(key) <= F.lit(last["k"])))
    return df.filter(kept), df.filter(~kept)


def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature vector from columns (M11); rows with nulls are skipped."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def gram_stats(df: DataFrame, label: str, features) -> tuple:
    """(X'X, X'y, y'y, n) in one aggregate; d*(d+1)/2 + d + 2 numbers. Rows with
    a null label or feature are left out of every sum."""
    import numpy as np
    d = len(features)
    df = df.dropna(subset=[label, *features])
    x = [F.col(c).cast("double") for c in features]
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y * y).alias("yy")]
    aggs += [F.sum(x[i] * y).alias(f"xy{i}") for i in range(d)]
    aggs += [F.sum(x[i] * x[j]).alias(f"xx{i}_{j}") for i in range(d) for j in range(i, d)]
    r = df.agg(*aggs).collect()[0]
    g = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            g[i, j] = g[j, i] = r[f"xx{i}_{j}"] or 0.0
    b = np.array([r[f"xy{i}"] or 0.0 for i in range(d)])
    return g, b, float(r["yy"] or 0.0), int(r["n"])


def fit_linear_gd(df: DataFrame, label: str, features, iters: int = 100, step: float = 1.0,
                  reg: float = 0.01, tol: float = 0.001):
    """Least squares by full-batch gradient descent, no intercept, L2 (M4).

    Update (the classic SGD recipe with mini-batch fraction 1): step_t =
    step / sqrt(t); w <- w (1 - step_t reg) - step_t grad, grad = (X'X w - X'y)/n;
    from the second iteration on, stops when the change between the last two
    iterates is below tol * max(|w|, 1). Returns (weights, [1 - MSE after
    each iteration]).
    """
    import numpy as np
    g, b, yy, n = gram_stats(df, label, features)
    w = np.zeros(len(features))
    hist = []
    if n == 0:
        return w, hist
    for t in range(1, iters + 1):
        grad = (g @ w - b) / n
        eta = step / math.sqrt(t)
        new = w * (1.0 - eta * reg) - eta * grad
        mse = (new @ g @ new - 2 * new @ b + yy) / n
        hist.append(1.0 - mse)
        done = t > 1 and np.linalg.norm(new - w) < tol * max(np.linalg.norm(new), 1.0)
        w = new
        if done:
            break
    return w, hist


def fit_linear(train: DataFrame, label: str, features: str = "features", max_iter: int = 100,
               reg: float = 0.3, elastic: float = 0.8, tol: float = 1e-6):
    """Elastic-net linear regression (M5)."""
    from pyspark.ml.regression import LinearRegression
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                            elasticNetParam=elastic, tol=tol).fit(train)


def fit_tree(train: DataFrame, label: str, features: str = "features", seed: int = 42):
    """Decision-tree regression (M9)."""
    from pyspark.ml.regression import DecisionTreeRegressor
    return DecisionTreeRegressor(featuresCol=features, labelCol=label, seed=seed).fit(train)


def fit_gbt(train: DataFrame, label: str, features: str = "features", iters: int = 10, seed: int = 42):
    """Gradient-boosted trees."""
    from pyspark.ml.regression import GBTRegressor
    return GBTRegressor(featuresCol=features, labelCol=label, maxIter=iters, seed=seed).fit(train)


def evaluate(pred: DataFrame, label: str, metric: str, prediction: str = "prediction") -> float:
    """r2 / rmse / mae of a scored frame (M8)."""
    from pyspark.ml.evaluation import RegressionEvaluator
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric).evaluate(pred)


def metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> dict[str, float]:
    """rmse, mae and r2 of a scored frame in one aggregate (M8)."""
    y, p = F.col(label), F.col(prediction)
    r = pred.agg(F.count(F.lit(1)).alias("n"), F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
                 F.var_pop(y).alias("var")).first()
    nan = float("nan")
    if not r["n"]:
        return {"rmse": nan, "mae": nan, "r2": nan}
    return {"rmse": math.sqrt(r["mse"]), "mae": r["mae"], "r2": 1 - r["mse"] / r["var"] if r["var"] else nan}


def fit_logistic(train: DataFrame, label: str, features: str = "features", c: float = 1.0,
                 n: int | None = None, max_iter: int = 100):
    """Logistic regression with an L2 penalty 1/(2C) on the summed loss (M13):
    Spark averages the loss, so regParam = 1 / (C * n)."""
    from pyspark.ml.classification import LogisticRegression
    n = n or train.count()
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (c * n),
                              elasticNetParam=0.0, standardization=False, maxIter=max_iter).fit(train)


def fit_glm_binomial(train: DataFrame, label: str, features: str = "features", max_iter: int = 25):
    """Binomial GLM with logit link (M12); predictions are probabilities."""
    from pyspark.ml.regression import GeneralizedLinearRegression
    return GeneralizedLinearRegression(featuresCol=features, labelCol=label, family="binomial",
                                       link="logit", maxIter=max_iter, linkPredictionCol="eta").fit(train)


def recommend(ratings: DataFrame, user: str, item: str, rating: str, users: DataFrame, k: int = 10,
              rank: int = 8, iters: int = 20, reg: float = 0.01, seed: int = 42) -> DataFrame:
    """Top-k items per requested user from explicit-rating ALS (M1); items the
    user already rated are not excluded. A task holds the ratings of one block, so blocks grow in number with the ratings;
    they lie on disk between the iterations, and every second one drops the exchanged factors of those before."""
    from pyspark.ml.recommendation import ALS
    ratings = write_shared(ratings.select(user, item, rating), "ratings")
    blocks = max(ALS_BLOCKS, -(-ratings.count() // ALS_BLOCK))
    model = ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, maxIter=iters, regParam=reg, seed=seed,
                coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=2,
                intermediateStorageLevel="DISK_ONLY").fit(ratings)
    recs = model.recommendForUserSubset(users, k)
    return recs.select(user, F.posexplode("recommendations").alias("pos", "r")) \
        .select(user, (F.col("pos") + 1).alias("rank"), F.col(f"r.{item}").alias(item),
                F.col("r.rating").alias("score"))


def linear_shap(df: DataFrame, coef, intercept: float, feature_cols, means: dict) -> DataFrame:
    """Per-row linear SHAP values under feature independence (M15):
    phi_j = beta_j (x_j - mean_j), base = intercept + sum beta_j mean_j, so
    base + sum phi_j equals the linear score of the row."""
    base = intercept + sum(float(c) * means[f] for c, f in zip(coef, feature_cols))
    cols = [(F.lit(float(c)) * (F.col(f) - F.lit(means[f]))).alias(f"phi_{f}")
            for c, f in zip(coef, feature_cols)]
    return df.select("*", F.lit(base).alias("base"), *cols)
