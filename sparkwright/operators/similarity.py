"""Item-to-item cosine similarity.

For items a < b rated by common users u the reference computes
    score(a, b) = sum_u x_ua x_ub / (sqrt(sum_u x_ua^2) sqrt(sum_u x_ub^2))
    strength(a, b) = number of common users,
where all sums run over the common users only.

Users are dealt into blocks, which form the pairs a < b of each user's ratings (so
half of all pairs); the four sums travel packed to groups of pairs, which add them
up (:mod:`sparkwright.operators.pair_sums`). A user with very many ratings is dealt
over several blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.operators.pair_sums import pair_sums
from sparkwright.session import write_shared

#: Ratings of a user beyond which the pairs of the user's items are formed in a grid of tasks.
GRID = 1_000


def cosine_pairs(ratings: DataFrame, user: str, item: str, rating: str,
                 min_score: float | None = None, min_strength: int | None = None) -> DataFrame:
    """(item_a, item_b, score, strength) for every item pair a < b with a common user; with the
    thresholds only pairs of score > min_score and strength > min_strength.

    ``ratings`` must hold one row per (user, item); ids may be of any orderable type, rows with a
    null user, item or rating take no part. A pair without length has score 0.
    """
    r = write_shared(ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"), F.col(rating).cast("double").alias("_x"))
                     .dropna(), "ratings")
    rated = write_shared(r.join(r.groupBy("_u").agg(F.count(F.lit(1)).alias("_d")), "_u"), "rated")
    s = pair_sums(rated, GRID, 1 if min_strength is None else max(1, math.floor(min_strength) + 1))
    den = F.sqrt("sxx") * F.sqrt("syy")
    out = s.select("item_a", "item_b", F.when(den != 0, F.col("sxy") / den).otherwise(F.lit(0.0)).alias("score"),
                   "strength")
    if min_score is not None:
        out = out.filter(F.col("score") > min_score)
    if min_strength is not None:
        out = out.filter(F.col("strength") > min_strength)
    return out


class PrunedPairs:
    """Item pairs with strength > ``min_strength`` (and score above a bound), found without forming all pairs.

    A pair needs more than m = ``min_strength`` common users, so

    * items with at most m ratings take no part (:attr:`left`);
    * of any m users, at least one common user is not among them. The m users with most ratings, which would form the
      most pairs, form none: pairs come from the other users only (:attr:`formed`);
    * a pair whose common users there and the number of the m users that rated both at most do not exceed m
      together is dropped before its sums are completed (:attr:`open`).

    The sums over the m users are added to the remaining pairs from one map per item of at most m
    entries. A user with more than ``GRID`` ratings is dealt as a grid: the items in parts, every pair of parts a key of its
    own, so no task forms all pairs of a user.
    """

    def __init__(self, ratings: DataFrame, user: str, item: str, rating: str, min_strength: int):
        self.m = m = min_strength
        r = write_shared(ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"),
                                        F.col(rating).cast("double").alias("_x")).dropna(), "ratings")
        # written, so the planner knows its size before it would exchange the ratings
        enough = write_shared(r.groupBy("_i").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > m).select("_i"), "enough")
        left = r.join(enough, "_i", "left_semi")
        degree = left.groupBy("_u").agg(F.count(F.lit(1)).alias("_d"))
        heavy = degree.orderBy(F.col("_d").desc(), "_u").limit(m)
        self.degree = write_shared(degree.join(heavy.select("_u", F.lit(True).alias("_heavy")), "_u", "left")
                                   .withColumn("_heavy", F.coalesce("_heavy", F.lit(False))), "degrees")
        self.all, self.left = r, write_shared(left.join(self.degree, "_u"), "rated")
        self.light = self.left.where("not _heavy and _d > 1")
        # at most m entries of an item
        self.own = write_shared(self.left.where("_heavy").groupBy("_i").agg(
            F.map_from_entries(F.collect_list(F.struct("_u", "_x"))).alias("_h")), "heavy-ratings")
        self.open = write_shared(self._candidates(), "candidates")

    def _candidates(self) -> DataFrame:
        h = self.own.select(F.col("_i"), "_h")
        # no item has more entries than this: most pairs end before their sums are made
        most = h.agg(F.max(F.size("_h"))).first()[0] or 0
        sums = pair_sums(self.light, GRID, max(1, self.m + 1 - most))
        sums = (sums.join(h.select(F.col("_i").alias("item_a"), F.col("_h").alias("_ha")), "item_a", "left")
                .join(h.select(F.col("_i").alias("item_b"), F.col("_h").alias("_hb")), "item_b", "left"))
        most = F.least(F.coalesce(F.size("_ha"), F.lit(0)), F.coalesce(F.size("_hb"), F.lit(0)))
        return sums.where(F.col("strength") + most > self.m)

    def pairs(self, min_score: float | None = None) -> DataFrame:
        """(item_a, item_b, score, strength) of the pairs above the thresholds."""
        common = F.filter(F.map_keys(F.coalesce("_ha", F.map_from_arrays(F.array(), F.array()))), lambda u: F.map_contains_key(F.col("_hb"), u))
        pair = F.transform(F.when(F.col("_ha").isNull() | F.col("_hb").isNull(), F.array()).otherwise(common), lambda u: F.struct(
            F.element_at("_ha", u).alias("x"), F.element_at("_hb", u).alias("y")))

        def with_heavy(name, term):
            return F.aggregate("_both", F.col(name), lambda acc, p: acc + term(p))
        out = self.open.withColumn("_both", pair).select(
            "item_a", "item_b", with_heavy("sxy", lambda p: p.x * p.y).alias("sxy"), with_heavy("sxx", lambda p: p.x * p.x).alias("sxx"),
            with_heavy("syy", lambda p: p.y * p.y).alias("syy"), (F.col("strength") + F.size("_both")).alias("strength"))
        den = F.sqrt("sxx") * F.sqrt("syy")
        out = out.select("item_a", "item_b", F.when(den != 0, F.col("sxy") / den).otherwise(F.lit(0.0)).alias("score"), "strength") \
            .where(F.col("strength") > self.m)
        return out if min_score is None else out.where(F.col("score") > min_score)

    def report(self) -> DataFrame:
        """One row: pairs of ratings that the plain join would form, pairs that are formed, item pairs whose sums are
        completed, and those above the strength."""
        d = self.all.groupBy("_u").agg(F.count(F.lit(1)).alias("_d"))
        pairs = F.coalesce(F.sum(F.expr("_d * (_d - 1) div 2")), F.lit(0))
        parts = {"pairs_of_all": d.agg(pairs.alias("n")), "pairs_formed": self.degree.where("not _heavy").agg(pairs.alias("n")),
                 "pairs_open": self.open.agg(F.count(F.lit(1)).alias("n")), "pairs_strong": self.pairs().agg(F.count(F.lit(1)).alias("n"))}
        rows = None  # four rows, one of each count
        for name, part in parts.items():
            row = part.select(F.lit(name).alias("name"), "n")
            rows = row if rows is None else rows.unionByName(row)
        return rows.agg(*[F.max(F.when(F.col("name") == c, F.col("n"))).alias(c) for c in parts])


def similar_pairs(ratings: DataFrame, user: str, item: str, rating: str, min_score: float, min_strength: int) -> DataFrame:
    """(item_a, item_b, score, strength) of every pair a < b with score > ``min_score`` and more than ``min_strength``
    common users: the pairs of :func:`cosine_pairs`, without forming those that cannot reach the strength
    (:class:`PrunedPairs`). ``ratings`` must hold one row per (user, item); rows with a null take no part."""
    return PrunedPairs(ratings, user, item, rating, min_strength).pairs(min_score)


def similar_to(ratings: DataFrame, user: str, item: str, rating: str, target,
               min_score: float, min_strength: int, k: int = 10) -> DataFrame:
    """Items most similar to ``target`` (G3): only pairs that contain the
    target are formed, so the work is linear in the target's co-raters.

    Keeps pairs with score > min_score and strength > min_strength, top k by
    (score, strength) descending, ties by item id.
    """
    r = ratings.select(F.col(user).alias("_u"), F.col(item).alias("_i"),
                       F.col(rating).cast("double").alias("_y"))
    tx = r.filter(F.col("_i") == target).select("_u", F.col("_y").alias("_x"))
    j = r.filter(F.col("_i") != target).join(tx, "_u")
    s = j.groupBy(F.col("_i").alias("other")).agg(
        F.sum(F.col("_x") * F.col("_y")).alias("sxy"), F.sum(F.col("_x") * F.col("_x")).alias("sxx"),
        F.sum(F.col("_y") * F.col("_y")).alias("syy"), F.count(F.lit(1)).alias("strength"))
    den = F.sqrt("sxx") * F.sqrt("syy")
    out = s.select("other", F.when(den != 0, F.col("sxy") / den).otherwise(F.lit(0.0)).alias("score"),
                   "strength")
    return out.filter((F.col("score") > min_score) & (F.col("strength") > min_strength)) \
        .orderBy(F.col("score").desc(), F.col("strength").desc(), F.col("other")).limit(k)
