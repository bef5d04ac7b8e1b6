"""Exact ranks and quantiles without holding a group in one task.

Spark's ``percentile`` merges every distinct value of a group in one task,
so a group with a third of all rows would need that third in one buffer.
Here values are first counted per (group, value) (map-side partial counts),
then range-partitioned on (group, value): the sampled bounds split a large
group over many partitions. Inside each (group, partition) piece a window
gives the running count; a summary table with one row per (group, piece)
(at most groups + partitions rows) supplies each piece's offset and the group
size. Every distinct value then knows its rank interval [lo, hi) and the
quantile positions are picked out by column arithmetic.

The piece-ranked frame feeds both the summary and the join back, so it is
written once to the shared folder: one range partitioning, one set of piece
ids (see windows.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.session import write_shared

_UNB = Window.unboundedPreceding


def _list(x):
    return [] if x is None else ([x] if isinstance(x, str) else list(x))


def rank_intervals(vc: DataFrame, groups, value: str, weight: str,
                   partitions: int | None = None) -> DataFrame:
    """For rows (groups..., value, weight) with one row per distinct (group,
    value): add ``_lo`` (total weight of smaller values in the group), ``_hi``
    (= _lo + weight) and ``_n`` (group total weight)."""
    groups = _list(groups)
    n = partitions or int(vc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = vc.repartitionByRange(n, *groups, value).withColumn("_pid", F.spark_partition_id())
    w = Window.partitionBy(*groups, "_pid").orderBy(value)
    r = write_shared(r.withColumn("_loc", F.coalesce(F.sum(weight).over(w.rowsBetween(_UNB, -1)), F.lit(0))), "ranks")
    b = r.groupBy(*groups, "_pid").agg(F.sum(weight).alias("_tot"))
    wb = Window.partitionBy(*groups).orderBy("_pid")
    b = (b.withColumn("_base", F.coalesce(F.sum("_tot").over(wb.rowsBetween(_UNB, -1)), F.lit(0)))
          .withColumn("_n", F.sum("_tot").over(Window.partitionBy(*groups)))
          .select(*groups, "_pid", "_base", "_n"))
    from sparkwright.operators.windows import join_back
    return (join_back(r, b, [*groups, "_pid"])
             .withColumn("_lo", F.col("_base") + F.col("_loc"))
             .withColumn("_hi", F.col("_lo") + F.col(weight))
             .drop("_pid", "_loc", "_base"))


def value_counts(df: DataFrame, groups, value: str, weight: str | None = None) -> DataFrame:
    """(groups..., value, _w): rows (or weights) per distinct non-null value."""
    groups = _list(groups)
    w = F.sum(F.col(weight)) if weight else F.count(F.lit(1))
    return df.filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(w.cast("bigint").alias("_w"))


def _pick(ri: DataFrame, groups, value: str, probs) -> DataFrame:
    n1 = F.col("_n") - 1
    rows = []
    for i, p in enumerate(probs):
        h = n1 * F.lit(float(p))
        klo, khi = F.floor(h), F.ceil(h)
        lo_in = (klo >= F.col("_lo")) & (klo < F.col("_hi"))
        hi_in = (khi >= F.col("_lo")) & (khi < F.col("_hi"))
        rows.append(F.struct(F.lit(i).alias("qi"), (h - klo).alias("frac"),
                             F.when(lo_in, F.col(value)).alias("vlo"),
                             F.when(hi_in, F.col(value)).alias("vhi")))
    hits = ri.select(*groups, "_n", F.explode(F.filter(
        F.array(*rows), lambda s: s["vlo"].isNotNull() | s["vhi"].isNotNull())).alias("s"))
    per_q = hits.groupBy(*groups, "_n", F.col("s.qi").alias("qi")).agg(
        F.max("s.frac").alias("frac"), F.max("s.vlo").alias("vlo"), F.max("s.vhi").alias("vhi"))
    q = F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")
    return per_q.groupBy(*groups).agg(
        F.max("_n").alias("n"),
        *[F.max(F.when(F.col("qi") == i, q)).alias(f"q{i}") for i in range(len(probs))])


def quantiles(df: DataFrame, groups, value: str, probs, weight: str | None = None,
              partitions: int | None = None, approx: bool = False,
              accuracy: int = 10000, preaggregate: bool = True) -> DataFrame:
    """Linear-interpolated quantiles (same definition as numpy ``percentile``
    and SQL ``quantile_cont``) per group: one row per group with ``n`` (the
    group's count) and columns ``q0, q1, ...`` in the order of ``probs``.

    ``weight`` (a non-negative integer column) repeats each row that many
    times, as the bootstrap needs.

    ``preaggregate=False`` skips counting rows per (group, value) first: rank
    intervals are exact with repeated values too (each copy gets its own
    consecutive interval), and for nearly unique values the count is an
    expensive aggregate that removes nothing. Only for nearly unique values:
    range bounds cannot split rows with equal keys, so one value repeated in
    a third of the rows would land in one piece.

    ``approx=True`` uses ``percentile_approx`` instead: one partial-aggregated
    sketch per group and task (bounded memory, relative rank error about
    1/accuracy), no range partitioning; for very large inputs where exact
    interpolated quantiles are not required. Unweighted only.
    """
    groups = _list(groups)
    if approx:
        if weight:
            raise ValueError("approx quantiles are unweighted")
        q = F.percentile_approx(F.col(value), [float(p) for p in probs], accuracy)
        g = df.filter(F.col(value).isNotNull()).groupBy(*groups)
        r = g.agg(F.count(F.lit(1)).alias("n"), q.alias("_q"))
        return r.select(*groups, "n", *[F.col("_q")[i].cast("double").alias(f"q{i}")
                                        for i in range(len(probs))])
    if preaggregate:
        vc = value_counts(df, groups, value, weight)
    else:
        w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
        vc = df.filter(F.col(value).isNotNull()).select(*groups, value, w.alias("_w"))
    vc = vc.filter(F.col("_w") > 0)
    return _pick(rank_intervals(vc, groups, value, "_w", partitions), groups, value, probs)


def positions(df: DataFrame, order_cols, groups=None, name: str = "pos",
              partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order_cols`` order within its group,
    computed piecewise (no group in one task). ``order_cols`` must make rows
    unique within a group for positions to be deterministic. ``name`` must not
    be one of the helper columns ``_k``, ``_one``, ``_hi``, ``_n``."""
    groups = _list(groups)
    key = F.struct(*[F.col(c) for c in order_cols])
    t = df.withColumn("_k", key).withColumn("_one", F.lit(1).cast("bigint"))
    ri = rank_intervals(t, groups, "_k", "_one", partitions)
    return ri.withColumnRenamed("_lo", name).drop("_k", "_one", "_hi", "_n")


def dense_codes(df: DataFrame, col: str, name: str = "code", partitions: int | None = None) -> DataFrame:
    """Codes 0..d-1 for the sorted distinct non-null values of ``col``; null -> -1.

    The dictionary is built and ranked piecewise and joined back by value
    (AQE broadcasts it when it turns out small).
    """
    d = df.select(col).filter(F.col(col).isNotNull()).distinct()
    codes = positions(d, [col], None, name, partitions).select(col, name)
    return df.join(codes, col, "left").withColumn(name, F.coalesce(F.col(name), F.lit(-1)).cast("int"))
