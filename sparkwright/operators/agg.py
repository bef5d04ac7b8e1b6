"""Keyed aggregates (count / min / max / sum / integer mean / shares).

All of these are algebraic: Spark runs a partial aggregate in every map task
and shuffles at most one row per key per task, so a key holding a third of all
rows costs no more than any other key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(c):
    return [c] if isinstance(c, (str, Column)) else list(c)


def count_values(df: DataFrame, key, name: str = "count") -> DataFrame:
    """Number of rows per distinct value of ``key`` (A1/A2)."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias(name))


def min_by_key(df: DataFrame, key, value: str, name: str = "min_value") -> DataFrame:
    """Minimum of ``value`` per key (A3)."""
    return df.groupBy(*_cols(key)).agg(F.min(value).alias(name))


def max_by_key(df: DataFrame, key, value: str, name: str = "max_value") -> DataFrame:
    """Maximum of ``value`` per key (A4)."""
    return df.groupBy(*_cols(key)).agg(F.max(value).alias(name))


def sum_by_key(df: DataFrame, key, value: str, name: str = "total",
               count_name: str | None = None) -> DataFrame:
    """Sum (in DOUBLE for floating input) per key, optionally with the count."""
    v = F.col(value)
    aggs = [F.sum(v).alias(name)]
    if count_name:
        aggs.append(F.count(v).alias(count_name))
    return df.groupBy(*_cols(key)).agg(*aggs)


def int_mean(df: DataFrame, key, value: str, name: str = "mean") -> DataFrame:
    """Integer mean per key: sum div count, truncating toward zero."""
    # `div` truncates toward zero like JVM integer division; an all-null
    # group gives null (try_divide semantics), not an error.
    return df.groupBy(*_cols(key)).agg(
        F.expr(f"sum(CAST(`{value}` AS BIGINT)) div nullif(count(`{value}`), 0)").alias(name))


def max_row(df: DataFrame, order_cols, name: str = "best") -> DataFrame:
    """Single row with the largest tuple ``order_cols`` (ties go to later columns)."""
    s = F.max(F.struct(*[F.col(c) for c in order_cols])).alias(name)
    return df.agg(s).select(*[F.col(f"{name}.{c}").alias(c) for c in order_cols])


def rate_by(df: DataFrame, key, outcome: Column | str, name: str = "rate") -> DataFrame:
    """Mean of a 0/1 outcome per key (A9); nulls are skipped."""
    o = F.col(outcome) if isinstance(outcome, str) else outcome
    return df.groupBy(*_cols(key)).agg(F.avg(o.cast("double")).alias(name))


def share(counts: DataFrame, count_col: str = "count", name: str = "share") -> DataFrame:
    """Percentage share of each row of an already aggregated frame.

    Only for aggregated rows (a handful of classes): the empty window brings
    them into one task, which is fine for a bounded class count.
    """
    total = F.sum(F.col(count_col)).over(Window.partitionBy())
    return counts.withColumn(name, F.lit(100.0) * F.col(count_col) / total)


def cumulative_share(shares: DataFrame, order_cols, share_col: str = "share",
                     start: str = "angle_start", end: str = "angle_end") -> DataFrame:
    """Running share as pie-slice bounds in radians (W5), on aggregated rows."""
    w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    two_pi = 2.0 * 3.141592653589793
    run = F.sum(F.col(share_col)).over(w) / 100.0
    return (shares.withColumn(end, run * two_pi)
            .withColumn(start, F.col(end) - F.col(share_col) / 100.0 * two_pi))


def n_distinct_all(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct count of every column; null counts as one value (A11). Exact counts move each task's distinct
    values once (see ``distinct``); with ``approx`` sketches are used."""
    if approx:
        return df.agg(*[(F.approx_count_distinct(F.col(f"`{c}`")) + F.coalesce(F.max(F.col(f"`{c}`").isNull().cast("int")), F.lit(0)))
                        .cast("bigint").alias(c) for c in df.columns])
    from sparkwright.operators.distinct import distinct_values
    counted = distinct_values(df).groupBy("place").agg(F.count(F.lit(1)).alias("n"))  # one row per column
    return counted.agg(*[F.coalesce(F.max(F.when(F.col("place") == k, F.col("n"))), F.lit(0)).cast("bigint").alias(c)
                         for k, c in enumerate(df.columns)])


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")
