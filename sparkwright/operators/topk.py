"""Ordering, top-k and row-limit operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(keys, descending: bool) -> list[Column]:
    out = []
    for k in keys:
        c = F.col(k) if isinstance(k, str) else k
        out.append(c.desc() if descending else c.asc())
    return out


def top_k(df: DataFrame, keys, k: int = 10, descending: bool = True, tie_break=None) -> DataFrame:
    """The k first rows by ``keys`` (plus ``tie_break`` ascending for determinism).

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every task keeps
    its own k best rows and only k x tasks rows reach the final merge, so no
    full sort and no shuffle of the data.
    """
    order = _order(keys, descending) + [F.col(t).asc() for t in (tie_break or [])]
    return df.orderBy(*order).limit(k)


def with_rank(df: DataFrame, order_cols, name: str = "rank") -> DataFrame:
    """Number a bounded (already limited) frame 1..n in order."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order_cols)))


def sort_by(df: DataFrame, *cols) -> DataFrame:
    """Total order (range-partitioned sort; sampled bounds spread hot keys)."""
    return df.orderBy(*cols)
