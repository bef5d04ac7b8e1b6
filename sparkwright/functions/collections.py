"""Array, map and string helpers (H4-H16, H27-H31) as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_sum(arr: Column, zero=0.0) -> Column:
    """Sum of an array with a higher-order ``aggregate`` (H27 reduce)."""
    return F.aggregate(arr, F.lit(zero), lambda a, x: a + x)


def map_get_or(m: Column, key: str, default) -> Column:
    """Map lookup with a default when the key is missing."""
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def squares_sum(n: Column) -> Column:
    """Sum of k*k for k in 1..n via ``sequence`` + ``transform``."""
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), lambda x: x * x), F.lit(0),
                       lambda a, x: a + x)
