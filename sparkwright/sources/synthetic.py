"""Synthetic columns from counters (S15): a value depends on the seed, the row's key and the draw's number alone.

Each draw is 52 bits of the MD5 of "seed:key:draw", so a column has the same values under any partitioning, on a
retried task and in any engine that has MD5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BITS = 52
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def uniform(key, seed: int, draw) -> Column:
    """Uniform in [0, 1); ``draw`` numbers the draws of a row. A null key reads as the empty string."""
    key = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    draw = draw if isinstance(draw, Column) else F.lit(draw)
    text = F.concat(F.lit(f"{seed}:"), key, F.lit(":"), draw.cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("double") / F.lit(float(1 << _BITS))


def normal(key, seed: int, draw: int = 0) -> Column:
    """Standard normal by Box and Muller, from draws 2 n and 2 n + 1; 1 - u is above 0, so its logarithm exists."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(F.lit(1.0) - uniform(key, seed, 2 * draw)))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, seed, 2 * draw + 1))


def with_random(df: DataFrame, name: str, kind: str, key: str, seed: int = 42, **kw) -> DataFrame:
    """Seeded synthetic column: normal, lognormal(mean, sigma), randint(lo, hi) or letters(min_len, max_len).
    Rows of one key get one value."""
    if kind == "normal":
        c = normal(key, seed)
    elif kind == "lognormal":
        c = F.exp(F.lit(float(kw.get("mean", 1.5))) + F.lit(float(kw.get("sigma", 1.75))) * normal(key, seed))
    elif kind == "randint":
        lo, hi = kw.get("lo", 1), kw.get("hi", 99)
        c = (F.floor(uniform(key, seed, 0) * (hi - lo + 1)) + lo).cast("int")
    elif kind == "letters":
        lo, hi = kw.get("min_len", 1), kw.get("max_len", 10)
        n = (F.floor(uniform(key, seed, 0) * (hi - lo + 1)) + lo).cast("int")
        places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
        letter = F.transform(places, lambda i: F.substring(
            F.lit(LETTERS), (F.floor(uniform(key, seed, i) * 26) + 1).cast("int"), F.lit(1)))
        c = F.when(n < 1, F.lit("")).otherwise(F.array_join(letter, ""))
    else:
        raise ValueError(kind)
    return df.withColumn(name, c)
