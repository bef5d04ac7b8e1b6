"""Keyed combine with a function of the user."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

#: Rows of partial results that a task holds before it passes them on.
HELD = 200_000


def combine(df: DataFrame, keys, fn: Callable, schema: str) -> DataFrame:
    """``fn`` applied to the rows of each key, in parts: a pandas frame of any keys in, a pandas frame of the same
    columns (``schema``, which must hold the keys) with the combined rows of those keys out.

    ``fn`` must be associative: fn(concat(fn(a), fn(b))) equals fn(concat(a, b)) for any split of the rows, and must not
    depend on their order. Each task folds its batches into one partial result, which is all that is shuffled, so a key that
    holds a third of all rows costs a few rows per task. Null keys are one key (``fn`` should group with
    ``dropna=False``). Columns of ``df`` that the schema does not name are not read.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    import pyspark.sql.types as T
    fields = T._parse_datatype_string(schema)
    missing = set(keys) - set(fields.fieldNames())
    if missing:
        raise ValueError(f"schema lacks the keys {sorted(missing)}")

    def partial(batches):
        import pandas as pd
        held, limit = None, HELD
        for pdf in batches:
            if not len(pdf):
                continue
            held = fn(pdf if held is None else pd.concat([held, pdf], ignore_index=True))
            if len(held) > limit:
                yield held
                held = None
        if held is not None:
            yield held

    rows = df.select(*[df[f"`{c}`"] for c in fields.fieldNames()]).mapInPandas(partial, fields)
    return rows.groupBy(*keys).applyInPandas(fn, fields)
