"""Join operators: name lookup, suffixed left join, matched/missing split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_names(df: DataFrame, dim: DataFrame, on: str, name_cols, missing: str = "null",
               small_left: bool = False) -> DataFrame:
    """Attach dimension columns to ``df`` by key.

    ``missing``: "null" keeps unmatched rows with null names, "drop" removes
    them, "error" fails the job on the first unmatched key.

    ``small_left=True`` is for a left side expected to be small (a top-k
    result): its keys first filter the dimension, so that only the wanted
    dimension rows meet it. The planner broadcasts the keys if its own
    estimate is below the broadcast threshold (a limit or a global aggregate
    is) and shuffles otherwise; nothing is broadcast on the caller's word.
    """
    names = [name_cols] if isinstance(name_cols, str) else list(name_cols)
    d = dim.select(on, *names)
    if small_left:
        d = d.join(df.select(on).distinct(), on, "left_semi")
    if missing == "drop":
        return df.join(d, on, "inner")
    if missing != "error":
        return df.join(d, on, "left")
    # a key absent from the dimension fails the job; a present key whose name
    # is null does not (the marker tells the two apart)
    out = df.join(d.withColumn("_found", F.lit(True)), on, "left")
    fail = F.raise_error(F.concat(F.lit(f"no {names[0]} for {on}="), F.col(on).cast("string")))
    # the check sits in an output column so that column pruning cannot drop it
    return out.withColumn(names[0], F.when(F.col("_found").isNull(), fail).otherwise(F.col(names[0]))) \
        .drop("_found")


def left_join_suffixed(left: DataFrame, right: DataFrame, on, suffixes=("_x", "_y")) -> DataFrame:
    """Left outer equi-join; columns present on both sides (other than keys) get suffixes."""
    keys = [on] if isinstance(on, str) else list(on)
    shared = (set(left.columns) & set(right.columns)) - set(keys)
    lx = left.select(*[F.col(f"`{c}`").alias(c + suffixes[0] if c in shared else c)
                       for c in left.columns])
    ry = right.select(*[F.col(f"`{c}`").alias(c + suffixes[1] if c in shared else c)
                        for c in right.columns])
    return lx.join(ry, keys, "left")


def split_matched(joined: DataFrame, right_col: str) -> tuple[DataFrame, DataFrame]:
    """Split a left-joined frame by ``right_col`` being null.

    A matched row whose right column is itself null counts as missing too, so
    this is two filters of the same frame, not an anti join.
    """
    c = F.col(f"`{right_col}`")
    return joined.filter(c.isNotNull()), joined.filter(c.isNull())


def agree_flag(a: Column, b: Column) -> Column:
    """1 when both sides are equal and non-null, else 0 (null never agrees)."""
    return F.coalesce((a == b).cast("int"), F.lit(0))


def schema_table(df: DataFrame, spark=None) -> DataFrame:
    """(column, type) rows of a frame's schema (K5); built from metadata only."""
    s = spark or df.sparkSession
    return s.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                             "column_name string, data_type string")


def compare_types(before: DataFrame, after: DataFrame) -> DataFrame:
    """Side-by-side types of two versions of a table, joined by column name."""
    b = schema_table(before).withColumnRenamed("data_type", "before")
    a = schema_table(after).withColumnRenamed("data_type", "after")
    return b.join(a, "column_name", "full")
