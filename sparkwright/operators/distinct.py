"""Distinct counts of all columns without a copy of every row per column.

``count_distinct`` of several columns makes Spark expand each row once per column. Here each task reduces
its own batches to the distinct values of every column (Arrow's hash tables, one column at a time), and
only those (column, value) pairs are shuffled, once. A value of more than 32 bytes travels as its SHA-256.

For repeated profiles, :func:`sketches` stores one HyperLogLog sketch per group and column; sketches of any groups
merge into those of their union (:func:`merged`), so a table that grows by months is never read twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Distinct values of a column that a task holds before it passes them on.
HELD = 200_000
#: Buckets of a sketch, as a power of two: a standard error of about 0.8 %.
SKETCH_BITS = 14


def _flat(df: DataFrame, names) -> DataFrame:
    """The columns by number; nested ones as JSON, which tells their values apart."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(F.to_json(F.struct(F.col(f"`{c}`").alias("v"))) if isinstance(kinds[c], nested) else F.col(f"`{c}`"))
                       .alias(f"c{k}") for k, c in enumerate(names)])


def distinct_values(df: DataFrame, names=None) -> DataFrame:
    """(place, value) of every distinct value of the named columns, null included, by the column's place in
    ``names``. 0.0 and -0.0 are one value, and so are all NaN, as in SQL."""
    names = list(df.columns if names is None else names)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def passed_on(k, values):
            if values.null_count or not pa.types.is_binary(values.type):
                text = values if pa.types.is_binary(values.type) else values.cast(pa.string()).cast(pa.binary())
            else:
                text = values
            return pa.RecordBatch.from_arrays([pa.array([k] * len(text), pa.int32()), text], ["place", "value"])

        held = [None] * len(names)
        for b in batches:
            for k in range(len(names)):
                own = b.column(k)
                if pa.types.is_floating(own.type):
                    own = pc.add(own, 0.0)
                new = pc.unique(own)
                held[k] = new if held[k] is None else pc.unique(pa.concat_arrays([held[k], new]))
                if len(held[k]) > HELD:
                    yield passed_on(k, held[k])
                    held[k] = None
        for k, values in enumerate(held):
            if values is not None and len(values):
                yield passed_on(k, values)

    rows = _flat(df, names).mapInArrow(run, "place int, value binary")
    # a tag keeps a short value apart from a digest
    short = F.when(F.octet_length("value") > 32, F.concat(F.lit("#").cast("binary"), F.unhex(F.sha2("value", 256)))) \
        .otherwise(F.concat(F.lit("=").cast("binary"), F.col("value")))
    return rows.select("place", short.alias("value")).distinct()


def distinct_counts(df: DataFrame, names=None) -> DataFrame:
    """(column_name, n_distinct, n_null): non-null distinct values of each column, and 1 if it has nulls."""
    names = list(df.columns if names is None else names)
    counted = distinct_values(df, names).groupBy("place").agg(
        F.count("value").alias("n_distinct"), F.count_if(F.col("value").isNull()).alias("n_null"))
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "place int, column_name string")
    return every.join(counted, "place", "left").select(
        "column_name", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), F.coalesce("n_null", F.lit(0)).alias("n_null"))


def sketches(df: DataFrame, by, names=None) -> DataFrame:
    """(by ..., column_name, sketch): a mergeable distinct-count sketch of every column in every group; nulls
    are not counted. One pass, one partial aggregate per group and task."""
    by = [by] if isinstance(by, str) else list(by)
    names = [c for c in (df.columns if names is None else names) if c not in by]
    flat = df.select(*[F.col(f"`{c}`") for c in by], *[
        F.col(f"`{c}`").cast("string").alias(f"_c{k}") for k, c in enumerate(names)])
    made = flat.groupBy(*[f"`{c}`" for c in by]).agg(*[
        F.hll_sketch_agg(f"_c{k}", F.lit(SKETCH_BITS)).alias(f"_s{k}") for k in range(len(names))])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_s{k}").alias("sketch")) for k, c in enumerate(names)])
    return made.select(*[F.col(f"`{c}`") for c in by], F.explode(rows).alias("_r")).select(
        *[F.col(f"`{c}`") for c in by], "_r.column_name", "_r.sketch")


def merged(stored: DataFrame, by=()) -> DataFrame:
    """(by ..., column_name, n_distinct): estimates for unions of stored sketches."""
    by = [by] if isinstance(by, str) else list(by)
    return stored.groupBy(*by, "column_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
