"""Type profiling and optimisation.

All statistics of all columns come from two aggregate passes over the
table (plain aggregates, distinct counts), each covering every column; the
rewritten table is a ``select`` of casts, and category codes are a
dictionary join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.operators import quantiles as Q
from sparkwright.operators.distinct import distinct_counts

# Fixed values --------------------------------------------------------------
CATEGORY_RATIO = 0.5                  # strings with distinct/total below this become categories
UNSIGNED = [("uint8", 255), ("uint16", 65535), ("uint32", 4294967295), ("uint64", 18446744073709551615)]
SIGNED = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
FLOAT32_MAX = 3.4028234663852886e38
FIXED_WIDTH = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
               "boolean": 1, "date": 4, "timestamp": 8, "timestamp_ntz": 8}
# ---------------------------------------------------------------------------

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def _kind(dt):
    if isinstance(dt, _INTS):
        return "int"
    if isinstance(dt, _FLOATS):
        return "float"
    if isinstance(dt, T.StringType):
        return "string"
    return "other"


def column_stats(df: DataFrame, approx_distinct: bool = False, distinct: str = "all") -> DataFrame:
    """One row per column: column_name, data_type, n_rows, n_nulls, min_value,
    max_value (numeric only, as doubles), min_int, max_int (integers only,
    exact), n_distinct (non-null), bytes, f32_exact. ``distinct="string"``
    counts the distinct values of string columns only (null for the others).

    Two passes, each over all columns at once: the plain aggregates, and the distinct counts
    (each task's distinct values, shuffled once; see ``distinct``). The results are joined on the
    column name.
    """
    aggs, dis, names = [F.count(F.lit(1)).alias("_rows")], [], []
    for i, f in enumerate(df.schema.fields):
        c, k = F.col(f"`{f.name}`"), _kind(f.dataType)
        names.append((i, f))
        aggs.append(F.count(c).alias(f"nn{i}"))
        if distinct == "all" or k == "string":
            dis.append(f.name)
        if k in ("int", "float"):
            aggs += [F.min(c).alias(f"mn{i}"), F.max(c).alias(f"mx{i}")]
        if k == "float":
            aggs.append(F.min(F.when(c.isNull() | F.isnan(c), F.lit(True))
                              .otherwise(c.cast("float").cast("double") == c)).alias(f"fx{i}"))
        if k == "string":
            aggs.append(F.sum(F.octet_length(c)).alias(f"ob{i}"))
    row = df.agg(*aggs)
    rows = []
    for i, f in names:
        k, t = _kind(f.dataType), f.dataType.simpleString()
        width = FIXED_WIDTH.get(t)
        b = F.col(f"ob{i}") if k == "string" else (F.col("_rows") * width if width else F.lit(None))
        rows.append(F.struct(
            F.lit(f.name).alias("column_name"), F.lit(t).alias("data_type"),
            F.col("_rows").alias("n_rows"), (F.col("_rows") - F.col(f"nn{i}")).alias("n_nulls"),
            (F.col(f"mn{i}") if k in ("int", "float") else F.lit(None)).cast("double").alias("min_value"),
            (F.col(f"mx{i}") if k in ("int", "float") else F.lit(None)).cast("double").alias("max_value"),
            (F.col(f"mn{i}") if k == "int" else F.lit(None)).cast("bigint").alias("min_int"),
            (F.col(f"mx{i}") if k == "int" else F.lit(None)).cast("bigint").alias("max_int"),
            b.cast("bigint").alias("bytes"),
            (F.col(f"fx{i}") if k == "float" else F.lit(None).cast("boolean")).alias("f32_exact")))
    plain = row.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    out = ["column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value", "min_int", "max_int",
           "n_distinct", "bytes", "f32_exact"]
    if not dis:
        return plain.withColumn("n_distinct", F.lit(None).cast("bigint")).select(*out)
    if approx_distinct:
        counted = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"nd{k}") for k, c in enumerate(dis)])
        counts = counted.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(f"nd{k}").alias("n_distinct")) for k, c in enumerate(dis)])).alias("s")).select("s.*")
    else:
        counts = distinct_counts(df, dis).select("column_name", "n_distinct")
    return plain.join(counts, "column_name", "left").select(*out)


def _after_type(kind: str):
    """Column expressions for the reference's narrowed type and our Spark type."""
    mn, mx = F.col("min_value"), F.col("max_value")
    if kind == "int":
        mn, mx = F.col("min_int"), F.col("max_int")
        ref = F.lit("int64")
        for name, hi in reversed(UNSIGNED):
            ref = F.when((mn >= 0) & (mx <= min(hi, (1 << 63) - 1)), F.lit(name)).otherwise(ref)
        ref = F.when(mn.isNull(), F.lit("int64")).otherwise(ref)
        spark_t = F.lit("bigint")
        for name, lo, hi in reversed(SIGNED):
            spark_t = F.when((mn >= lo) & (mx <= hi), F.lit(name)).otherwise(spark_t)
        return ref, F.when(mn.isNull(), F.lit("bigint")).otherwise(spark_t)
    if kind == "float":
        fits = mn.isNull() | ((F.abs(mn) <= FLOAT32_MAX) & (F.abs(mx) <= FLOAT32_MAX))
        return (F.when(fits, F.lit("float32")).otherwise(F.lit("float64")),
                F.when(fits, F.lit("float")).otherwise(F.lit("double")))
    ratio = (F.col("n_distinct") + (F.col("n_nulls") > 0).cast("int")) / F.col("n_rows")
    return (F.when(ratio < CATEGORY_RATIO, F.lit("category")).otherwise(F.lit("object")),
            F.when(ratio < CATEGORY_RATIO, F.lit("string+code")).otherwise(F.lit("string")))


def type_plan(df: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """(column_name, before, after, spark_type): the narrowed type of every
    int, float and string column (M17). Ints narrow to unsigned only when no
    value is negative; floats to float32 whenever they fit in its range;
    strings become categories when distinct/total < 0.5 (null counts)."""
    st = stats if stats is not None else column_stats(df, distinct="string")
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    after = spark_type = F.lit(None).cast("string")
    for kind in ("int", "float", "string"):
        own = F.col("column_name").isin([c for c, k in kinds.items() if k == kind])
        ref, sp = _after_type(kind)
        after, spark_type = F.when(own, ref).otherwise(after), F.when(own, sp).otherwise(spark_type)
    return st.filter(F.col("column_name").isin([c for c, k in kinds.items() if k != "other"])).select(
        "column_name", F.col("data_type").alias("before"), after.alias("after"), spark_type.alias("spark_type"))


def savings(df: DataFrame) -> DataFrame:
    """Size report of a type plan (A25): per kind of column (int, float, string) the number of
    columns, megabytes before and after in all, and their means per column. Strings count their
    bytes; a category counts 4-byte codes, its dictionary aside."""
    from sparkwright.functions.scalar import round_half_away
    st = column_stats(df, distinct="string")
    kinds = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(_kind(f.dataType)))])
    widths = F.create_map(*[x for t, n in [*FIXED_WIDTH.items(), ("string+code", 4)] for x in (F.lit(t), F.lit(n))])
    both = st.join(type_plan(df, st).select("column_name", "spark_type"), "column_name").select(
        kinds[F.col("column_name")].alias("kind"), "bytes",
        F.when(F.col("spark_type") == "string", F.col("bytes"))
        .otherwise(F.col("n_rows") * widths[F.col("spark_type")]).alias("after"))
    mb = lambda c: round_half_away(c / 1048576.0, 6)
    return both.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_columns"), mb(F.sum("bytes")).alias("mb_before"), mb(F.sum("after")).alias("mb_after"),
        mb(F.avg("bytes")).alias("mean_mb_before"), mb(F.avg("after")).alias("mean_mb_after"))


def apply_types(df: DataFrame, plan_rows, categories: bool = False) -> DataFrame:
    """Rewrite a table with a type plan given as (column, spark_type) pairs
    (a small driver-side dict: one entry per column, not per row). With
    ``categories`` a column planned as a category becomes its ``<col>_code``
    (see ``category_codes``); without, it stays a string."""
    m = dict(plan_rows)
    if categories:
        cats = [f.name for f in df.schema.fields if m.get(f.name) == "string+code"]
        keep = [f"{f.name}_code" if f.name in cats else f.name for f in df.schema.fields]
        return apply_types(category_codes(df, cats).select(*[f"`{c}`" for c in keep]), plan_rows)
    cols = []
    for f in df.schema.fields:
        t = m.get(f.name)
        if t and t not in ("string", "string+code") and t != f.dataType.simpleString():
            cols.append(F.col(f"`{f.name}`").cast(t).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def category_codes(df: DataFrame, cols) -> DataFrame:
    """Add ``<col>_code`` for each column: sorted-dictionary codes from 0, null -> -1."""
    out = df
    for c in cols:
        out = Q.dense_codes(out, c, f"{c}_code")
    return out


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns of each type (A13), from the schema."""
    rows = [(f.dataType.simpleString(),) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "data_type string").groupBy("data_type").count()
