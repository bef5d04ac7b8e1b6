"""Readers for the reference's input formats (S1-S12; learned types: ``learned``; S15: ``synthetic``).

All readers are lazy DataFrame scans; parsing is column expressions over
``spark.read.text`` (so splits and partition pruning stay Spark's), never a
Python line parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value STRING`` (S1); CR LF endings are stripped."""
    return spark.read.text(path)


def _field(parts: Column, pos: int, dtype: str, on_error: str) -> Column:
    raw = F.get(parts, pos)
    if on_error == "fail":  # a line without the field fails, as a bad number does
        raw = F.when(F.size(parts) > pos, raw).otherwise(F.raise_error(F.concat(
            F.lit(f"no field {pos} in line: "), F.array_join(parts, ","))))
    if dtype == "string":
        return raw
    return raw.cast(dtype) if on_error == "fail" else raw.try_cast(dtype)


def read_delimited(spark: SparkSession, path: str, fields, sep: str = ",",
                   on_error: str = "fail") -> DataFrame:
    """Headerless delimited lines; ``fields`` = [(name, type, position)] picks
    positional fields and ignores the rest (S2, S3).

    ``on_error="fail"`` raises on a bad number (ANSI cast) or a line too short
    for a field, ``"drop"`` drops the line. Lines with extra columns are
    accepted (unlike CSV FAILFAST).
    """
    return parse_delimited(spark.read.text(path), fields, sep, on_error)


def parse_delimited(lines: DataFrame, fields, sep: str = ",", on_error: str = "fail",
                    col: str = "value") -> DataFrame:
    """The rows of ``lines`` as ``read_delimited`` reads them from a file."""
    import re
    parts = F.split(F.col(col), re.escape(sep))
    df = lines.select(*[_field(parts, pos, t, on_error).alias(n) for n, t, pos in fields])
    if on_error == "drop":
        df = df.dropna()
    return df


def parse_dimension(lines: DataFrame, order_cols, col: str = "value", sep: str = "|", key: str = "id",
                    name: str = "name") -> DataFrame:
    """id -> name from delimited lines (S4): lines with at most one field or a
    non-integer id are dropped; of a duplicated id the last line by
    ``order_cols`` wins (an algebraic ``max_by``, partial per task)."""
    import re
    parts = F.split(F.col(col), re.escape(sep))
    rows = lines.filter(F.size(parts) > 1).select(
        F.get(parts, 0).try_cast("int").alias(key), F.get(parts, 1).alias(name), *order_cols)
    rows = rows.filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.max_by(name, F.struct(*order_cols)).alias(name))


def read_dimension(spark: SparkSession, path: str, sep: str = "|", key: str = "id",
                   name: str = "name") -> DataFrame:
    """id -> name lookup file (S4): invalid UTF-8 reads as U+FFFD, lines with
    at most one field are dropped, the last line of a duplicated id wins.

    "Last" is by position in the file: file name, then offset within it.
    """
    raw = spark.read.text(path).select(
        "value", F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_pos"))
    return parse_dimension(raw, ["_f", "_pos"], "value", sep, key, name)


def parse_quoted_names(lines: DataFrame, col: str = "value", key: str = "id",
                       name: str = "name") -> DataFrame:
    """Lines ``<id> "<name>"`` to (id, name); lines without a quote are dropped."""
    parts = F.split(F.col(col), '"')
    return lines.filter(F.size(parts) > 1).select(
        F.trim(F.get(parts, 0)).try_cast("int").alias(key), F.get(parts, 1).alias(name)) \
        .filter(F.col(key).isNotNull())


def read_labelled(spark: SparkSession, path: str, label: str = "label", feature: str = "feature",
                  out: str = "features") -> DataFrame:
    """``label,feature`` lines to (label, features vector)."""
    from pyspark.ml.feature import VectorAssembler
    df = read_delimited(spark, path, [(label, "double", 0), (feature, "double", 1)])
    return VectorAssembler(inputCols=[feature], outputCol=out).transform(df).select(label, out)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and inferred types (S8): costs an extra pass; prefer a schema."""
    return spark.read.csv(path, header=True, inferSchema=True)


def read_csv_named(spark: SparkSession, path: str, names) -> DataFrame:
    """CSV without header, column names supplied."""
    return spark.read.csv(path, header=False, inferSchema=True).toDF(*names)


def read_typed(spark: SparkSession, path: str, schema: T.StructType, date_cols=(),
               date_format: str = "yyyyMMdd", header: bool = True) -> DataFrame:
    """CSV re-read with learned types (no inference pass); integer-coded dates
    in ``date_cols`` become DATE (S10, H22)."""
    s = T.StructType([T.StructField(f.name, T.StringType() if f.name in date_cols else f.dataType)
                      for f in schema.fields])
    df = spark.read.schema(s).csv(path, header=header)
    for c in date_cols:
        df = df.withColumn(c, F.to_date(F.col(c), date_format))
    return df


def read_jdbc_range(spark: SparkSession, url: str, table: str, col: str, lo: str, hi: str,
                    properties: dict | None = None) -> DataFrame:
    """Database table restricted to a half-open range ``lo <= col < hi`` (S11, F8);
    the filter is pushed into the database query."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r.load().filter((F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi)))


def read_month(spark: SparkSession, root: str, month: str, col: str = "month") -> DataFrame:
    """Results written per month, read back for one month (S12): the filter on
    the partition column prunes every other month's files."""
    return spark.read.parquet(root).filter(F.col(col) == month)


def read_json_declared(spark: SparkSession, path: str, schema: str, rescue: str = "_rescue") -> DataFrame:
    """JSON lines with a declared (nested) schema (S16). A line that is no JSON or does not fit has its text in
    ``rescue`` and nulls elsewhere; nothing is inferred, so there is no second pass."""
    return spark.read.schema(f"{schema}, {rescue} string").option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", rescue).json(path)
