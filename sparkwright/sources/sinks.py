"""Sinks and inspection (K1-K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 20) -> None:
    """Print the first n rows (K1); never collects the whole frame."""
    df.show(n, truncate=False)


def write_outputs(outputs: dict, root: str, month: str | None = None, fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """Write named outputs under ``root/<name>`` (K2, K4); with ``month``, as a
    partition ``month=<month>`` so a later read of one month prunes the rest.
    With dynamic partition overwrite only that month's folder is replaced."""
    from pyspark.sql import functions as F
    for name, df in outputs.items():
        w = df
        if month is not None:
            w = df.withColumn("month", F.lit(month))
        writer = w.write.mode(mode).format(fmt)
        if month is not None:
            writer = writer.partitionBy("month").option("partitionOverwriteMode", "dynamic")
        writer.save(f"{root.rstrip('/')}/{name}")


def write_parts(df: DataFrame, path: str, by, fmt: str = "parquet") -> None:
    """All outputs of a frame in one pass, one folder per value of the columns ``by`` (K2, K4): the named outputs are values
    of a column, so what they share is computed once. Folders of values that do not occur in ``df`` stay as they are
    (dynamic overwrite), so a rerun of a month replaces that month alone."""
    by = [by] if isinstance(by, str) else list(by)
    df.write.mode("overwrite").format(fmt).partitionBy(*by).option("partitionOverwriteMode", "dynamic").save(path)


def read_parts(spark, path: str, fmt: str = "parquet", **values) -> DataFrame:
    """The folders of ``write_parts`` with the given values (S12); the others are not listed as input."""
    from pyspark.sql import functions as F
    df = spark.read.format(fmt).load(path)
    for c, v in values.items():
        df = df.where(F.col(c) == v)
    return df


def write_sorted(df: DataFrame, path: str, keys, fmt: str = "csv") -> None:
    """Globally sorted output (K3): range-partitioned sort, files in key order."""
    df.orderBy(*keys).write.mode("overwrite").format(fmt).option("header", True).save(path)


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs of a frame (K5, metadata only)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
