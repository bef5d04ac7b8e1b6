"""Parquet tables of a data set directory (one file or folder per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def register_all(spark: SparkSession, root: str, names=TABLES) -> None:
    """Register every table as a temp view (for ``spark.sql`` jobs)."""
    for n in names:
        table(spark, root, n).createOrReplaceTempView(n)
