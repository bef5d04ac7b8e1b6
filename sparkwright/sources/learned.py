"""Learned types of raw text fields, and the typed re-read.

Every field of a column is tried against all types of a small lattice in one aggregate over all columns, so
learning costs one pass and one row. A column gets the narrowest type that all its fields parse as (or, with a
tolerance, nearly all); the re-read casts with that type and keeps the rows it cannot cast beside the good ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: From narrow to wide; a day is an integer of eight digits (yyyymmdd) that is a calendar day.
LATTICE = ("boolean", "day", "int", "bigint", "double", "date", "timestamp_ntz", "string")
_SHAPES = {"int": r"^[+-]?[0-9]+$", "bigint": r"^[+-]?[0-9]+$", "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}


def _field(c) -> Column:
    """A field without outer blanks; an empty one is null."""
    text = F.trim(c if isinstance(c, Column) else F.col(c))
    return F.when(text != "", text)


def parsed(c, kind: str) -> Column:
    """The field as ``kind``; null if it is empty or does not parse."""
    f = _field(c)
    if kind == "string":
        return f
    if kind == "boolean":
        low = F.lower(f)
        return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
    if kind == "day":
        return F.when(f.rlike("^[0-9]{8}$"), F.try_to_timestamp(f, F.lit("yyyyMMdd")).cast("date"))
    value = f.try_cast(kind)
    return F.when(f.rlike(_SHAPES[kind]), value) if kind in _SHAPES else value


def learn_types(raw: DataFrame, tolerance: float = 0.0) -> list[tuple[str, str, int, int]]:
    """(column, type, filled fields, fields that do not parse) of every column of a frame of strings. At most a share
    of ``tolerance`` of the filled fields may not parse; a column without fields is a string. One aggregate; one
    entry per column."""
    aggs = []
    for k, c in enumerate(raw.columns):
        filled = _field(F.col(f"`{c}`")).isNotNull()
        aggs.append(F.count_if(filled).alias(f"n{k}"))
        aggs += [F.count_if(filled & parsed(F.col(f"`{c}`"), t).isNull()).alias(f"{t}{k}") for t in LATTICE[:-1]]
    row, out = raw.agg(*aggs).first(), []
    for k, c in enumerate(raw.columns):
        n = row[f"n{k}"]
        fits = [(t, row[f"{t}{k}"]) for t in LATTICE[:-1] if n and row[f"{t}{k}"] <= tolerance * n]
        kind, bad = fits[0] if fits else ("string", 0)
        out.append((c, kind, n, bad))
    return out


def learned_schema(raw: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """:func:`learn_types` as a frame (column_name, learned_type, n_filled, n_bad)."""
    return raw.sparkSession.createDataFrame(learn_types(raw, tolerance), "column_name string, learned_type string, n_filled long, n_bad long")


def typed_and_rejected(raw: DataFrame, kinds) -> tuple[DataFrame, DataFrame]:
    """Rows cast to ``kinds`` [(column, type)], and the raw rows with a field that does not parse, with the names of
    those columns in ``bad_columns``. No row is lost: every row is in one of the two."""
    kinds = [(c, t) for c, t, *_ in kinds]
    bad = F.filter(F.array(*[F.when(_field(F.col(f"`{c}`")).isNotNull() & parsed(F.col(f"`{c}`"), t).isNull(), F.lit(c))
                             for c, t in kinds if t != "string"] or [F.lit(None).cast("string")]), lambda x: x.isNotNull())
    marked = raw.withColumn("bad_columns", bad)
    good = marked.where(F.size("bad_columns") == 0).select(*[parsed(F.col(f"`{c}`"), t).alias(c) for c, t in kinds])
    return good, marked.where(F.size("bad_columns") > 0)


def read_fields(spark, path: str, names, sep: str = ",", header: bool = False) -> DataFrame:
    """Delimited text as a frame of strings, one column per name; missing fields are null, further ones left out."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return spark.read.schema(schema).option("sep", sep).option("mode", "PERMISSIVE").csv(path, header=header)
