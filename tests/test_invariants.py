"""Invariants on the registered jobs' outputs at sf0.01."""
import math

from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkwright.functions import scalar
from tests.conftest import SF01


def test_monthly_parts_add_up(spark):
    rows = E.queries()["reconcile_monthly"](spark, SF01).collect()
    assert len(rows) == 13
    assert all(r["total"] == r["correct"] + r["incorrect"] + r["missing"] for r in rows)


def test_shares_sum_to_100_and_angles_close(spark):
    rows = E.queries()["reconcile_shares"](spark, SF01).collect()
    assert abs(sum(r["share"] for r in rows) - 100.0) < 1e-4
    assert abs(max(r["angle_end"] for r in rows) - 2 * math.pi) < 1e-5
    s = E.queries()["sentiment_share"](spark, SF01).collect()
    assert abs(sum(r["share"] for r in s) - 100.0) < 1e-4


def test_entropy_bounded_by_log2_distinct(spark):
    ent = E.queries()["doc_entropy"](spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select(
        "doc_id", F.size(F.array_distinct(scalar.py_split(F.col("text")))).alias("d"))
    bad = ent.join(docs, "doc_id").filter(
        (F.col("entropy") < -1e-9) | (F.col("entropy") > F.log2(F.greatest("d", F.lit(1))) + 1e-6))
    assert bad.count() == 0


def test_interpolation_returns_knots_exactly(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    knots = ev.groupBy("user_id", F.unix_date(F.to_date("ts")).cast("double").alias("x")) \
        .agg(F.round(F.avg("value"), 9).alias("ky"))
    out = E.queries()["interpolate_linear"](spark, SF01)
    j = out.join(knots, ["user_id", "x"])
    assert j.count() == knots.count()
    assert j.filter(F.col("y") != F.col("ky")).count() == 0


def test_session_numbers_count_starts(spark):
    s = E.queries()["sessionize"](spark, SF01)
    per_user = s.groupBy("user_id", "day").agg(F.max("session_no").alias("m"), F.sum("session_start_flag").alias("n"))
    assert per_user.filter(F.col("m") != F.col("n")).count() == 0
