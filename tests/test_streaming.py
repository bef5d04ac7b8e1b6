from pyspark.sql import functions as F

from sparkwright.operators import windows
from sparkwright.streaming import sessions
from tests.conftest import SF001


def test_stream_sessions_match_batch_session_numbers(spark, tmp_path):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    src = str(tmp_path / "in")
    ev.write.parquet(src)
    q = sessions.start_session_stream(spark, src, ev.schema, "user_id", "ts", 900,
                                      str(tmp_path / "ckpt"), "sw_sessions_test", watermark="0 seconds")
    q.awaitTermination(120)
    got = spark.table("sw_sessions_test")
    q.stop()
    # closed sessions are emitted as the watermark passes them; compare the
    # emitted ones with the batch session numbering
    batch = windows.sessionize(ev, ["user_id"], "ts", "event_id", 900)
    per_session = batch.groupBy("user_id", "session_no").agg(
        F.min("ts").alias("session_start"), F.count(F.lit(1)).alias("n"))
    exp = {(r["user_id"], r["session_start"], r["n"]) for r in per_session.collect()}
    rows = {(r["user_id"], r["session_start"], r["n"]) for r in got.collect()}
    assert rows and rows <= exp
    b = sessions.session_counts(ev, "user_id", "ts", 900)
    assert {(r["user_id"], r["session_start"], r["n"]) for r in b.collect()} == exp
