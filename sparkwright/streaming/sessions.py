"""Sessions over a stream (optional extension; the reference's sessions are batch).

``session_counts`` is the Structured Streaming form of W2/W3: gap-based
session windows per key with a watermark bounding the state kept for late
rows. A row exactly ``gap`` after the previous one stays in the session, one
more second starts a new one (same rule as the batch ``sessionize``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, key: str, ts: str, gap_seconds: int,
                   watermark: str = "1 hour") -> DataFrame:
    """(key, session_start, session_end, n) per gap-based session; works on a
    streaming or a batch frame. Session end = last event time + gap."""
    src = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        src = src.withWatermark(ts, watermark)
    w = F.session_window(F.col(ts), f"{int(gap_seconds)} seconds")
    return src.groupBy(key, w.alias("session")).agg(F.count(F.lit(1)).alias("n")) \
        .select(key, F.col("session.start").alias("session_start"),
                F.col("session.end").alias("session_end"), "n")


def start_session_stream(spark, source_dir: str, schema, key: str, ts: str, gap_seconds: int,
                         checkpoint: str, query_name: str, watermark: str = "1 hour",
                         fmt: str = "parquet", sink: str = "memory", output: str | None = None):
    """Run ``session_counts`` over files arriving in ``source_dir``.

    ``checkpoint`` must be a shared folder on a cluster (offsets and state
    survive a restart there). Appends closed sessions once the watermark
    passes them; with ``sink="memory"`` the result is ``spark.table(query_name)``.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)
    out = session_counts(stream, key, ts, gap_seconds, watermark)
    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint) \
        .queryName(query_name).trigger(availableNow=True)
    if sink == "memory":
        return w.format("memory").start()
    return w.format(fmt).option("path", output).start()
