"""Sharding: global byte-size prefix sums, cut at equal targets.

Documents are laid out in one global order by a range shuffle of (id, size, checksum) alone;
the texts are not moved. Each range partition gives its total, the totals' prefix sums (one
number per partition) give each partition its offset, and a running sum inside the partition
gives every document its global byte offset. Document i with bytes [o, o + s) goes to shard
floor(n * (2 o + s) / (2 total)): the shard in whose equal slice its middle byte lies. Shards
are contiguous in the order and differ from the target by less than one document at each end.

Order: by checksum and size of the text, then by id. Equal texts (copies) are neighbours, so a group of copies lies in one
shard, but for the groups that a cut goes through: at most one per cut, and those larger than a shard, which no
balanced law can keep whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.llm.common import materialise, shuffle_partitions


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32): UTF-8 bytes plus one and the CRC-32 of the text (null: empty)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))


def byte_shards(sized: DataFrame, n_shards: int = 16) -> DataFrame:
    """Add shard (0 .. n_shards - 1) and slot (gapless from 0 inside a shard, in global order).

    ``sized`` has doc_id, size (at least 1) and text_crc32, as :func:`sizes` gives them. Order:
    checksum, then size, then doc_id (nulls first); rows equal in all three are interchangeable
    and stay separate rows. An empty input gives no rows. A third of all rows with one text is
    spread over the range partitions by a tie-breaking row number.
    """
    order = ["text_crc32", "size", "doc_id", "_tie"]
    spark = sized.sparkSession
    laid = (sized.select("doc_id", "size", "text_crc32", F.monotonically_increasing_id().alias("_tie"))
            .repartitionByRange(shuffle_partitions(spark), *order)
            .withColumn("_part", F.spark_partition_id()))
    laid = materialise(laid, "shard-layout")

    # one row per range partition: bounded by the number of partitions, not by the data
    totals = laid.groupBy("_part").agg(F.sum("size").alias("_bytes"))
    over = Window.orderBy("_part")
    offsets = totals.select(
        "_part", (F.sum("_bytes").over(over) - F.col("_bytes")).alias("_offset"),
        F.sum("_bytes").over(over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_total"))

    in_part = Window.partitionBy("_part").orderBy(*order)
    placed = (laid.join(F.broadcast(offsets), "_part")
              .withColumn("_at", F.col("_offset") + F.sum("size").over(
                  in_part.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
              .withColumn("shard", F.expr(
                  f"cast(((2 * _at + size) * {n_shards}L) div (2 * _total) as int)")))
    # rows of a shard before this partition: one count per (partition, shard)
    counts = placed.groupBy("_part", "shard").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_part", "shard", (F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_part")) - F.col("_n")).alias("_before"))
    slot = F.row_number().over(Window.partitionBy("_part", "shard").orderBy(*order)) - 1
    return (placed.withColumn("_slot", slot).join(F.broadcast(before), ["_part", "shard"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("_before") + F.col("_slot")).cast("long").alias("slot")))
