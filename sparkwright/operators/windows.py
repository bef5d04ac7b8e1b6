"""Ordered per-key scans that survive a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task, so
a key holding a third of all rows becomes a third of the job in one task.
Here a key is cut into pieces, each piece is scanned with an ordinary window,
and a small summary table (one row per key and piece) carries the state across
piece boundaries: the last timestamp for ``lag``, the running total for sums.

``sessionize`` cuts by time (key and time bucket), which is known from the row
itself: the rows are hash-shuffled once by key and bucket for the scan and the
join that brings the summary back; the summary reads a copy of key and time.
Keys of bounded size need no pieces: one shuffle and a plain window. ``running_sum`` and ``replay_ledger`` take any
order, so their pieces are sampled ranges of (key, order) (the ledger with a minimum: ``ledger``); the ranged rows are
written once to the shared folder, because two separately planned range
exchanges would sample their bounds separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkwright.operators import ledger
from sparkwright.session import write_shared

_UNB = Window.unboundedPreceding


def _list(x):
    return [x] if isinstance(x, str) else list(x)


def join_back(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (a null key is a group of
    its own, as in ``Window.partitionBy``); keeps the left key columns."""
    ren = {k: f"_r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[ren[k]])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ren.values())


def _ranged(df: DataFrame, keys, order, partitions: int | None) -> DataFrame:
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, *keys, *order).withColumn("_pid", F.spark_partition_id())


def sessionize(df: DataFrame, keys, ts: str, tie: str, gap_seconds: float,
               partitions: int | None = None, flag: str = "session_start_flag",
               number: str = "session_no", prev: str = "prev_ts_us",
               bucket_seconds: float | None = 86_400) -> DataFrame:
    """Session start flags and running session numbers per key.

    A row starts a session when it has no previous row of its key, or when
    the gap to the previous row (ordered by ts, then ``tie``) is strictly
    greater than ``gap_seconds``. ``number`` is the running count of starts
    (ROWS UNBOUNDED PRECEDING .. CURRENT ROW). ``prev`` is the previous row's
    time in epoch microseconds. ``ts`` may be a timestamp (with or without
    zone) or epoch seconds. A null key is a key of its own.

    A task holds the rows of a key within ``bucket_seconds``; a smaller bucket
    cuts a hot key finer and makes the summary larger. None: keys are of
    bounded size (a customer's day), one task may hold a whole key, and the
    rows are shuffled once. ``partitions`` fixes the number of shuffle partitions.
    """
    from sparkwright.functions.scalar import epoch_micros
    keys = _list(keys)
    gap = int(round(gap_seconds * 1_000_000))
    t = epoch_micros(ts, df.schema[ts].dataType)
    if bucket_seconds is None:
        w = Window.partitionBy(*keys).orderBy("_t", tie)
        start = F.when(F.col(prev).isNull() | (F.col("_t") - F.col(prev) > gap), 1).otherwise(0)
        r = df.repartition(partitions, *keys) if partitions else df
        return (r.withColumn("_t", t).withColumn(prev, F.lag("_t").over(w)).withColumn(flag, start)
                .withColumn(number, F.sum(flag).over(w.rowsBetween(_UNB, Window.currentRow))).drop("_t"))
    bucket = int(bucket_seconds * 1_000_000)
    # a struct is never null, and its null fields compare as equal: one key for shuffle, window and join
    r = df.withColumn("_t", t).withColumn("_k", F.struct(*keys)) \
        .withColumn("_b", F.coalesce(F.col("_t") - F.pmod("_t", F.lit(bucket)), F.lit(-(1 << 62))))
    if partitions:
        r = r.repartition(partitions, "_k", "_b")
    w = Window.partitionBy("_k", "_b").orderBy("_t", tie)
    r = (r.withColumn("_prev", F.lag("_t").over(w))
          .withColumn("_f", F.when(F.col("_prev").isNull()
                                   | (F.col("_t") - F.col("_prev") > gap), 1).otherwise(0))
          .withColumn("_loc", F.sum("_f").over(w.rowsBetween(_UNB, Window.currentRow))))
    b = r.groupBy("_k", "_b").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                                  F.sum("_f").alias("_nf"))
    wb = Window.partitionBy("_k").orderBy("_b")
    b = (b.withColumn("_prev_last", F.lag("_last").over(wb))
          .withColumn("_cont", (F.col("_prev_last").isNotNull()
                                & (F.col("_first") - F.col("_prev_last") <= gap)).cast("int"))
          .withColumn("_base", F.coalesce(
              F.sum(F.col("_nf") - F.col("_cont")).over(wb.rowsBetween(_UNB, -1)), F.lit(0)))
          .select("_k", F.col("_b").alias("_b2"), "_prev_last", "_cont", "_base"))
    b = b.withColumnRenamed("_k", "_k2")
    out = r.join(b, (F.col("_k") == F.col("_k2")) & (F.col("_b") == F.col("_b2")))
    first = F.col("_prev").isNull()
    return (out.withColumn(prev, F.coalesce("_prev", "_prev_last"))
               .withColumn(flag, F.when(first, 1 - F.col("_cont")).otherwise(F.col("_f")))
               .withColumn(number, (F.col("_base") + F.col("_loc") - F.col("_cont")).cast("bigint"))
               .drop("_t", "_k", "_b", "_k2", "_b2", "_prev", "_f", "_loc", "_prev_last", "_cont", "_base"))


def running_sum(df: DataFrame, keys, order, value: str, name: str = "running",
                partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` per key in ``order`` (rows frame), split-safe.

    ``order`` should make rows unique within a key (add a tie-break column):
    range bounds cannot split rows with equal (key, order), and ties would
    also make a rows frame order-dependent."""
    keys, order = _list(keys), _list(order)
    r = _ranged(df, keys, order, partitions)
    w = Window.partitionBy(*keys, "_pid").orderBy(*order)
    r = write_shared(r.withColumn("_loc", F.sum(value).over(w.rowsBetween(_UNB, Window.currentRow))), "pieces")
    b = r.groupBy(*keys, "_pid").agg(F.sum(value).alias("_tot"))
    wb = Window.partitionBy(*keys).orderBy("_pid")
    b = b.withColumn("_base", F.coalesce(F.sum("_tot").over(wb.rowsBetween(_UNB, -1)),
                                         F.lit(0).cast(b.schema["_tot"].dataType))) \
        .select(*keys, "_pid", "_base")
    return join_back(r, b, [*keys, "_pid"]).withColumn(name, F.col("_base") + F.col("_loc")) \
        .drop("_pid", "_loc", "_base")


def previous(df: DataFrame, keys, order, col: str, name: str) -> DataFrame:
    """Previous value of ``col`` per key (W1) for keys of bounded size."""
    w = Window.partitionBy(*_list(keys)).orderBy(*_list(order))
    return df.withColumn(name, F.lag(col).over(w))


def replay_ledger(df: DataFrame, account: str, order, amount: str, minimum: float | None = None,
                  balance: str = "balance", accepted: str = "accepted",
                  partitions: int | None = None, method: str = "pieces", scale: int = 6) -> DataFrame:
    """Replay deposits (amount > 0) and withdrawals (amount < 0) per account.

    Without a minimum every entry is accepted and the balance is a running
    sum (split-safe, see ``running_sum``). With a minimum a withdrawal is
    refused when it would take the balance below it: a sequential rule.

    With a minimum, amounts are counted in units of 10 ** -``scale`` (halves
    rounded away from zero) as 64-bit integers, so every sum is exact and the
    decisions are those of the one-by-one rule, whatever the number of pieces
    or the size of Arrow batches. A null amount is 0. ``balance`` is a double
    of the exact units.

    ``method="pieces"`` (default) cuts accounts into range pieces, so that no task holds more than one piece, and
    carries balances over the borders by transfer tables: four passes, whatever is refused (see
    :mod:`sparkwright.operators.ledger`).

    ``method="stream"`` folds every account in one sorted stream of Arrow
    batches with the balance carried between batches (memory of one batch,
    time of the whole account): less work where accounts are many and small.
    """
    order = _list(order)
    if minimum is None:
        out = running_sum(df, [account], order, amount, balance, partitions)
        return out.withColumn(accepted, F.lit(True))
    lo, unit = int(round(minimum * 10 ** scale)), 10 ** scale
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = df.columns
    units = (F.col(amount).cast(f"decimal(38,{scale})") * F.lit(unit)).cast("bigint")
    led = df.withColumn("_units", F.coalesce(units, F.lit(0).cast("bigint")))
    shown = [*cols, (F.col("_bal") / F.lit(unit)).cast("double").alias(balance), F.col("_ok").alias(accepted)]
    run = ledger.replay_stream if method == "stream" else ledger.replay_pieces
    return run(led, account, order, lo, n, "_bal", "_ok").select(*shown)


def first_by_order(value: str, order: list[str]) -> Column:
    """Value of the first row by ``order`` (deterministic ``first``)."""
    return F.min_by(F.col(value), F.struct(*[F.col(o) for o in order]))


def pivot_first(df: DataFrame, keys, feature: str, features, value: str, order) -> DataFrame:
    """One row per key and one column per name in ``features``, holding the feature's first value
    by ``order`` (A16): partial aggregates and one shuffle; other features are left out."""
    rank = F.struct(*[F.col(o) for o in order])
    return df.groupBy(*_list(keys)).agg(*[
        F.min_by(F.col(value), F.when(F.col(feature) == f, rank)).alias(f) for f in features])
