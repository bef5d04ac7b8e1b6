import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkwright.operators import ledger, windows
from tests.conftest import SF01


def _naive_sessions(df, gap_us):
    w = Window.partitionBy("k").orderBy("t_us", "id")
    return (df.withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp")))
              .withColumn("p", F.lag("t_us").over(w))
              .withColumn("f", F.when(F.col("p").isNull() | (F.col("t_us") - F.col("p") > gap_us), 1)
                          .otherwise(0))
              .withColumn("n", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def test_sessionize_hot_key_split_across_partitions(spark):
    rnd = random.Random(7)
    rows, t = [], 1_700_000_000.0
    for i in range(3000):
        t += rnd.choice([1, 100, 899, 900, 901, 2000, 0])   # equal times, 900 / 901 s gaps
        rows.append((i, "hot" if i % 5 else f"k{i % 7}", t))
    df = spark.createDataFrame(rows, "id long, k string, tsd double") \
        .withColumn("ts", F.timestamp_seconds("tsd"))
    got = windows.sessionize(df, ["k"], "ts", "id", 900, partitions=16)
    exp = _naive_sessions(df, 900 * 1_000_000)
    g = {r["id"]: (r["session_start_flag"], r["session_no"], r["prev_ts_us"]) for r in got.collect()}
    e = {r["id"]: (r["f"], r["n"], r["p"]) for r in exp.collect()}
    assert g == e


def test_sessionize_matches_probed_totals(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    s = windows.sessionize(ev, ["user_id"], "ts", "event_id", 900)
    r = s.agg(F.sum("session_start_flag").alias("starts"), F.sum("session_no").alias("tot")).collect()[0]
    assert (r["starts"], r["tot"]) == (9774, 335634)


def test_running_sum_hot_key(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("k"),
                                  (F.col("id") % 11).alias("v"))
    got = windows.running_sum(df, ["k"], ["id"], "v", "run", partitions=12)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("run", F.sum("v").over(w))
    assert sorted(map(tuple, got.select("id", "run").collect())) == \
        sorted(map(tuple, exp.select("id", "run").collect()))


def test_replay_ledger_minimum_matches_python(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["a", "b", "c"]), float(rnd.randint(-60, 50))) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, acct string, amount double")
    got = {r["id"]: (r["balance"], r["accepted"])
           for r in windows.replay_ledger(df, "acct", ["id"], "amount", minimum=0.0,
                                          partitions=3).collect()}
    bal = {}
    for i, a, amt in rows:
        b = bal.get(a, 0.0)
        ok = amt >= 0 or b + amt >= 0.0
        if ok:
            b += amt
        bal[a] = b
        assert got[i] == (b, ok)


def test_null_key_is_a_group_of_its_own(spark):
    rows = [(1, None, 0.0), (2, None, 100.0), (3, None, 5000.0), (4, "a", 0.0), (5, "a", 10.0)]
    df = spark.createDataFrame(rows, "id long, k string, tsd double").withColumn("ts", F.timestamp_seconds("tsd"))
    s = {r["id"]: (r["session_start_flag"], r["session_no"])
         for r in windows.sessionize(df, ["k"], "ts", "id", 900, partitions=3).collect()}
    assert s == {1: (1, 1), 2: (0, 1), 3: (1, 2), 4: (1, 1), 5: (0, 1)}
    rs = {r["id"]: r["run"] for r in windows.running_sum(df, ["k"], ["id"], "tsd", "run", partitions=3).collect()}
    assert rs == {1: 0.0, 2: 100.0, 3: 5100.0, 4: 0.0, 5: 10.0}


def test_sessionize_epoch_seconds_column_and_zone_independence(spark):
    rows = [(1, "k", 1000), (2, "k", 1900), (3, "k", 2801), (4, "k", 2801)]
    df = spark.createDataFrame(rows, "id long, k string, t long")
    s = {r["id"]: (r["session_start_flag"], r["session_no"])
         for r in windows.sessionize(df, ["k"], "t", "id", 900, partitions=2).collect()}
    assert s == {1: (1, 1), 2: (0, 1), 3: (1, 2), 4: (0, 2)}
    ev = spark.read.parquet(f"{SF01}/events.parquet").limit(50)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        ny = {r["event_id"]: r["prev_ts_us"] for r in windows.sessionize(ev, ["user_id"], "ts", "event_id", 900).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    utc = {r["event_id"]: r["prev_ts_us"] for r in windows.sessionize(ev, ["user_id"], "ts", "event_id", 900).collect()}
    assert ny == utc


def test_replay_ledger_minimum_across_small_batches(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        acct = rnd.choice(["rich", "poor", "mid"])
        amt = {"rich": rnd.randint(-50, 200), "poor": rnd.randint(-60, 40), "mid": rnd.randint(-80, 80)}[acct]
        rows.append((i, acct, float(amt)))
    df = spark.createDataFrame(rows, "id long, acct string, amount double")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        got = {r["id"]: (r["balance"], r["accepted"])
               for r in windows.replay_ledger(df, "acct", ["id"], "amount", minimum=10.0, partitions=2).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    bal = {}
    for i, a, amt in rows:
        b = bal.get(a, 0.0)
        ok = amt >= 0 or b + amt >= 10.0
        b = b + amt if ok else b
        bal[a] = b
        assert got[i] == (b, ok), i


def _ledger_brute(rows, lo):
    bal, out = {}, {}
    for i, a, amt in sorted(rows, key=lambda r: (r[1], r[0])):
        b = bal.get(a, 0.0)
        ok = amt >= 0 or b + amt >= lo
        b = b + amt if ok else b
        bal[a] = b
        out[i] = (b, ok)
    return out


def test_replay_ledger_pieces_hot_account(spark):
    rnd = random.Random(21)
    cases = {
        "rich": [(i, "hot", float(rnd.randint(-20, 60))) for i in range(3000)],
        "hover": [(i, "hot", float(rnd.randint(-50, 45))) for i in range(3000)],
        "mixed": [(i, "hot" if i % 4 else "cold", float(rnd.randint(-40, 50))) for i in range(3000)],
    }
    for name, rows in cases.items():
        df = spark.createDataFrame(rows, "id long, acct string, amount double")
        exp = _ledger_brute(rows, 5.0)
        for kw in ({"method": "pieces"}, {"method": "stream"}):
            got = {r["id"]: (r["balance"], r["accepted"])
                   for r in windows.replay_ledger(df, "acct", ["id"], "amount", minimum=5.0, partitions=12,
                                                  **kw).collect()}
            assert got == exp, (name, kw)


@pytest.mark.parametrize("steps", [2, 4096])
@pytest.mark.parametrize("pieces", [1, 3, 16, 40])
def test_replay_ledger_one_account_in_most_pieces(spark, monkeypatch, pieces, steps):
    """An account that fills many partitions, among small ones, so that tables are chained; also with many small tables."""
    monkeypatch.setattr(ledger, "STEPS", steps)
    rnd = random.Random(77)
    for low, high, lo in ((-50, 45, 5.0), (-9, 3, 0.0), (-4, 8, -7.0)):
        rows = [(i, "hot" if i % 5 else rnd.choice(["a", "m", "z", None]), float(rnd.randint(low, high))) for i in range(1200)]
        df = spark.createDataFrame(rows, "id long, acct string, amount double").repartition(3)
        got = {r["id"]: (r["balance"], r["accepted"]) for r in windows.replay_ledger(
            df, "acct", ["id"], "amount", minimum=lo, partitions=pieces).collect()}
        assert got == _ledger_brute([(i, a or "", x) for i, a, x in rows], lo)


def test_transfer_tables_equal_the_replay():
    rnd = np.random.default_rng(9)
    for steps in (2, 5, 4096):
        for lo in (0, 7, -20):
            a = rnd.integers(-30, 25, 300)
            a[:12] = [-(1 << k) for k in range(11, -1, -1)]  # every start ends elsewhere: the table doubles row by row
            tables = list(ledger.transfer_tables(a, lo, steps))
            assert max(len(b) for b, _ in tables) <= 2 * max(steps, 2) + 1
            for start in [*range(min(0, lo), 200), 5000, 10**9]:
                b = start
                for begin, offset in tables:
                    b += int(offset[np.searchsorted(begin, b, side="right") - 1])
                assert b == ledger.replay(a, start, lo)


def test_replay_ledger_takes_a_fixed_number_of_jobs(spark):
    """Whether nothing or most is refused."""
    def jobs(low, high):
        rows = [(i, "hot", float(random.Random(i).randint(low, high))) for i in range(2000)]
        df = spark.createDataFrame(rows, "id long, acct string, amount double")
        spark.sparkContext.setJobGroup(f"ledger{low}", "")
        windows.replay_ledger(df, "acct", ["id"], "amount", minimum=0.0, partitions=12).count()
        n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"ledger{low}"))
        spark.sparkContext.setJobGroup("", "")
        return n
    assert jobs(1, 50) == jobs(-50, 20)


def test_replay_ledger_methods_agree_on_events(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    amt = F.when(F.col("event_type").isin("purchase", "error"), -F.col("value")).otherwise(F.col("value"))
    led = ev.select("event_id", "user_id", "ts", amt.alias("amount"))
    a = {r["event_id"]: (r["balance"], r["accepted"]) for r in windows.replay_ledger(
        led, "user_id", ["ts", "event_id"], "amount", minimum=0.0, method="pieces", partitions=16).collect()}
    b = {r["event_id"]: (r["balance"], r["accepted"]) for r in windows.replay_ledger(
        led, "user_id", ["ts", "event_id"], "amount", minimum=0.0, method="stream").collect()}
    assert a.keys() == b.keys()
    assert a == b


def test_replay_ledger_null_account_is_its_own_account(spark):
    rows = [(1, None, 10.0), (2, None, -7.0), (3, None, -7.0), (4, "a", -1.0), (5, "a", 3.0), (6, "a", -2.0)]
    df = spark.createDataFrame(rows, "id long, acct string, amount double")
    exp = {1: (10.0, True), 2: (3.0, True), 3: (3.0, False), 4: (0.0, False), 5: (3.0, True), 6: (1.0, True)}
    for method in ("stream", "pieces"):
        got = {r["id"]: (r["balance"], r["accepted"])
               for r in windows.replay_ledger(df, "acct", ["id"], "amount", minimum=0.0, partitions=3,
                                              method=method).collect()}
        assert got == exp, method


def test_join_back_null_safe_inner_and_left(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    inner = sorted((r["k"] or "", r["v"], r["w"]) for r in windows.join_back(left, right, ["k"]).collect())
    assert inner == [("", 1, 10), ("a", 2, 20)]
    lj = windows.join_back(left, right, ["k"], how="left")
    assert lj.columns == ["k", "v", "w"]
    assert sorted((r["k"] or "", r["v"], r["w"]) for r in lj.collect()) == [("", 1, 10), ("a", 2, 20), ("b", 3, None)]


def test_replay_ledger_tenths_do_not_depend_on_pieces_or_batches(spark):
    """Balances in tenths that often land on the minimum: exact one-by-one decisions."""
    rnd = random.Random(5)
    rows = [(i, f"a{i % 9}" if i % 3 else "hot", rnd.randint(-30, 28) / 10) for i in range(900)] + [(900, "hot", None)]
    df = spark.createDataFrame(rows, "id long, acct string, amount double")
    bal, exp = {}, {}
    for i, a, amt in rows:
        b, x = bal.get(a, 0), round((amt or 0) * 10)
        ok = x >= 0 or b + x >= 0
        bal[a] = b = b + x if ok else b
        exp[i] = (b / 10, ok)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch, pieces, method in (("1", 16, "pieces"), ("7", 1, "pieces"), ("7", 16, "stream"), ("10000", 16, "pieces")):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = {r["id"]: (r["balance"], r["accepted"]) for r in windows.replay_ledger(
                df, "acct", ["id"], "amount", minimum=0.0, partitions=pieces, method=method).collect()}
            assert got == exp, (batch, pieces, method)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_sessions_of_a_day_take_one_exchange(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    s = windows.sessionize(ev, ["user_id", "day"], "ts", "event_id", 900, bucket_seconds=None)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "InMemoryTableScan" not in plan and "Join" not in plan
    # the same rows as with pieces
    cols = ["event_id", "session_start_flag", "session_no", "prev_ts_us"]
    split = windows.sessionize(ev, ["user_id", "day"], "ts", "event_id", 900, bucket_seconds=3600)
    assert sorted(map(tuple, s.select(*cols).collect()), key=str) == sorted(map(tuple, split.select(*cols).collect()), key=str)


def test_sessionize_small_buckets(spark):
    rnd = random.Random(2)
    rows, t = [], 1_700_000_000
    for i in range(400):
        t += rnd.choice([0, 5, 60, 61, 300])
        rows.append((i, rnd.choice(["a", None]), t if i % 50 else None))
    df = spark.createDataFrame(rows, "id long, k string, tsd long").withColumn("ts", F.timestamp_seconds("tsd"))
    one = {tuple(r) for r in windows.sessionize(df, ["k"], "ts", "id", 60, bucket_seconds=10**9).collect()}
    assert one == {tuple(r) for r in windows.sessionize(df, ["k"], "ts", "id", 60, bucket_seconds=30).collect()}
    assert len(one) == 400
