import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from sparkwright.operators import combine
from sparkwright.plans import io_jobs
from sparkwright.sources import learned, readers, sinks, synthetic
from tests.conftest import SF01


def test_types_are_learned_narrowest_first(spark):
    rows = [("true", "20240229", "1", "3000000000", "1e3", "2024-02-29", "2024-02-29 10:00:00", "x", "", " 7 ", "20240230"),
            ("FALSE", "20231231", "-5", "2", "-.5", "1999-12-31", "2024-02-29T10:00:01", "1", None, "8", "20231301"),
            ("", "19000101", "+12", "3", "7", "0001-01-01", "2024-02-29", "true", " ", None, "1")]
    raw = spark.createDataFrame(rows, ", ".join(f"c{k} string" for k in range(11)))
    got = learned.learn_types(raw)
    assert [t for _, t, *_ in got] == ["boolean", "day", "int", "bigint", "double", "date", "timestamp_ntz", "string", "string", "int", "int"]
    assert [n for _, _, n, _ in got] == [2, 3, 3, 3, 3, 3, 3, 3, 0, 2, 3]
    good, bad = learned.typed_and_rejected(raw, got)
    assert bad.count() == 0 and dict(good.dtypes)["c1"] == "date"
    first = good.orderBy(F.col("c2").desc()).collect()
    assert [r["c2"] for r in first] == [12, 1, -5] and first[1]["c1"] == datetime.date(2024, 2, 29) and first[1]["c9"] == 7
    assert learned.learn_types(raw.limit(0))[0][1:] == ("string", 0, 0)


def test_rejected_rows_are_kept_apart_and_counted(spark):
    rows = [(str(k), f"{k}.5" if k % 50 else "oops", "20240101" if k != 7 else "20249999") for k in range(200)]
    raw = spark.createDataFrame(rows, "a string, b string, `c d` string")
    kinds = learned.learn_types(raw, tolerance=0.05)
    assert kinds == [("a", "int", 200, 0), ("b", "double", 200, 4), ("c d", "day", 200, 1)]
    assert [t for _, t, *_ in learned.learn_types(raw)] == ["int", "string", "int"]  # no tolerance: an impossible day leaves integers
    good, bad = learned.typed_and_rejected(raw, kinds)
    assert good.count() == 195 and bad.count() == 5
    found = {r["a"]: r["bad_columns"] for r in bad.collect()}
    assert found == {"0": ["b"], "50": ["b"], "100": ["b"], "150": ["b"], "7": ["c d"]}


def test_one_pass_writes_all_outputs_and_a_rerun_replaces_one_month(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(m, o, k) for m in ("2024-01", "2024-02", "2024-03") for o in ("matched", "missing") for k in range(4)],
                               "month string, output string, k int")
    sinks.write_parts(df, path, ["month", "output"])
    sinks.write_parts(df.where("month = '2024-02' and output = 'matched'").withColumn("k", F.col("k") + 100), path, ["month", "output"])
    back = sinks.read_parts(spark, path, month="2024-02", output="matched")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-02" in plan
    assert sorted(r["k"] for r in back.collect()) == [100, 101, 102, 103] and len(back.inputFiles()) >= 1
    assert sorted(r["k"] for r in sinks.read_parts(spark, path, month="2024-02", output="missing").collect()) == [0, 1, 2, 3]
    assert sinks.read_parts(spark, path, month="2024-01").count() == 8


def test_month_read_back_lists_one_folder(spark):
    df = io_jobs.month_read_back(spark, SF01)
    scan = next(x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Scan parquet" in x or "FileScan" in x)
    filters = scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "month" in filters and "1995-03" in filters and "output" in filters and df.count() > 10


def test_json_with_a_declared_schema_rescues_bad_lines(spark, tmp_path):
    lines = ['{"a": 1, "b": {"c": [1, 2]}}', '{"a": "x", "b": null}', "no json", '{"b": {"c": []}, "extra": 3}', ""]
    (tmp_path / "j").write_text("\n".join(lines))
    got = readers.read_json_declared(spark, str(tmp_path / "j"), "a int, b struct<c: array<int>>").collect()
    assert [(r["a"], r["b"]["c"] if r["b"] else None, r["_rescue"]) for r in got] == [
        (1, [1, 2], None), (None, None, lines[1]), (None, None, "no json"), (None, [], None)]


@pytest.mark.parametrize("kind, kw", [("normal", {}), ("lognormal", {"mean": 0.5, "sigma": 0.25}), ("randint", {"lo": -2, "hi": 7}),
                                      ("letters", {"min_len": 0, "max_len": 4})])
def test_synthetic_columns_do_not_depend_on_partitions(spark, kind, kw):
    base = spark.range(4000)
    one = {r["id"]: r["v"] for r in synthetic.with_random(base.coalesce(1), "v", kind, "id", 7, **kw).collect()}
    many = {r["id"]: r["v"] for r in synthetic.with_random(base.repartition(50), "v", kind, "id", 7, **kw).collect()}
    other = {r["id"]: r["v"] for r in synthetic.with_random(base, "v", kind, "id", 8, **kw).collect()}
    assert one == many and one != other
    values = list(one.values())
    if kind == "normal":
        mean = sum(values) / 4000
        assert abs(mean) < 0.06 and abs(sum((v - mean) ** 2 for v in values) / 4000 - 1) < 0.1
    elif kind == "lognormal":
        assert abs(sum(map(math.log, values)) / 4000 - 0.5) < 0.02
    elif kind == "randint":
        assert set(values) == set(range(-2, 8))
    else:
        assert {len(v) for v in values} == {0, 1, 2, 3, 4} and len(set("".join(values))) == 26


def test_combiner_equals_one_call_on_all_rows(spark):
    import pandas as pd

    def longest(pdf):  # two longest words of a key, ties by the word
        pdf = pdf.assign(n=pdf["word"].str.len()).sort_values(["n", "word"], ascending=[False, True])
        return pdf.groupby("key", dropna=False, sort=False).head(2)[["key", "word"]]
    rnd = random.Random(4)
    rows = [(rnd.choice(["a", "b", None]) if k % 3 else "hot", "w" * rnd.randrange(9) + str(k % 40)) for k in range(3000)]
    df = spark.createDataFrame(rows, "key string, word string").withColumn("unused", F.lit(1)).repartition(9)
    got = sorted((r["key"] or "", r["word"]) for r in combine.combine(df, "key", longest, "key string, word string").collect())
    want = longest(pd.DataFrame(rows, columns=["key", "word"]))
    assert got == sorted((k or "", w) for k, w in want.itertuples(index=False))
    assert combine.combine(df.limit(0), "key", longest, "key string, word string").count() == 0
    with pytest.raises(ValueError, match="lacks the keys"):
        combine.combine(df, "key", longest, "word string")
