import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwright.sources import readers, sinks


def _write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)
    return str(path)


def test_read_delimited_positional_and_errors(spark, tmp_path):
    p = _write(tmp_path / "w.csv", b"ST1,18000101,TMIN,-75,,E\r\nST2,18000101,TMAX,-60,x\r\n")
    df = readers.read_delimited(spark, p, [("station", "string", 0), ("type", "string", 2),
                                           ("temp", "float", 3)])
    assert [tuple(r) for r in df.collect()] == [("ST1", "TMIN", -75.0), ("ST2", "TMAX", -60.0)]
    bad = _write(tmp_path / "b.csv", b"1,x\n2,5\n")
    drop = readers.read_delimited(spark, bad, [("a", "int", 0), ("b", "int", 1)], on_error="drop")
    assert [tuple(r) for r in drop.collect()] == [(2, 5)]
    with pytest.raises(Exception):
        readers.read_delimited(spark, bad, [("a", "int", 0), ("b", "int", 1)]).collect()


def test_read_dimension_bad_utf8_short_lines_last_wins(spark, tmp_path):
    p = _write(tmp_path / "items.txt", b"1|Toy Story|x\n2|Caf\xe9 \xff|y\n3\n1|Toy Story (1995)|z\n")
    d = {r["id"]: r["name"] for r in readers.read_dimension(spark, p).collect()}
    assert d[1] == "Toy Story (1995)" and 3 not in d
    assert d[2].startswith("Caf") and "�" in d[2]


def test_parse_quoted_names(spark):
    lines = spark.createDataFrame([('1 "HERO ONE"',), ("2 no quotes",), ('3 "X"',)], "value string")
    assert [tuple(r) for r in readers.parse_quoted_names(lines).collect()] == [(1, "HERO ONE"), (3, "X")]


def test_csv_readers_and_typed_dates(spark, tmp_path):
    p = _write(tmp_path / "g.csv", b"date,day_of_week,v\n20180102,Tue,1\n20180103,Wed,2\n")
    inf = readers.read_csv_inferred(spark, p)
    assert dict(inf.dtypes)["v"] == "int"
    sch = T.StructType([T.StructField("date", T.IntegerType()), T.StructField("day_of_week", T.StringType()),
                        T.StructField("v", T.ShortType())])
    typed = readers.read_typed(spark, p, sch, date_cols=["date"])
    assert dict(typed.dtypes) == {"date": "date", "day_of_week": "string", "v": "smallint"}
    assert str(typed.collect()[0]["date"]) == "2018-01-02"
    q = _write(tmp_path / "n.csv", b"5.1,3.5,setosa\n")
    named = readers.read_csv_named(spark, q, ["sl", "sw", "species"])
    assert named.columns == ["sl", "sw", "species"]


def test_read_labelled(spark, tmp_path):
    p = _write(tmp_path / "r.txt", b"-1.74,1.66\r\n1.24,-1.18\r\n")
    rows = readers.read_labelled(spark, p).collect()
    assert rows[0]["label"] == -1.74 and list(rows[0]["features"]) == [1.66]


def test_write_outputs_by_month_and_read_back_pruned(spark, tmp_path):
    root = str(tmp_path / "out")
    for m in ("2017-11", "2017-12"):
        df = spark.createDataFrame([(1, m)], "id int, tag string")
        sinks.write_outputs({"matched": df, "missing": df.limit(0)}, root, month=m)
    back = readers.read_month(spark, f"{root}/matched", "2017-12")
    assert [r["tag"] for r in back.collect()] == ["2017-12"]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2017-12" in plan
    sinks.write_sorted(spark.createDataFrame([(k,) for k in (5, 3, 9, 1, 2, 8)], "k int").repartition(3),
                       str(tmp_path / "s"), ["k"])
    keys = []
    for f in sorted(x for x in os.listdir(tmp_path / "s") if x.startswith("part-")):
        with open(tmp_path / "s" / f) as fh:
            keys += [int(line) for line in fh.read().split()[1:]]
    assert keys == [1, 2, 3, 5, 8, 9]


def test_short_delimited_line_fails_or_drops(spark):
    import pytest
    lines = spark.createDataFrame([("1,2",), ("3",), ("4,x",), ("5,6,7",)], "value string")
    fields = [("a", "int", 0), ("b", "int", 1)]
    with pytest.raises(Exception, match="no field 1"):
        readers.parse_delimited(lines.where("value = '3'"), fields).collect()
    kept = readers.parse_delimited(lines, fields, on_error="drop").collect()
    assert sorted(map(tuple, kept)) == [(1, 2), (5, 6)]
