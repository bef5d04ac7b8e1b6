"""Golden values: collection, map, string and format operations
checked against the expected outputs the original worksheets print."""
from pyspark.sql import functions as F

from sparkwright.functions import collections as C


def test_list_operations(spark):
    df = spark.createDataFrame(
        [(["Enterprise", "Defiant", "Voyager", "Deep Space Nine"], [1, 2, 3, 4, 5], [6, 7, 8])],
        "ships array<string>, nums array<int>, more array<int>")
    r = df.select(
        F.get("ships", 1).alias("second"), F.element_at("ships", 1).alias("head"),
        F.slice("ships", 2, 100).alias("tail"),
        F.transform("ships", lambda s: F.reverse(s)).alias("backward"),
        C.array_sum(F.col("nums"), 0).alias("sum"),
        F.filter("nums", lambda x: x != 5).alias("no_fives"),
        F.filter("nums", lambda x: x != 3).alias("no_threes"),
        F.concat("nums", "more").alias("lots"), F.reverse("nums").alias("rev"),
        F.array_sort(F.reverse("nums")).alias("sorted"),
        F.array_distinct(F.concat("nums", "nums")).alias("distinct"),
        F.array_max("nums").alias("max"),
        F.array_contains(F.filter("nums", lambda x: x != 3), 3).alias("has_three"),
        F.filter(F.sequence(F.lit(1), F.lit(20)), lambda x: x % 3 == 0).alias("mod3"),
    ).collect()[0]
    assert r["second"] == "Defiant" and r["head"] == "Enterprise"
    assert r["tail"] == ["Defiant", "Voyager", "Deep Space Nine"]
    assert r["backward"] == ["esirpretnE", "tnaifeD", "regayoV", "eniN ecapS peeD"]
    assert r["sum"] == 15 and r["max"] == 5 and r["has_three"] is False
    assert r["no_fives"] == [1, 2, 3, 4] and r["no_threes"] == [1, 2, 4, 5]
    assert r["lots"] == [1, 2, 3, 4, 5, 6, 7, 8] and r["rev"] == [5, 4, 3, 2, 1]
    assert r["sorted"] == [1, 2, 3, 4, 5] and r["distinct"] == [1, 2, 3, 4, 5]
    assert r["mod3"] == [3, 6, 9, 12, 15, 18]


def test_map_lookups_with_default(spark):
    df = spark.createDataFrame([({"Kirk": "Enterprise", "Picard": "Enterprise-D", "Sisko": "Deep Space Nine",
                                  "Janeway": "Voyager"},)], "m map<string,string>")
    r = df.select(F.element_at("m", F.lit("Janeway")).alias("j"),
                  F.map_contains_key("m", F.lit("Archer")).alias("has"),
                  C.map_get_or(F.col("m"), "Archer", "Unknown").alias("archer")).collect()[0]
    assert (r["j"], r["has"], r["archer"]) == ("Voyager", False, "Unknown")


def test_formats_and_regex_capture(spark):
    df = spark.createDataFrame([(3.14159265, 1, "To life, the universe, and everything is 42.")],
                               "pi double, one int, s string")
    r = df.select(F.format_string("Pi is about %.3f", "pi").alias("a"),
                  F.format_string("Zero padding on the left: %05d", "one").alias("b"),
                  F.format_string("Two x Pi is about %.3f", F.col("pi") * 2).alias("c"),
                  F.regexp_extract("s", r".* ([\d]+).*", 1).cast("int").alias("answer")).collect()[0]
    assert r["a"] == "Pi is about 3.142" and r["b"] == "Zero padding on the left: 00001"
    assert r["c"] == "Two x Pi is about 6.283" and r["answer"] == 42


def test_ledger_examples(spark):
    from sparkwright.operators import windows
    df = spark.createDataFrame([(1, "scott", 1000.0), (2, "scott", -600.0), (1, "dave", 1000.0),
                                (2, "dave", -600.0)], "seq long, acct string, amount double")
    plain = {(r["acct"], r["seq"]): r["balance"]
             for r in windows.replay_ledger(df.filter("acct = 'scott'"), "acct", ["seq"], "amount").collect()}
    assert plain == {("scott", 1): 1000.0, ("scott", 2): 400.0}
    minimum = {(r["acct"], r["seq"]): (r["balance"], r["accepted"])
               for r in windows.replay_ledger(df.filter("acct = 'dave'"), "acct", ["seq"], "amount",
                                              minimum=500.0).collect()}
    assert minimum == {("dave", 1): (1000.0, True), ("dave", 2): (1000.0, False)}
