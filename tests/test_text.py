import math
import re
from collections import Counter

from pyspark.sql import functions as F

from sparkwright.operators import text

SAMPLES = [
    "@alice loves http://t.co/xyz !!! Great day", "  spaced\tout   text  ", "Café résumé naïve",
    "mail bob@example.com now", "x https://a.b/c?d=1 y", "", "ab://", "aé://x tail", "#tag & more stuff",
]


def _py_clean(t):
    return " ".join(re.sub(r"(@[A-Za-z0-9]+)|([^0-9A-Za-z \t])|(\w+:\/\/\S+)", " ", t).split())


def test_clean_post_matches_python_rule(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", text.clean_post("t").alias("c")).collect()}
    assert got == {i: _py_clean(s) for i, s in enumerate(SAMPLES)}


def test_doc_entropy_matches_counter(spark):
    docs = ["a b a c", "", "x", "one two\nthree  two　one", "same same same"]
    df = spark.createDataFrame(list(enumerate(docs)), "d int, t string")
    got = {r["d"]: r["e"] for r in text.doc_entropy(df, "d", "t", "e").collect()}
    for i, t in enumerate(docs):
        c = Counter(t.split())
        n = sum(c.values())
        exp = sum(v / n * math.log2(n / v) for v in c.values()) if n else 0.0
        assert abs(got[i] - exp) < 1e-12


def test_dedupe_reposts_matches_list_rule(spark):
    posts = [(1, "hi", 0), (2, "hi", 3), (3, "yo", 2), (4, "yo", 1), (5, "hi", 0), (6, "new", 5), (7, "yo", 0)]
    kept = []
    for seq, t, rc in posts:               # the reference's append-if-not-seen rule
        if rc > 0:
            if t not in [k[1] for k in kept]:
                kept.append((seq, t))
        else:
            kept.append((seq, t))
    df = spark.createDataFrame(posts, "seq long, t string, rc long")
    got = sorted(r["seq"] for r in text.dedupe_reposts(df, "t", "rc", "seq").collect())
    assert got == sorted(k[0] for k in kept)


def test_words_lines_and_blank_lines(spark):
    df = spark.createDataFrame([("Hello, world!\n\nsecond  line \n",)], "t string")
    w = [r["word"] for r in text.words(df, "t", " ").collect()]
    assert w == ["Hello,", "world!", "", "second", "", "line"]
    w2 = [r["word"] for r in text.words(df, "t", r"\W+", lower=True).collect()]
    assert w2 == ["hello", "world", "", "second", "line"]


def test_polarity_and_class(spark):
    df = spark.createDataFrame([("good day",), ("bad bad good",), ("nothing here",)], "t string")
    r = df.select(text.polarity(F.col("t")).alias("p")).collect()
    assert [round(x["p"], 6) for x in r] == [0.7, round((-0.7 - 0.7 + 0.7) / 3, 6), 0.0]


def test_lines_end_at_any_terminator(spark):
    from sparkwright.functions import scalar
    texts = ["a\r\nb\rc\nd\r\n", "x\n\ny\n", "", "no terminator", "\r\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(scalar.text_lines(F.col("t"))).collect()]
    assert got == [["a", "b", "c", "d"], ["x", "", "y"], [], ["no terminator"], [""]]


def test_dedupe_reposts_null_text_is_one_text(spark):
    rows = [(1, None, 1), (2, None, 2), (3, "a", 1), (4, "a", 1), (5, None, 0)]
    df = spark.createDataFrame(rows, "id long, t string, n int")
    assert sorted(r["id"] for r in text.dedupe_reposts(df, "t", "n", "id").collect()) == [1, 3, 5]


def test_sentiment_share_lists_every_class(spark):
    from sparkwright.plans import text_jobs
    from tests.conftest import SF001
    got = {r["sentiment"]: r["n"] for r in text_jobs.sentiment_share(spark, SF001).collect()}
    assert set(got) == {"positive", "neutral", "negative"}
    assert sum(got.values()) == spark.read.parquet(f"{SF001}/conversations.parquet").count()
