import pytest

LONG = " ".join(f"w{k % 977}x{k % 13}" for k in range(60_000))
COMMON = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
EDGE = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "b"), (4, "word", "en", None),
    (5, COMMON + " tail of five", "en", "a"), (6, "head of six " + COMMON, "de", "a"),
    (7, COMMON, "en", "a"), (8, COMMON, "en", "a"), (8, COMMON, "en", "a"), (None, COMMON, "en", "a"),
    (None, "no id here", None, None), (9, LONG, "en", "a"), (10, "start " + LONG, "en", "b"),
    (11, "Ünï çødé 中文 😀  nbsp  em\x0bvt\x85nel a\x1cb", "en", "a"),
    (12, "All rights reserved. CC BY cc-by GENERAL PUBLIC LICENSE " * 3, "en", "a"),
    (13, "the THE the the " * 50, "en", "a"), (14, "line one\nline one\n\nline two\r\nline one", "en", "c"),
    (15, "<|endoftext|> special <|endoftext|>", "en", "a"), (16, "a\x00b c", "en", "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use themselves.
CLASH = ("words", "n_words", "score", "shard", "size", "block", "part", "path", "labels", "rep", "fp", "node",
         "probability", "topic", "n_tokens", "ids", "_part", "component_id", "kept", "lines", "windows")


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in EDGE], SCHEMA)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASH]).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def edge_rows():
    return [(r[0], r[1]) for r in EDGE]
