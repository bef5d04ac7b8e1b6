"""Text-format jobs: the reference's line formats parsed back into tables.

Stand-in input: rows of the test tables rendered as the lines the reference
reads (pipe-delimited id|name|... lines, `id "name"` lines, whitespace
adjacency lines `src dst`); the jobs parse them with the library's readers
and compute on the parsed rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import graph
from sparkwright.plans.graph_jobs import order_graph
from sparkwright.sources import readers
from sparkwright.sources.tables import table


def dimension_lines(spark, root):
    """id -> name parsed from pipe-delimited item lines (last line of an id wins)."""
    p = table(spark, root, "part")
    lines = p.select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_name", "p_brand").alias("value"),
                     F.col("p_partkey").alias("_line"))
    return readers.parse_dimension(lines, ["_line"])


def quoted_names(spark, root):
    """(id, name) parsed from `id "name"` lines."""
    c = table(spark, root, "supplier")
    lines = c.select(F.concat(F.col("s_suppkey").cast("string"), F.lit(' "'), F.col("s_name"),
                              F.lit('"')).alias("value"))
    return readers.parse_quoted_names(lines)


def degree_from_lines(spark, root):
    """Connections per node counted from whitespace adjacency lines (an id may span lines)."""
    e = order_graph(spark, root)
    lines = e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    return graph.degree(graph.parse_adjacency(lines))


def delimited_lines(spark, root):
    """Positional fields picked from headerless comma lines, the rest ignored."""
    o = table(spark, root, "orders")
    lines = o.select(F.concat_ws(",", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string"),
                                 F.col("o_totalprice").cast("string"), F.lit("x,y")).alias("value"))
    return readers.parse_delimited(lines, [("customer", "bigint", 0), ("amount", "double", 2)]) \
        .groupBy("customer").agg(F.count("amount").alias("n"), F.max("amount").alias("largest"))


def rating_lines(spark, root):
    """Ratings read from tab-separated (user, item, rating, time) lines; bad lines dropped, ratings counted."""
    li = table(spark, root, "lineitem")
    bad = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise((F.col("l_linenumber") % 5 + 1).cast("string"))
    lines = li.select(F.concat_ws("\t", F.col("l_suppkey").cast("string"), F.col("l_partkey").cast("string"), bad,
                                  F.col("l_orderkey").cast("string")).alias("value"))
    rows = readers.parse_delimited(lines, [("user", "bigint", 0), ("item", "bigint", 1), ("rating", "int", 2),
                                           ("time", "bigint", 3)], sep="\t", on_error="drop")
    return rows.groupBy("rating").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user").alias("users"))


def customers_without_orders(spark, root):
    """Customers beside their orders: how many rows a drop of null rows keeps, per segment."""
    c = table(spark, root, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    o = table(spark, root, "orders").select(F.col("o_custkey").alias("key"), "o_orderkey")
    both = c.join(o, "key", "left")
    kept = both.dropna().groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_kept"))
    return both.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows")).join(kept, "c_mktsegment", "left") \
        .fillna(0, ["n_kept"])


JOBS = {
    "delimited_lines": delimited_lines,
    "rating_lines": rating_lines,
    "customers_without_orders": customers_without_orders,
    "dimension_lines": dimension_lines,
    "quoted_names": quoted_names,
    "degree_from_lines": degree_from_lines,
}

ORACLE = {
    "delimited_lines": """SELECT o_custkey AS customer, count(*) AS n, max(o_totalprice) AS largest
        FROM orders GROUP BY 1""",
    "rating_lines": """SELECT CAST(l_linenumber % 5 + 1 AS INTEGER) AS rating, count(*) AS n,
        count(DISTINCT l_suppkey) AS users FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1""",
    "customers_without_orders": """SELECT c_mktsegment, count(*) AS n_rows, count(o_orderkey) AS n_kept
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""",
    "dimension_lines": "SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name FROM part",
    "quoted_names": "SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name FROM supplier",
    "degree_from_lines": """WITH edges AS (
        SELECT l_partkey AS src FROM lineitem UNION ALL SELECT -1 - l_suppkey FROM lineitem)
        SELECT src AS id, count(*) AS degree FROM edges GROUP BY src""",
}
