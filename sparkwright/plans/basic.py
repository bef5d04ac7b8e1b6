"""Single-shuffle report jobs: popularity, min/max, sums, integer means, SQL views.

Each job takes (spark, root) where root is a folder of parquet tables and
returns a lazy DataFrame. Stand-ins for the reference inputs are chosen from
the table schemas: ratings -> lineitem (item = part), weather -> events
(station = user, entry type = event type), people -> customer / part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.operators import agg, joins, topk
from sparkwright.functions import scalar
from sparkwright.operators import quantiles as Q
from sparkwright.sources.tables import table

# Parameters of the stand-in jobs (all thresholds are parameters).
MIN_ENTRY_TYPE = "click"      # plays the role of the 'TMIN' rows
MAX_ENTRY_TYPE = "purchase"   # plays the role of the 'TMAX' rows
RANGE_LO, RANGE_HI = 1000.0, 2000.0   # inclusive balance band for the SQL view job
LT_LIMIT = 0.0                        # strict less-than filter of df_filter_lt
TOP_K = 10
FIRST_N = 5


def _temps(spark, root, entry_type, fn, name):
    ev = table(spark, root, "events").filter(F.col("event_type") == entry_type)
    ev = ev.select(F.col("user_id").alias("station"),
                   scalar.tenths_c_to_f(F.col("value")).alias("temp_f"))
    # min/max pick one input value, so the exact double is returned (no
    # rounding: half-up on the decimal form and on x*100 disagree at ties).
    return fn(ev, "station", "temp_f", name)


def min_by_station(spark, root):
    """Minimum converted reading per station for one entry type (filter, min)."""
    return _temps(spark, root, MIN_ENTRY_TYPE, agg.min_by_key, "min_temp_f")


def max_by_station(spark, root):
    """Maximum converted reading per station for one entry type."""
    return _temps(spark, root, MAX_ENTRY_TYPE, agg.max_by_key, "max_temp_f")


def _report_lines(df, value, what):
    """Lines "<station> <what> temperature: <2 decimals> F", numbered in station order."""
    lines = Q.positions(df, ["station"], name="_pos")
    return lines.select((F.col("_pos") + 1).cast("bigint").alias("line_no"), F.format_string(
        f"%d {what} temperature: %.2f F", F.col("station"), scalar.round_half_away(value, 2)).alias("line"))


def min_station_report(spark, root):
    """The minimum reading of every station as numbered lines, sorted by station."""
    return _report_lines(min_by_station(spark, root), "min_temp_f", "minimum")


def max_station_report(spark, root):
    """The maximum reading of every station as numbered lines, sorted by station."""
    return _report_lines(max_by_station(spark, root), "max_temp_f", "maximum")


def value_histogram(spark, root):
    """Count of each rating value (here: line number), ordered by the value as text."""
    li = table(spark, root, "lineitem")
    return agg.count_values(li, "l_linenumber", "n").orderBy(F.col("l_linenumber").cast("string"))


def first_rows(spark, root):
    """The first n documents by id (deterministic first-n)."""
    d = table(spark, root, "documents").select("doc_id", "lang", "source", "n_chars")
    return topk.top_k(d, ["doc_id"], FIRST_N, descending=False)


def popular_items(spark, root):
    """Ratings per item, ascending by count then item."""
    li = table(spark, root, "lineitem")
    return agg.count_values(li, "l_partkey", "n").orderBy("n", "l_partkey")


def popular_items_named(spark, root):
    """Ratings per item with the item's name (every item; a plain join, AQE sizes it)."""
    li = table(spark, root, "lineitem")
    counts = agg.count_values(li, "l_partkey", "n")
    part = table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.with_names(counts, part, "l_partkey", "p_name", missing="null") \
        .orderBy("n", "l_partkey")


def top10_items(spark, root):
    """Ten most rated items with names: count -> top-k -> broadcast lookup of k keys."""
    li = table(spark, root, "lineitem")
    counts = agg.count_values(li, "l_partkey", "n")
    best = topk.top_k(counts, ["n"], TOP_K, descending=True, tie_break=["l_partkey"])
    part = table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.with_names(best, part, "l_partkey", "p_name", missing="error", small_left=True) \
        .select("l_partkey", "p_name", "n")


def int_mean_by_key(spark, root):
    """Integer mean (sum div count) of size per brand."""
    part = table(spark, root, "part")
    return agg.int_mean(part, "p_brand", "p_size", "avg_size").orderBy("p_brand")


def spend_by_customer(spark, root):
    """Total spent per customer (rounded to cents)."""
    o = table(spark, root, "orders")
    s = agg.sum_by_key(o, "o_custkey", "o_totalprice", "total_spent")
    return s.select("o_custkey", scalar.round_half_away("total_spent", 2).alias("total_spent"))


def spend_sorted(spark, root):
    """Total spent and order count per customer, sorted by (amount, customer)."""
    o = table(spark, root, "orders")
    s = agg.sum_by_key(o, "o_custkey", "o_totalprice", "total_spent", count_name="n_orders")
    return s.select("o_custkey", scalar.round_half_away("total_spent", 2).alias("total_spent"), "n_orders") \
        .orderBy("total_spent", "o_custkey")


def count_by_category(spark, root):
    """Rows per market segment, ascending by count."""
    c = table(spark, root, "customer")
    return agg.count_values(c, "c_mktsegment", "n").orderBy("n", "c_mktsegment")


def sql_range_view(spark, root):
    """Register a view and select an inclusive range in SQL (pushed to the scan)."""
    table(spark, root, "customer").createOrReplaceTempView("sw_customer")
    return spark.sql(
        "SELECT c_custkey, c_name, c_acctbal FROM sw_customer "
        f"WHERE c_acctbal BETWEEN {RANGE_LO} AND {RANGE_HI}")


def df_basics(spark, root):
    """Select, strict less-than filter and column arithmetic in one DataFrame query."""
    c = table(spark, root, "customer")
    return c.filter(F.col("c_acctbal") < LT_LIMIT) \
        .select("c_name", "c_acctbal", (F.col("c_nationkey") + 10).alias("nation_plus_10"))


def df_filter_lt(spark, root):
    """Strict less-than filter with a projection."""
    c = table(spark, root, "customer")
    return c.filter(F.col("c_acctbal") < LT_LIMIT).select("c_custkey", "c_name", "c_acctbal")


def df_count_by(spark, root):
    """Grouped count of a DataFrame column."""
    return agg.count_values(table(spark, root, "customer"), "c_nationkey", "n")


def df_plus_ten(spark, root):
    """Projection with arithmetic on a column."""
    c = table(spark, root, "customer")
    return c.select("c_name", (F.col("c_nationkey") + 10).alias("nation_plus_10"))


JOBS = {
    "min_by_station": min_by_station,
    "max_by_station": max_by_station,
    "min_station_report": min_station_report,
    "max_station_report": max_station_report,
    "value_histogram": value_histogram,
    "first_rows": first_rows,
    "popular_items": popular_items,
    "popular_items_named": popular_items_named,
    "top10_items": top10_items,
    "int_mean_by_key": int_mean_by_key,
    "spend_by_customer": spend_by_customer,
    "spend_sorted": spend_sorted,
    "count_by_category": count_by_category,
    "sql_range_view": sql_range_view,
    "df_basics": df_basics,
    "df_filter_lt": df_filter_lt,
    "df_count_by": df_count_by,
    "df_plus_ten": df_plus_ten,
}

ORACLE = {
    "min_by_station": f"""
        SELECT user_id AS station, min(value * 0.1 * 9 / 5 + 32) AS min_temp_f
        FROM events WHERE event_type = '{MIN_ENTRY_TYPE}' GROUP BY user_id""",
    "max_by_station": f"""
        SELECT user_id AS station, max(value * 0.1 * 9 / 5 + 32) AS max_temp_f
        FROM events WHERE event_type = '{MAX_ENTRY_TYPE}' GROUP BY user_id""",
    "min_station_report": f"""
        SELECT row_number() OVER (ORDER BY user_id) AS line_no,
               printf('%d minimum temperature: %.2f F', user_id, round(min(value * 0.1 * 9 / 5 + 32), 2)) AS line
        FROM events WHERE event_type = '{MIN_ENTRY_TYPE}' GROUP BY user_id""",
    "max_station_report": f"""
        SELECT row_number() OVER (ORDER BY user_id) AS line_no,
               printf('%d maximum temperature: %.2f F', user_id, round(max(value * 0.1 * 9 / 5 + 32), 2)) AS line
        FROM events WHERE event_type = '{MAX_ENTRY_TYPE}' GROUP BY user_id""",
    "value_histogram": "SELECT l_linenumber, count(*) AS n FROM lineitem GROUP BY 1",
    "first_rows": f"SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT {FIRST_N}",
    "popular_items": "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1",
    "popular_items_named": """
        SELECT c.l_partkey, p.p_name, c.n
        FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) c
        LEFT JOIN part p ON p.p_partkey = c.l_partkey""",
    "top10_items": f"""
        SELECT c.l_partkey, p.p_name, c.n
        FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1
              ORDER BY n DESC, l_partkey LIMIT {TOP_K}) c
        JOIN part p ON p.p_partkey = c.l_partkey""",
    "int_mean_by_key": """
        SELECT p_brand, CAST(sum(p_size) // count(p_size) AS BIGINT) AS avg_size
        FROM part GROUP BY 1""",
    "spend_by_customer": """
        SELECT o_custkey, round(sum(o_totalprice), 2) AS total_spent FROM orders GROUP BY 1""",
    "spend_sorted": """
        SELECT o_custkey, round(sum(o_totalprice), 2) AS total_spent, count(o_totalprice) AS n_orders
        FROM orders GROUP BY 1""",
    "count_by_category": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1",
    "sql_range_view": f"""
        SELECT c_custkey, c_name, c_acctbal FROM customer
        WHERE c_acctbal BETWEEN {RANGE_LO} AND {RANGE_HI}""",
    "df_basics": f"""SELECT c_name, c_acctbal, c_nationkey + 10 AS nation_plus_10 FROM customer
        WHERE c_acctbal < {LT_LIMIT}""",
    "df_filter_lt": f"SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal < {LT_LIMIT}",
    "df_count_by": "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1",
    "df_plus_ten": "SELECT c_name, c_nationkey + 10 AS nation_plus_10 FROM customer",
}
