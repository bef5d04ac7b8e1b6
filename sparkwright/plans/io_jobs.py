"""Jobs that write and read back: results per month, learned types, labelled points, JSON, catalog tables,
synthetic columns; a user's combiner, the complement of a sample and schema reports.

Stand-ins: the files are rendered from the orders and line items. Copies are written under the session's checkpoint
folder and belong to the job (see ``session.Copies``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import combine, joins, models, types
from sparkwright.plans import types_jobs
from sparkwright.session import shared_path
from sparkwright.sources import learned, readers, sinks, synthetic
from sparkwright.sources.tables import table

SEED = 42
RERUN_MONTH = "1995-03"
BAD_EVERY = 997
TOLERANCE = 0.01


def _monthly(spark, root):
    o = table(spark, root, "orders")
    return o.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("output"),
                    "o_orderkey", "o_totalprice")


def monthly_results(spark, root):
    """Orders written per month and status in one pass, one month written again (with doubled prices), and that month and
    its neighbours read back: the rerun replaces its own month only."""
    path, rows = shared_path(spark, "monthly"), _monthly(spark, root)
    sinks.write_parts(rows, path, ["month", "output"])
    again = rows.where(F.col("month") == RERUN_MONTH).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    sinks.write_parts(again, path, ["month", "output"])
    back = spark.read.parquet(path).where(F.col("month").cast("string").between("1995-02", "1995-04"))
    return back.groupBy(F.col("month").cast("string").alias("month"), "output").agg(
        F.count(F.lit(1)).alias("n"), scalar.round_half_away(F.sum(F.col("o_totalprice").cast("decimal(38,2)")).cast("double"), 2).alias("total"))


def month_read_back(spark, root):
    """One status of one month, read back: the scan lists that folder alone."""
    path = shared_path(spark, "monthly")
    sinks.write_parts(_monthly(spark, root), path, ["month", "output"])
    return sinks.read_parts(spark, path, month=RERUN_MONTH, output="F").select("o_orderkey", "o_totalprice")


def _order_file(spark, root):
    """Orders as delimited text with integer-coded days; every ``BAD_EVERY``-th line has a price that is no number."""
    o = table(spark, root, "orders")
    price = F.when(F.col("o_orderkey") % BAD_EVERY == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    path = shared_path(spark, "order-lines")
    o.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "yyyyMMdd"), price,
                         F.col("o_orderstatus"), (F.col("o_custkey") % 2 == 0).cast("string"), F.lit(""))).write.text(path)
    return learned.read_fields(spark, path, ["key", "day", "price", "status", "even", "nothing"], sep="|")


def learned_schema(spark, root):
    """Type of every field of the order file, learned in one pass, with the fields that do not parse."""
    return learned.learned_schema(_order_file(spark, root), TOLERANCE)


def typed_reread(spark, root):
    """The order file re-read with its learned types: orders and prices per year, and the rejected lines as a year of null."""
    raw = _order_file(spark, root)
    good, rejected = learned.typed_and_rejected(raw, learned.learn_types(raw, TOLERANCE))
    years = good.groupBy(F.year("day").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("even").alias("n_even"), F.min("key").alias("first_key"))
    return years.unionByName(rejected.where(F.array_contains("bad_columns", "price")).agg(
        F.lit(None).cast("int").alias("year"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("bigint").alias("n_even"),
        F.min(F.col("key").cast("bigint")).alias("first_key")))


def labelled_points(spark, root):
    """Line items written as "label,feature" lines and read as labelled vectors: moments of label and feature."""
    li, path = table(spark, root, "lineitem"), shared_path(spark, "points")
    li.select(F.concat_ws(",", F.col("l_quantity").cast("string"), F.col("l_discount").cast("string"))).write.text(path)
    from pyspark.ml.functions import vector_to_array
    points = readers.read_labelled(spark, path).select("label", vector_to_array("features")[0].alias("x"))
    r6 = lambda c: scalar.round_half_away(c, 6)
    return points.agg(F.count(F.lit(1)).alias("n"), r6(F.avg("label")).alias("label_mean"), r6(F.avg("x")).alias("x_mean"),
                      r6(F.sum(F.col("label") * F.col("x")) / F.count(F.lit(1))).alias("product_mean"))


def json_orders(spark, root):
    """Orders with their lines as nested JSON, read with a declared schema; lines that are no JSON are rescued and counted."""
    li = table(spark, root, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"))).alias("lines"))  # at most seven of an order
    o = table(spark, root, "orders").join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    text = F.to_json(F.struct(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("lines")))
    path = shared_path(spark, "json")
    o.select(F.when(F.col("o_orderkey") % BAD_EVERY == 0, F.concat(F.lit("cut "), text)).otherwise(text)).write.text(path)
    back = readers.read_json_declared(spark, path, "key bigint, status string, lines array<struct<line: int, quantity: double>>")
    lines = F.coalesce(F.size("lines"), F.lit(0))
    return back.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_rescue").isNotNull()).alias("n_rescued"), F.sum(F.greatest(lines, F.lit(0))).alias("n_lines"),
        F.sum(F.aggregate(F.coalesce("lines", F.array().cast("array<struct<line:int,quantity:double>>")), F.lit(0.0),
                          lambda acc, x: acc + x.quantity)).alias("quantity"))


def catalog_table(spark, root):
    """A table saved to the catalog, read by name in SQL, and dropped."""
    name, path = f"sparkwright_segments_{uuid.uuid4().hex}", shared_path(spark, "segments")
    table(spark, root, "customer").select("c_mktsegment", "c_acctbal").write.option("path", path).saveAsTable(name)
    try:
        out = spark.sql(f"SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS most FROM {name} GROUP BY c_mktsegment")
        out.schema  # resolved while the name exists; the files stay with the job
        return out
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def synthetic_columns(spark, root):
    """Normal, lognormal, integer and letter columns of the customers, drawn from counters."""
    c = table(spark, root, "customer").select("c_custkey")
    c = synthetic.with_random(c, "z", "normal", "c_custkey", SEED)
    c = synthetic.with_random(c, "price", "lognormal", "c_custkey", SEED + 1, mean=1.5, sigma=0.5)
    c = synthetic.with_random(c, "age", "randint", "c_custkey", SEED + 2, lo=18, hi=90)
    c = synthetic.with_random(c, "word", "letters", "c_custkey", SEED + 3, min_len=2, max_len=5)
    return c.select("c_custkey", scalar.round_half_away("z", 9).alias("z"), scalar.round_half_away("price", 9).alias("price"), "age", "word")


def _top3(pdf):
    ordered = pdf.sort_values(["l_extendedprice", "l_orderkey", "l_linenumber"], ascending=[False, True, True])
    return ordered.groupby("l_suppkey", dropna=False, sort=False).head(3)


def _product(pdf):
    return pdf.groupby("l_suppkey", dropna=False, as_index=False)["factor"].prod()


def combine_top3(spark, root):
    """Three dearest lines of every supplier, by a user's combiner."""
    return combine.combine(table(spark, root, "lineitem"), "l_suppkey", _top3,
                           "l_suppkey bigint, l_orderkey bigint, l_linenumber int, l_extendedprice double")


def combine_product(spark, root):
    """Product of 1 + discount / 100 over every supplier's lines, by a user's combiner."""
    li = table(spark, root, "lineitem").select("l_suppkey", (1 + F.col("l_discount") / 100).alias("factor"))
    return combine.combine(li, "l_suppkey", _product, "l_suppkey bigint, factor double").select(
        "l_suppkey", scalar.round_half_away("factor", 6).alias("factor"))


def sample_complement(spark, root):
    """The documents that the exact sample leaves out."""
    return models.sample_exact(table(spark, root, "documents").select("doc_id", "lang"), "doc_id", 0.75, SEED)[1]


def type_changes(spark, root):
    """Types of the line items before and after optimisation, side by side, and how many columns of each type."""
    li = table(spark, root, "lineitem")
    plan = [(r["column_name"], r["spark_type"]) for r in types.type_plan(li).collect()]  # one entry per column
    after = types.apply_types(li, plan)
    both = joins.compare_types(li, after)
    counts = types.type_counts(after).select(F.col("data_type").alias("after"), F.col("count").alias("columns_of_type"))
    return both.join(counts, "after").select("column_name", "before", "after", "columns_of_type")


def columns_by_type(spark, root):
    """Means of the line items' columns of type double, chosen by type, per returned flag recoded to 0 and 1, with the
    lines whose order number leaves no remainder by three."""
    li = table(spark, root, "lineitem")
    chosen = scalar.select_by_type(li, ["double"])
    flag = scalar.recode_bool(F.col("l_returnflag") == "R").alias("returned")
    return li.groupBy(flag).agg(
        *[scalar.round_half_away(F.avg(c), 6).alias(f"mean_{c}") for c in chosen], F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("l_orderkey") % 3 == 0).alias("n_by_three"))


JOBS = {
    "columns_by_type": columns_by_type,
    "monthly_results": monthly_results,
    "month_read_back": month_read_back,
    "learned_schema": learned_schema,
    "typed_reread": typed_reread,
    "labelled_points": labelled_points,
    "json_orders": json_orders,
    "catalog_table": catalog_table,
    "synthetic_columns": synthetic_columns,
    "combine_top3": combine_top3,
    "combine_product": combine_product,
    "sample_complement": sample_complement,
    "type_changes": type_changes,
}


def _u(seed, draw):
    return f"('0x' || substr(md5('{seed}:' || c_custkey::VARCHAR || ':{draw}'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0"


def _z(seed):
    return f"sqrt(-2.0 * ln(1.0 - {_u(seed, 0)})) * cos(2 * pi() * {_u(seed, 1)})"


_WORD = " || ".join(f"CASE WHEN {k} <= floor({_u(45, 0)} * 4) + 2 THEN chr((97 + floor({_u(45, k)} * 26))::INT) ELSE '' END" for k in range(1, 6))

ORACLE = {
    "columns_by_type": """SELECT CAST(l_returnflag = 'R' AS INTEGER) AS returned, round(avg(l_quantity), 6) AS mean_l_quantity,
        round(avg(l_extendedprice), 6) AS mean_l_extendedprice, round(avg(l_discount), 6) AS mean_l_discount, round(avg(l_tax), 6) AS mean_l_tax,
        count(*) AS n, count(*) FILTER (l_orderkey % 3 = 0) AS n_by_three FROM lineitem GROUP BY 1""",
    "type_changes": f"""WITH p AS (SELECT column_name, before, CASE spark_type WHEN 'string+code' THEN 'string' ELSE spark_type END AS after
          FROM ({types_jobs.ORACLE['optimize_types']}) UNION ALL SELECT 'l_shipdate', 'timestamp_ntz', 'timestamp_ntz')
        SELECT column_name, before, after, count(*) OVER (PARTITION BY after) AS columns_of_type FROM p""",
    "monthly_results": f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS output, count(*) AS n,
        CAST(round(sum(CAST(o_totalprice * CASE strftime(o_orderdate, '%Y-%m') WHEN '{RERUN_MONTH}' THEN 2 ELSE 1 END AS DECIMAL(38, 2))), 2) AS DOUBLE) AS total
        FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-02' AND '1995-04' GROUP BY 1, 2""",
    "month_read_back": f"""SELECT o_orderkey, o_totalprice FROM orders
        WHERE strftime(o_orderdate, '%Y-%m') = '{RERUN_MONTH}' AND o_orderstatus = 'F'""",
    "learned_schema": f"""SELECT * FROM (SELECT 'key' AS column_name, 'int' AS learned_type, count(*) AS n_filled, 0::BIGINT AS n_bad FROM orders
        UNION ALL SELECT 'day', 'day', count(*), 0 FROM orders
        UNION ALL SELECT 'price', 'double', count(*), count(*) FILTER (o_orderkey % {BAD_EVERY} = 0) FROM orders
        UNION ALL SELECT 'status', 'string', count(*), 0 FROM orders UNION ALL SELECT 'even', 'boolean', count(*), 0 FROM orders
        UNION ALL SELECT 'nothing', 'string', 0, 0)""",
    "typed_reread": f"""SELECT CASE WHEN o_orderkey % {BAD_EVERY} = 0 THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS year, count(*) AS n,
        count(*) FILTER (o_custkey % 2 = 0 AND o_orderkey % {BAD_EVERY} <> 0) AS n_even, min(o_orderkey) AS first_key FROM orders GROUP BY 1""",
    "labelled_points": """SELECT count(*) AS n, round(avg(l_quantity), 6) AS label_mean, round(avg(l_discount), 6) AS x_mean,
        round(sum(l_quantity * l_discount) / count(*), 6) AS product_mean FROM lineitem""",
    "json_orders": f"""WITH l AS (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
        o AS (SELECT CASE WHEN o_orderkey % {BAD_EVERY} = 0 THEN NULL ELSE o_orderstatus END AS status, o_orderkey % {BAD_EVERY} = 0 AS bad,
              coalesce(l.n, 0) AS n, coalesce(l.q, 0) AS q FROM orders LEFT JOIN l ON l_orderkey = o_orderkey)
        SELECT status, count(*) AS n, count(*) FILTER (bad) AS n_rescued, CAST(sum(CASE WHEN bad THEN 0 ELSE n END) AS BIGINT) AS n_lines,
          sum(CASE WHEN bad THEN 0 ELSE q END)::DOUBLE AS quantity FROM o GROUP BY 1""",
    "catalog_table": "SELECT c_mktsegment, count(*) AS n, max(c_acctbal) AS most FROM customer GROUP BY 1",
    "synthetic_columns": f"""SELECT c_custkey, round({_z(42)}, 9) AS z, round(exp(1.5 + 0.5 * ({_z(43)})), 9) AS price,
        CAST(floor({_u(44, 0)} * 73) + 18 AS INTEGER) AS age, {_WORD} AS word FROM customer""",
    "combine_top3": """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (
        PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k <= 3""",
    "combine_product": "SELECT l_suppkey, round(product(1 + l_discount / 100), 6) AS factor FROM lineitem GROUP BY 1",
    "sample_complement": """SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (
        ORDER BY ('0x' || substr(md5(doc_id::VARCHAR || ':42'), 1, 13))::BIGINT, doc_id) AS n, count(*) OVER () AS total FROM documents)
        WHERE n > floor(0.75 * total)""",
}
