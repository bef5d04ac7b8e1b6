"""Type profile / optimiser / category / table profile jobs.

Stand-ins: the wide game-log table -> lineitem (ints, floats, strings, a
timestamp); low-cardinality strings -> orders status and priority; the table
to profile -> customer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import distinct, stats, types
from sparkwright.session import write_shared
from sparkwright.sources.tables import table

# (column, Spark type) of the tables the oracle SQL is generated for
LINEITEM_COLS = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
                 ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
                 ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
                 ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]
CUSTOMER_COLS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")]
CATEGORY_COLS = ["o_orderstatus", "o_orderpriority"]


def type_profile(spark, root):
    """Per column: type, rows, nulls, min, max, distinct values, bytes, float32 exactness."""
    return types.column_stats(table(spark, root, "lineitem"))


def optimize_types(spark, root):
    """Narrowed type of every numeric and string column (before / after / Spark type)."""
    return types.type_plan(table(spark, root, "lineitem"))


def optimized_table(spark, root):
    """lineitem rewritten with the narrowed numeric types and category codes.

    The plan has one row per column (bounded by the schema, not the data), so
    it is read on the driver to build the ``select`` of casts.
    """
    li = table(spark, root, "lineitem")
    plan = [(r["column_name"], r["spark_type"]) for r in types.type_plan(li).collect()]
    return types.apply_types(li, plan, categories=True)


def profile_correlations(spark, root):
    """Correlations between the numeric columns of the profiled table."""
    num = [n for n, t in CUSTOMER_COLS if t in ("bigint", "int", "double")]
    return stats.corr_matrix(table(spark, root, "customer"), num).select(
        "col_a", "col_b", scalar.round_half_away("r", 6).alias("r"))


def type_savings(spark, root):
    """Megabytes before and after the type plan, in all and the mean per column, by kind of type
    (a category counts its 4-byte codes, its dictionary aside)."""
    return types.savings(table(spark, root, "lineitem"))


def category_codes(spark, root):
    """Sorted-dictionary codes of low-cardinality order columns (null -> -1)."""
    o = table(spark, root, "orders").select("o_orderkey", *CATEGORY_COLS)
    return types.category_codes(o, CATEGORY_COLS).select(
        "o_orderkey", *[f"{c}_code" for c in CATEGORY_COLS])


def profile_table(spark, root):
    """Whole-table profile: types, nulls, distinct counts, range, moments, quartiles."""
    c = table(spark, root, "customer")
    st = types.column_stats(c).select("column_name", "data_type", "n_rows", "n_nulls", "n_distinct",
                                      "min_value", "max_value")
    num = [n for n, t in CUSTOMER_COLS if t in ("bigint", "int", "double")]
    d = stats.describe(c, num).select("column_name", scalar.round_half_away("mean", 6).alias("mean"),
                                      scalar.round_half_away("stddev", 6).alias("stddev"), scalar.round_half_away("q1", 6).alias("q1"),
                                      scalar.round_half_away("median", 6).alias("median"), scalar.round_half_away("q3", 6).alias("q3"))
    return st.join(d, "column_name", "left")


def stored_sketches(spark, root):
    """Distinct values of every customer column from sketches stored once per segment and merged; ``close`` says
    whether the estimate is within 5 % of the exact count."""
    c = table(spark, root, "customer")
    names = [n for n, _ in CUSTOMER_COLS if n != "c_mktsegment"]
    whole = distinct.merged(write_shared(distinct.sketches(c, "c_mktsegment"), "sketches"))
    exact = distinct.distinct_counts(c, names).select("column_name", F.col("n_distinct").alias("exact"))
    return whole.join(exact, "column_name").select(
        "column_name", "exact", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


JOBS = {
    "type_profile": type_profile,
    "stored_sketches": stored_sketches,
    "optimize_types": optimize_types,
    "optimized_table": optimized_table,
    "type_savings": type_savings,
    "profile_correlations": profile_correlations,
    "category_codes": category_codes,
    "profile_table": profile_table,
}

# values written out so that the SQL checks the library's own
WIDTH_SQL = {"int": 4, "bigint": 8, "double": 8, "timestamp_ntz": 8}
UNSIGNED_SQL = [("uint8", 255), ("uint16", 65535), ("uint32", 4294967295), ("uint64", 18446744073709551615)]
SIGNED_SQL = [("tinyint", -128, 127), ("smallint", -32768, 32767), ("int", -2147483648, 2147483647)]
FLOAT32_SQL = "3.4028234663852886e38"


def _num(t):
    return t in ("bigint", "int", "double")


def _stats_sql(tab, cols):
    parts = []
    for c, t in cols:
        mn = f"CAST(min({c}) AS DOUBLE)" if _num(t) else "CAST(NULL AS DOUBLE)"
        mx = f"CAST(max({c}) AS DOUBLE)" if _num(t) else "CAST(NULL AS DOUBLE)"
        exact = [f"CAST({f}({c}) AS BIGINT)" if t in ("bigint", "int") else "CAST(NULL AS BIGINT)" for f in ("min", "max")]
        b = f"sum(strlen({c}))" if t == "string" else f"count(*) * {WIDTH_SQL[t]}"
        fx = (f"bool_and(CASE WHEN {c} IS NULL OR isnan({c}) THEN true "
              f"ELSE CAST(CAST({c} AS FLOAT) AS DOUBLE) = {c} END)") if t == "double" else "CAST(NULL AS BOOLEAN)"
        parts.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows,
            count(*) - count({c}) AS n_nulls, {mn} AS min_value, {mx} AS max_value,
            {exact[0]} AS min_int, {exact[1]} AS max_int,
            count(DISTINCT {c}) AS n_distinct, CAST({b} AS BIGINT) AS bytes, {fx} AS f32_exact FROM {tab}""")
    return "\nUNION ALL\n".join(parts)


def _plan_sql():
    ints = ", ".join(f"'{c}'" for c, t in LINEITEM_COLS if t in ("bigint", "int"))
    flts = ", ".join(f"'{c}'" for c, t in LINEITEM_COLS if t == "double")
    strs = ", ".join(f"'{c}'" for c, t in LINEITEM_COLS if t == "string")
    uns = " ".join(f"WHEN min_int >= 0 AND max_int <= {hi} THEN '{n}'" for n, hi in UNSIGNED_SQL)
    sig = " ".join(f"WHEN min_int >= {lo} AND max_int <= {hi} THEN '{n}'" for n, lo, hi in SIGNED_SQL)
    fits = f"(min_value IS NULL OR (abs(min_value) <= {FLOAT32_SQL} AND abs(max_value) <= {FLOAT32_SQL}))"
    ratio = "(n_distinct + CASE WHEN n_nulls > 0 THEN 1 ELSE 0 END) / n_rows"
    return f"""WITH s AS ({_stats_sql('lineitem', LINEITEM_COLS)})
        SELECT column_name, data_type AS before,
          CASE WHEN min_value IS NULL THEN 'int64' {uns} ELSE 'int64' END AS after,
          CASE WHEN min_value IS NULL THEN 'bigint' {sig} ELSE 'bigint' END AS spark_type
        FROM s WHERE column_name IN ({ints})
        UNION ALL
        SELECT column_name, data_type, CASE WHEN {fits} THEN 'float32' ELSE 'float64' END,
          CASE WHEN {fits} THEN 'float' ELSE 'double' END FROM s WHERE column_name IN ({flts})
        UNION ALL
        SELECT column_name, data_type, CASE WHEN {ratio} < 0.5 THEN 'category' ELSE 'object' END,
          CASE WHEN {ratio} < 0.5 THEN 'string+code' ELSE 'string' END
        FROM s WHERE column_name IN ({strs})"""


def _profile_sql():
    parts = []
    for c, t in CUSTOMER_COLS:
        n = _num(t)
        mom = (f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
               f"round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median, "
               f"round(quantile_cont({c}, 0.75), 6) AS q3") if n else \
            ("CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS q1, "
             "CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS q3")
        mn = f"CAST(min({c}) AS DOUBLE)" if n else "CAST(NULL AS DOUBLE)"
        mx = f"CAST(max({c}) AS DOUBLE)" if n else "CAST(NULL AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows,
            count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, {mn} AS min_value,
            {mx} AS max_value, {mom} FROM customer""")
    return "\nUNION ALL\n".join(parts)


def _optimized_sql():
    """Narrowest type of each column by its own bounds at the tested size: the SQL reads the same rule
    from the plan, so only the casts and codes are spelled out here."""
    cols = []
    for c, t in LINEITEM_COLS:
        if t == "string":
            cols.append(f"CAST(CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY {c} IS NULL "
                        f"ORDER BY {c}) - 1 END AS INTEGER) AS {c}_code")
        elif t == "double":
            cols.append(f"CAST({c} AS FLOAT) AS {c}")
        else:
            cols.append(c)
    return "SELECT " + ", ".join(cols) + " FROM lineitem"


def _savings_sql():
    after = "CASE spark_type " + " ".join(f"WHEN '{t}' THEN {n}" for t, n in (
        ("tinyint", 1), ("smallint", 2), ("int", 4), ("bigint", 8), ("float", 4), ("double", 8), ("string+code", 4))) + " END"
    return f"""WITH p AS ({_plan_sql()}), s AS ({_stats_sql('lineitem', LINEITEM_COLS)}),
        b AS (SELECT CASE WHEN before = 'string' THEN 'string' WHEN before = 'double' THEN 'float' ELSE 'int' END AS kind,
                     s.bytes, CASE WHEN spark_type = 'string' THEN s.bytes ELSE s.n_rows * {after} END AS after
              FROM p JOIN s USING (column_name))
        SELECT kind, count(*) AS n_columns, round(sum(bytes) / 1048576.0, 6) AS mb_before,
               round(sum(after) / 1048576.0, 6) AS mb_after, round(avg(bytes) / 1048576.0, 6) AS mean_mb_before,
               round(avg(after) / 1048576.0, 6) AS mean_mb_after FROM b GROUP BY 1"""


ORACLE = {
    "stored_sketches": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS exact, true AS close FROM customer"
        for c, _ in CUSTOMER_COLS if c != "c_mktsegment"),
    "type_savings": _savings_sql(),
    "profile_correlations": "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM customer"
        for a in ("c_custkey", "c_nationkey", "c_acctbal") for b in ("c_custkey", "c_nationkey", "c_acctbal")),
    "optimized_table": _optimized_sql(),
    "type_profile": _stats_sql("lineitem", LINEITEM_COLS),
    "optimize_types": _plan_sql(),
    "category_codes": "SELECT o_orderkey, " + ", ".join(
        f"CAST(CASE WHEN {c} IS NULL THEN -1 ELSE dense_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) - 1 END"
        f" AS INTEGER) AS {c}_code" for c in CATEGORY_COLS) + " FROM orders",
    "profile_table": _profile_sql(),
}
