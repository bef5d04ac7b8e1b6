"""Statistics jobs: describe, correlations, box plots, bootstrap, histogram,
hexagonal bins, interpolation.

Stand-ins: numeric features -> lineitem (quantity, price, discount, tax);
groups for box plots -> events.value by event_type; 2-D points ->
(l_quantity, l_extendedprice); series knots -> daily mean event value per
user (x = days since 1970-01-01), queried on a quarter-day grid.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import interpolate, stats
from sparkwright.sources.tables import table

NUM_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TARGET = "l_extendedprice"
STR_COLS = ["l_returnflag", "l_linestatus"]
BINS = 100
GRIDSIZE, MINCNT = 20, 7
GRID_STEP = 0.25
BOOT_REPLICATES = 10_000


def _r6(c):
    return scalar.round_half_away(F.col(c), 6).alias(c)


def describe(spark, root):
    """count, nulls, mean, sd, min, quartiles, max of every numeric column (long form)."""
    d = stats.describe(table(spark, root, "lineitem"), NUM_COLS)
    return d.select("column_name", "count", "n_nulls", _r6("mean"), _r6("stddev"), "min", "max",
                    _r6("q1"), _r6("median"), _r6("q3"))


def describe_strings(spark, root):
    """count, unique, most frequent value and its count of every string column."""
    return stats.describe_strings(table(spark, root, "lineitem"), STR_COLS)


def level_counts(spark, root):
    """Rows of every level of every string column, null as a level."""
    return stats.level_counts(table(spark, root, "lineitem"), STR_COLS)


def corr_with_target(spark, root):
    """Pearson correlation of each feature with the price, one aggregate."""
    cols = [c for c in NUM_COLS if c != TARGET]
    return stats.corr_with(table(spark, root, "lineitem"), cols, TARGET) \
        .select("column_name", _r6("corr"))


def corr_matrix(spark, root):
    """Correlation matrix of the numeric columns, long form."""
    return stats.corr_matrix(table(spark, root, "lineitem"), NUM_COLS) \
        .select("col_a", "col_b", _r6("r"))


def boxplot_stats(spark, root):
    """Box-plot statistics of event values per event type."""
    ev = table(spark, root, "events").select("event_type", "value")
    b = stats.boxplot_stats(ev, "event_type", "value")
    return b.select("event_type", "n", *[_r6(c) for c in
                    ("mean", "q1", "med", "q3", "iqr", "whislo", "whishi", "cilo", "cihi")])


def boxplot_outliers(spark, root):
    """Event rows outside their type's whiskers."""
    ev = table(spark, root, "events").select("event_id", "event_type", "value")
    return stats.boxplot_outliers(ev, "event_type", "value")


def bootstrap_ci(spark, root):
    """Box-plot row of the event values per type, with the 95 % interval of the median over
    10,000 resamples."""
    ev = table(spark, root, "events").select("event_type", "value")
    b = stats.boxplot_stats(ev, "event_type", "value", bootstrap=BOOT_REPLICATES)
    return b.select("event_type", "n", *[_r6(c) for c in
                    ("mean", "q1", "med", "q3", "iqr", "whislo", "whishi", "cilo", "cihi")],
                    F.lit(BOOT_REPLICATES).cast("bigint").alias("replicates"))


def histogram(spark, root):
    """100-bin density histogram of event values (empty bins included)."""
    h = stats.histogram(table(spark, root, "events"), "value", BINS)
    return h.select("bin", _r6("lo"), _r6("hi"), "n", _r6("density"))


def hexbin(spark, root):
    """Hexagonal bin counts of (quantity, price), cells with >= 7 points."""
    h = stats.hexbin(table(spark, root, "lineitem"), "l_quantity", "l_extendedprice", GRIDSIZE, MINCNT)
    return h.select("lattice", "ix", "iy", _r6("cx"), _r6("cy"), "n")


def _knots(spark, root):
    ev = table(spark, root, "events")
    # knots rounded to 9 decimals: engines sum a mean in different orders,
    # and equal knots make the interpolated values equal to the last bit
    return ev.groupBy("user_id", F.unix_date(F.to_date("ts")).cast("double").alias("x")) \
        .agg(scalar.round_half_away(F.avg("value"), 9).alias("y"))


def interpolate_linear(spark, root):
    """Daily mean per user interpolated linearly on a quarter-day grid."""
    k = _knots(spark, root)
    q = interpolate.regular_grid(k, "user_id", "x", GRID_STEP)
    return interpolate.interpolate_linear(k, q, "user_id", "x", "y")


def interpolate_cubic(spark, root):
    """Daily mean per user through a not-a-knot cubic spline on a quarter-day grid."""
    k = _knots(spark, root)
    q = interpolate.regular_grid(k, "user_id", "x", GRID_STEP)
    return interpolate.interpolate_cubic(k, q, "user_id", "x", "y").select("user_id", "x", _r6("y"))


JOBS = {
    "describe": describe,
    "describe_strings": describe_strings,
    "level_counts": level_counts,
    "corr_with_target": corr_with_target,
    "corr_matrix": corr_matrix,
    "boxplot_stats": boxplot_stats,
    "boxplot_outliers": boxplot_outliers,
    "bootstrap_ci": bootstrap_ci,
    "histogram": histogram,
    "hexbin": hexbin,
    "interpolate_linear": interpolate_linear,
    "interpolate_cubic": interpolate_cubic,
}


def _describe_sql():
    parts = []
    for c in NUM_COLS:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS count, count(*) - count({c}) AS n_nulls,
            round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev,
            CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
            round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS median,
            round(quantile_cont({c}, 0.75), 6) AS q3 FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


_BOX = """q AS (SELECT event_type, count(value) AS n, avg(value) AS mean,
        quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
        quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
    w AS (SELECT e.event_type, min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS lo,
        max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS hi
        FROM events e JOIN q USING (event_type) GROUP BY 1),
    b AS (SELECT q.*, q3 - q1 AS iqr,
        CASE WHEN lo IS NULL OR lo > q1 THEN q1 ELSE lo END AS whislo,
        CASE WHEN hi IS NULL OR hi < q3 THEN q3 ELSE hi END AS whishi FROM q JOIN w USING (event_type))"""

_KNOTS = """k AS (SELECT user_id, CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS DOUBLE) AS x,
        round(avg(value), 9) AS y FROM events GROUP BY 1, 2),
    r AS (SELECT user_id, min(x) AS lo, max(x) AS hi FROM k GROUP BY 1),
    q AS (SELECT user_id, lo + unnest(range(0, CAST(floor((hi - lo) / 0.25) AS BIGINT) + 1)) * 0.25 AS x FROM r)"""

ORACLE = {
    "describe": _describe_sql(),
    "level_counts": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, {c} AS level, count(*) AS n FROM lineitem GROUP BY 2" for c in STR_COLS),
    "describe_strings": "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS column_name, (SELECT count({c}) FROM lineitem) AS count,
              (SELECT count(DISTINCT {c}) FROM lineitem) AS unique,
              min(v) AS top, max(n) AS freq
            FROM (SELECT {c} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1
                  QUALIFY n = max(n) OVER ())""" for c in STR_COLS),
    "corr_with_target": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, round(corr({c}, {TARGET}), 6) AS corr FROM lineitem"
        for c in NUM_COLS if c != TARGET),
    "corr_matrix": "\nUNION ALL\n".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a in NUM_COLS for b in NUM_COLS),
    "boxplot_stats": f"""WITH {_BOX}
        SELECT event_type, n, round(mean, 6) AS mean, round(q1, 6) AS q1, round(med, 6) AS med,
          round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(whislo, 6) AS whislo, round(whishi, 6) AS whishi,
          round(med - 1.57 * iqr / sqrt(n), 6) AS cilo, round(med + 1.57 * iqr / sqrt(n), 6) AS cihi FROM b""",
    "boxplot_outliers": f"""WITH {_BOX}
        SELECT e.event_id, e.event_type, e.value FROM events e JOIN b USING (event_type)
        WHERE e.value < b.whislo OR e.value > b.whishi""",
    "histogram": f"""WITH v AS (SELECT value AS v FROM events WHERE value IS NOT NULL),
        st0 AS (SELECT CASE WHEN max(v) > min(v) THEN min(v) ELSE min(v) - 0.5 END AS lo0,
                       CASE WHEN max(v) > min(v) THEN max(v) ELSE max(v) + 0.5 END AS hi0,
                       count(*) AS tot FROM v),
        st AS (SELECT *, (hi0 - lo0) / {BINS} AS step, {BINS} / (hi0 - lo0) AS norm FROM st0),
        i1 AS (SELECT v, least(CAST(floor((v - lo0) * norm) AS INTEGER), {BINS - 1}) AS i, lo0, hi0, step
               FROM v, st),
        i2 AS (SELECT v, CASE WHEN v < (CASE WHEN i >= {BINS} THEN hi0 ELSE CAST(i AS DOUBLE) * step + lo0 END)
                         THEN i - 1 ELSE i END AS i, lo0, hi0, step FROM i1),
        i3 AS (SELECT CASE WHEN v >= (CASE WHEN i + 1 >= {BINS} THEN hi0 ELSE CAST(i + 1 AS DOUBLE) * step + lo0 END)
                            AND i <> {BINS - 1} THEN i + 1 ELSE i END AS bin FROM i2),
        c AS (SELECT bin, count(*) AS n FROM i3 GROUP BY bin),
        g AS (SELECT CAST(unnest(range(0, {BINS})) AS INTEGER) AS bin),
        e AS (SELECT g.bin, CASE WHEN g.bin >= {BINS} THEN hi0 ELSE CAST(g.bin AS DOUBLE) * step + lo0 END AS lo,
                     CASE WHEN g.bin + 1 >= {BINS} THEN hi0 ELSE CAST(g.bin + 1 AS DOUBLE) * step + lo0 END AS hi,
                     tot FROM g CROSS JOIN st)
        SELECT e.bin, round(lo, 6) AS lo, round(hi, 6) AS hi, coalesce(c.n, 0) AS n,
          round(coalesce(c.n, 0) / (tot * (hi - lo)), 6) AS density
        FROM e LEFT JOIN c USING (bin)""",
    "hexbin": f"""WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem
                        WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL),
        st AS (SELECT min(x) - 1e-9 * (max(x) - min(x)) AS xmin, max(x) + 1e-9 * (max(x) - min(x)) AS xmax,
                      min(y) AS ymin, max(y) AS ymax FROM p),
        s2 AS (SELECT *, (xmax - xmin) / {GRIDSIZE} AS sx, (ymax - ymin) / {int(GRIDSIZE / 3 ** 0.5)} AS sy FROM st),
        g AS (SELECT (x - xmin) / sx AS ix, (y - ymin) / sy AS iy, xmin, ymin, sx, sy FROM p, s2),
        c AS (SELECT *, round_even(ix, 0) AS ix1, round_even(iy, 0) AS iy1, floor(ix) AS ix2,
                     floor(iy) AS iy2 FROM g),
        d AS (SELECT *, pow(ix - ix1, 2) + 3.0 * pow(iy - iy1, 2)
                        < pow(ix - ix2 - 0.5, 2) + 3.0 * pow(iy - iy2 - 0.5, 2) AS f FROM c),
        e AS (SELECT CASE WHEN f THEN 1 ELSE 2 END AS lattice,
                     CAST(CASE WHEN f THEN ix1 ELSE ix2 END AS INTEGER) AS cx_i,
                     CAST(CASE WHEN f THEN iy1 ELSE iy2 END AS INTEGER) AS cy_i, xmin, ymin, sx, sy FROM d),
        i AS (SELECT * FROM e WHERE CASE WHEN lattice = 1
                THEN cx_i BETWEEN 0 AND {GRIDSIZE} AND cy_i BETWEEN 0 AND {int(GRIDSIZE / 3 ** 0.5)}
                ELSE cx_i >= 0 AND cx_i < {GRIDSIZE} AND cy_i >= 0 AND cy_i < {int(GRIDSIZE / 3 ** 0.5)} END)
        SELECT lattice, cx_i AS ix, cy_i AS iy,
          round(xmin + (cx_i + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END) * sx, 6) AS cx,
          round(ymin + (cy_i + CASE WHEN lattice = 1 THEN 0.0 ELSE 0.5 END) * sy, 6) AS cy,
          count(*) AS n FROM i GROUP BY lattice, cx_i, cy_i, xmin, ymin, sx, sy HAVING count(*) >= {MINCNT}""",
    "interpolate_linear": f"""WITH {_KNOTS},
        u AS (SELECT user_id, x, y, 0 AS isq FROM k UNION ALL SELECT user_id, x, NULL, 1 FROM q),
        w AS (SELECT *,
          last_value(CASE WHEN isq = 0 THEN x END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY x, isq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x0,
          last_value(CASE WHEN isq = 0 THEN y END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY x, isq
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y0,
          first_value(CASE WHEN isq = 0 THEN x END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY x, isq
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS x1,
          first_value(CASE WHEN isq = 0 THEN y END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY x, isq
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS y1 FROM u)
        SELECT user_id, x, CASE WHEN x0 = x THEN y0 ELSE y0 + (y1 - y0) * (x - x0) / (x1 - x0) END AS y
        FROM w WHERE isq = 1""",
    # tridiagonal system per user by recursion over the knots, down and up; under four knots the polynomial
    "interpolate_cubic": f"""WITH RECURSIVE {_KNOTS},
        o AS MATERIALIZED (SELECT user_id, x, y, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n,
          x - lag(x) OVER w AS a, lead(x) OVER w - x AS b, (y - lag(y) OVER w) / (x - lag(x) OVER w) AS sa,
          (lead(y) OVER w - y) / (lead(x) OVER w - x) AS sb FROM k WINDOW w AS (PARTITION BY user_id ORDER BY x)),
        e AS MATERIALIZED (SELECT user_id, i, n, CASE i WHEN 1 THEN 0 WHEN n - 2 THEN a - b * b / a ELSE a END AS low,
          CASE i WHEN 1 THEN (a + b) * (2 + a / b) WHEN n - 2 THEN (a + b) * (2 + b / a) ELSE 2 * (a + b) END AS mid,
          CASE i WHEN n - 2 THEN 0 WHEN 1 THEN b - a * a / b ELSE b END AS up, 6 * (sb - sa) AS rhs
          FROM o WHERE n >= 4 AND i BETWEEN 1 AND n - 2),
        down AS (SELECT user_id, i, n, up / mid AS c, rhs / mid AS d FROM e WHERE i = 1
          UNION ALL SELECT e.user_id, e.i, e.n, e.up / (e.mid - e.low * p.c), (e.rhs - e.low * p.d) / (e.mid - e.low * p.c)
          FROM down p JOIN e ON e.user_id = p.user_id AND e.i = p.i + 1),
        kept AS MATERIALIZED (SELECT * FROM down),
        upward AS (SELECT user_id, i, d AS m FROM kept WHERE i = n - 2
          UNION ALL SELECT t.user_id, t.i, t.d - t.c * p.m FROM upward p JOIN kept t ON t.user_id = p.user_id AND t.i = p.i - 1),
        inner_m AS MATERIALIZED (SELECT * FROM upward),
        m AS MATERIALIZED (SELECT o.user_id, o.i, o.n, o.x, o.y, CASE WHEN o.i = 0 THEN
            ((o.b + f.b) * f1.m - o.b * f2.m) / f.b WHEN o.i = o.n - 1 THEN ((g.a + o.a) * g1.m - o.a * g2.m) / g.a ELSE own.m END AS m
          FROM o LEFT JOIN inner_m own ON own.user_id = o.user_id AND own.i = o.i
          LEFT JOIN o f ON f.user_id = o.user_id AND f.i = 1
          LEFT JOIN inner_m f1 ON f1.user_id = o.user_id AND f1.i = 1 LEFT JOIN inner_m f2 ON f2.user_id = o.user_id AND f2.i = 2
          LEFT JOIN o g ON g.user_id = o.user_id AND g.i = o.n - 2
          LEFT JOIN inner_m g1 ON g1.user_id = o.user_id AND g1.i = o.n - 2
          LEFT JOIN inner_m g2 ON g2.user_id = o.user_id AND g2.i = o.n - 3),
        pos AS (SELECT q.user_id, q.x, least(p.i, p.n - 2) AS i, p.n FROM q ASOF JOIN m p ON p.user_id = q.user_id AND q.x >= p.x),
        few AS (SELECT user_id, x, sum(w) AS v FROM (SELECT pos.user_id, pos.x, p.i, any_value(p.y)
            * coalesce(product((pos.x - r.x) / (p.x - r.x)), 1) AS w
          FROM pos JOIN m p ON p.user_id = pos.user_id AND pos.n < 4 LEFT JOIN m r ON r.user_id = pos.user_id AND r.i <> p.i GROUP BY 1, 2, 3)
          GROUP BY 1, 2)
        SELECT pos.user_id, pos.x, round(coalesce(few.v, l.m * pow(r.x - pos.x, 3) / (6 * (r.x - l.x)) + r.m * pow(pos.x - l.x, 3) / (6 * (r.x - l.x))
          + (l.y / (r.x - l.x) - l.m * (r.x - l.x) / 6) * (r.x - pos.x) + (r.y / (r.x - l.x) - r.m * (r.x - l.x) / 6) * (pos.x - l.x)), 6) AS y
        FROM pos LEFT JOIN few ON few.user_id = pos.user_id AND few.x = pos.x LEFT JOIN m l ON l.user_id = pos.user_id AND l.i = pos.i
          LEFT JOIN m r ON r.user_id = pos.user_id AND r.i = pos.i + 1""",
}
