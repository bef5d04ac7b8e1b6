"""Row-shape jobs: sessions, pivots, win rates, names, distinct counts,
collection / string functions, ledger replay.

Stand-ins: journal -> events (customer = user_id, time = ts, id = event_id);
long features -> events (feature = event_type); tips -> lineitem (odds =
extended price / 1000, a win = return flag 'R'); deposits and withdrawals ->
events (purchase and error are withdrawals of ``value``, the rest deposits).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import collections as C
from sparkwright.functions import scalar
from sparkwright.operators import agg, windows
from sparkwright.sources.tables import table

SESSION_GAP_S = 900
WIN_RATE_MAX_ODDS = 21
LEDGER_MIN = 0.0
_WITHDRAWALS = ("purchase", "error")
FEATURES = ("click", "error", "purchase", "signup", "view")


def sessionize(spark, root):
    """Session start flag (gap > 900 s) and running session number per user and day."""
    ev = table(spark, root, "events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    s = windows.sessionize(ev, ["user_id", "day"], "ts", "event_id", SESSION_GAP_S, bucket_seconds=3600)
    return s.select("event_id", "user_id", "day", "prev_ts_us", "session_start_flag", "session_no")


def pivot_features(spark, root):
    """(user, day) rows, one column per declared feature holding its first value by (ts, id)."""
    ev = table(spark, root, "events").select(
        "user_id", F.to_date("ts").alias("day"), "ts", "event_id", "value",
        F.translate("event_type", ".", "_").alias("feature"))
    return windows.pivot_first(ev, ["user_id", "day"], "feature", FEATURES, "value", ["ts", "event_id"])


def _win_rate(spark, root):
    li = table(spark, root, "lineitem")
    t = li.select(scalar.round_half_even(F.col("l_extendedprice") / 1000.0).alias("odds_rnd"),
                  (F.col("l_returnflag") == "R").cast("int").alias("result_int"))
    r = agg.rate_by(t, "odds_rnd", "result_int", "win_rate")
    implied = F.when(F.col("odds_rnd") == 0, F.lit(float("inf"))).otherwise(1.0 / F.col("odds_rnd"))
    return r.withColumn("implied_win_rate", implied)


def win_rate(spark, root):
    """Observed win rate per rounded odds (half-even) next to the implied rate 1/odds."""
    r = _win_rate(spark, root)
    return r.select("odds_rnd", scalar.round_half_away("win_rate", 6).alias("win_rate"),
                    scalar.round_half_away("implied_win_rate", 6).alias("implied_win_rate"))


def win_rate_long(spark, root):
    """Win rates for odds < 21 gathered to long form (group, value)."""
    r = win_rate(spark, root).filter(F.col("odds_rnd") < WIN_RATE_MAX_ODDS)
    return r.unpivot(["odds_rnd"], ["win_rate", "implied_win_rate"], "win_rate_group", "value")


def clean_names(spark, root):
    """Column names lower-cased with spaces as underscores."""
    c = table(spark, root, "customer").select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Customer Name"),
        F.col("c_mktsegment").alias("Market Segment"), F.col("c_acctbal").alias("Account Balance"))
    return scalar.clean_names(c)


def n_distinct_all(spark, root):
    """Distinct values of every column (null counted as a value), one pass."""
    return agg.n_distinct_all(table(spark, root, "customer"))


def array_ops(spark, root):
    """Higher-order and collection functions on a per-row numeric array."""
    li = table(spark, root, "lineitem")
    arr = F.array(F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100,
                  F.col("l_linenumber").cast("double"))
    return li.select(
        "l_orderkey", "l_linenumber",
        scalar.round_half_away(C.array_sum(F.transform(arr, lambda x: x * 2)), 6).alias("doubled_sum"),
        F.size(F.filter(arr, lambda x: x > 5)).cast("bigint").alias("n_over_5"),
        F.array_max(arr).alias("arr_max"),
        F.array_contains(arr, 5.0).alias("has_5"),
        F.element_at(F.array_sort(arr), 1).alias("arr_min"),
        F.size(F.array_distinct(arr)).cast("bigint").alias("n_distinct"),
        F.size(F.concat(arr, F.array(F.col("l_linenumber").cast("double")))).cast("bigint").alias("n_concat"),
        F.element_at(arr, -1).alias("last"),
        scalar.round_half_away(C.array_sum(F.slice(arr, 2, 2)), 6).alias("mid_sum"),
        C.squares_sum(F.col("l_linenumber")).cast("bigint").alias("sq_sum"),
    )


def map_ops(spark, root):
    """Map lookups, key tests, defaults, keys and values per row."""
    li = table(spark, root, "lineitem")
    m = F.create_map(F.lit("quantity"), F.col("l_quantity"), F.lit("discount"), F.col("l_discount"),
                     F.lit("tax"), F.col("l_tax"))
    return li.select(
        "l_orderkey", "l_linenumber",
        F.element_at(m, F.lit("tax")).alias("tax"),
        F.map_contains_key(m, F.lit("price")).alias("has_price"),
        C.map_get_or(m, "price", -1.0).alias("price_or_default"),
        F.size(F.map_keys(m)).cast("bigint").alias("n_keys"),
        F.array_join(F.array_sort(F.map_keys(m)), ",").alias("keys_joined"),
        scalar.round_half_away(C.array_sum(F.map_values(m)), 6).alias("value_sum"),
    )


def string_ops(spark, root):
    """Case, trim, translate, replace, reverse, contains, regex capture, format, split."""
    p = table(spark, root, "part")
    words = F.split("p_name", " ")
    return p.select(
        "p_partkey",
        F.upper("p_name").alias("upper_name"),
        F.lower("p_brand").alias("lower_brand"),
        F.trim(F.concat(F.lit("  "), F.col("p_type"), F.lit("  "))).alias("trimmed"),
        F.translate("p_type", "O", "0").alias("type_tr"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit(" # ")).alias("brand_spaced"),
        F.reverse("p_name").alias("name_rev"),
        F.col("p_name").contains("red").alias("has_red"),
        F.regexp_extract("p_brand", r"Brand#([0-9]+)", 1).cast("int").alias("brand_no"),
        F.format_string("%s-%05d", "p_brand", "p_size").alias("label"),
        F.length("p_name").cast("bigint").alias("name_len"),
        F.element_at(words, 1).alias("first_word"),
        F.size(words).cast("bigint").alias("n_words"),
        F.repeat(F.substring("p_type", 1, 3), 2).alias("rep"),
        F.array_join(F.array_sort(words), "|").alias("sorted_words"),
        F.regexp_replace("p_name", "red", "Red").alias("name_cap"),
    )


def list_ops(spark, root):
    """Reversed, appended, set-added, head, tail and characters of word lists; map entries as text."""
    p = table(spark, root, "part")
    w = F.split("p_name", " ")
    m = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    return p.select(
        "p_partkey",
        F.array_join(F.reverse(w), " ").alias("reversed"),
        F.array_join(F.array_append(w, F.lit("new")), " ").alias("appended"),
        F.array_join(F.array_sort(F.array_union(w, F.array(F.lit("red")))), " ").alias("set_added"),
        F.get(w, 0).alias("head"),
        F.array_join(F.slice(w, F.lit(2), F.size(w)), " ").alias("tail"),
        F.array_join(F.split("p_name", ""), "-").alias("characters"),
        F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
        .alias("items"),
        F.format_string("%.2f cm", F.col("p_size") * 2.54).alias("size_text"))


def math_ops(spark, root):
    """sqrt, log2, exp, cos, power, square, cube, reciprocal (1/0 -> null) and a row sum of columns."""
    li = table(spark, root, "lineitem")
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")

    def r9(c, name):
        return scalar.round_half_away(c, 9).alias(name)

    return li.select(
        "l_orderkey", "l_linenumber",
        F.sqrt(q).alias("sqrt_qty"), r9(F.log2(q), "log2_qty"), r9(F.exp(d), "exp_disc"),
        r9(F.cos(t), "cos_tax"), r9(F.pow(d, 2.0), "disc_sq"), (q * q * q).alias("qty_cube"),
        F.try_divide(F.lit(1.0), F.col("l_linenumber") - 1).alias("recip"),
        (q + d + t).alias("row_sum"))


def _ledger_input(spark, root):
    ev = table(spark, root, "events")
    amt = F.when(F.col("event_type").isin(*_WITHDRAWALS), -F.col("value")).otherwise(F.col("value"))
    return ev.select("event_id", "user_id", "ts", amt.alias("amount"))


def replay_ledger(spark, root):
    """Running balance per user (every entry accepted), ordered by (ts, id)."""
    led = windows.replay_ledger(_ledger_input(spark, root), "user_id", ["ts", "event_id"], "amount")
    return led.select("event_id", "user_id", scalar.round_half_away("balance", 6).alias("balance"))


def replay_ledger_min(spark, root):
    """Running balance per user where a withdrawal below the minimum is refused."""
    led = windows.replay_ledger(_ledger_input(spark, root), "user_id", ["ts", "event_id"], "amount",
                                minimum=LEDGER_MIN)
    return led.select("event_id", "user_id", "balance", "accepted")


JOBS = {
    "sessionize": sessionize,
    "pivot_features": pivot_features,
    "win_rate": win_rate,
    "win_rate_long": win_rate_long,
    "clean_names": clean_names,
    "n_distinct_all": n_distinct_all,
    "array_ops": array_ops,
    "map_ops": map_ops,
    "string_ops": string_ops,
    "list_ops": list_ops,
    "math_ops": math_ops,
    "replay_ledger": replay_ledger,
    "replay_ledger_min": replay_ledger_min,
}

_WIN = """SELECT odds_rnd, round(avg(r), 6) AS win_rate,
          CASE WHEN odds_rnd = 0 THEN 'inf'::DOUBLE ELSE round(1.0 / odds_rnd, 6) END AS implied_win_rate
        FROM (SELECT round_even(l_extendedprice / 1000.0, 0) AS odds_rnd,
                     CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS r FROM lineitem)
        GROUP BY odds_rnd"""
_ARR = "[l_quantity, l_discount * 100, l_tax * 100, CAST(l_linenumber AS DOUBLE)]"
_MAP = "MAP(['quantity', 'discount', 'tax'], [l_quantity, l_discount, l_tax])"
_TYPES = ("click", "error", "purchase", "signup", "view")
_W = ", ".join(f"'{w}'" for w in _WITHDRAWALS)

ORACLE = {
    "sessionize": f"""WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, epoch_us(ts) AS t FROM events),
        l AS (SELECT *, lag(t) OVER (PARTITION BY user_id, day ORDER BY t, event_id) AS p FROM e),
        f AS (SELECT *, CASE WHEN p IS NULL OR t - p > {SESSION_GAP_S * 1_000_000} THEN 1 ELSE 0 END
                   AS session_start_flag FROM l)
        SELECT event_id, user_id, day, p AS prev_ts_us, session_start_flag,
          CAST(sum(session_start_flag) OVER (PARTITION BY user_id, day ORDER BY t, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session_no FROM f""",
    "pivot_features": "SELECT user_id, CAST(ts AS DATE) AS day, " + ", ".join(
        f"arg_min(value, (ts, event_id)) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)
        + " FROM events GROUP BY 1, 2",
    "win_rate": _WIN,
    "win_rate_long": f"""WITH w AS ({_WIN})
        SELECT odds_rnd, 'win_rate' AS win_rate_group, win_rate AS value FROM w WHERE odds_rnd < {WIN_RATE_MAX_ODDS}
        UNION ALL
        SELECT odds_rnd, 'implied_win_rate', implied_win_rate FROM w WHERE odds_rnd < {WIN_RATE_MAX_ODDS}""",
    "clean_names": """SELECT c_custkey AS customer_key, c_name AS customer_name,
        c_mktsegment AS market_segment, c_acctbal AS account_balance FROM customer""",
    "n_distinct_all": "SELECT " + ", ".join(
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}"
        for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")) + " FROM customer",
    "array_ops": f"""SELECT l_orderkey, l_linenumber,
        round(list_reduce(list_transform(a, lambda x: x * 2), lambda p, q: p + q), 6) AS doubled_sum,
        len(list_filter(a, lambda x: x > 5)) AS n_over_5,
        list_max(a) AS arr_max, list_contains(a, 5.0) AS has_5, list_sort(a)[1] AS arr_min,
        len(list_distinct(a)) AS n_distinct,
        len(list_concat(a, [CAST(l_linenumber AS DOUBLE)])) AS n_concat, a[-1] AS last,
        round(list_reduce(list_slice(a, 2, 3), lambda p, q: p + q), 6) AS mid_sum,
        CAST(list_sum(list_transform(range(1, l_linenumber + 1), lambda x: x * x)) AS BIGINT) AS sq_sum
        FROM (SELECT l_orderkey, l_linenumber, {_ARR} AS a FROM lineitem)""",
    "map_ops": f"""SELECT l_orderkey, l_linenumber, m['tax'] AS tax,
        list_contains(map_keys(m), 'price') AS has_price,
        coalesce(m['price'], -1.0) AS price_or_default, len(map_keys(m)) AS n_keys,
        array_to_string(list_sort(map_keys(m)), ',') AS keys_joined,
        round(list_reduce(map_values(m), lambda p, q: p + q), 6) AS value_sum
        FROM (SELECT l_orderkey, l_linenumber, {_MAP} AS m FROM lineitem)""",
    "string_ops": """SELECT p_partkey, upper(p_name) AS upper_name, lower(p_brand) AS lower_brand,
        trim('  ' || p_type || '  ') AS trimmed, translate(p_type, 'O', '0') AS type_tr,
        replace(p_brand, '#', ' # ') AS brand_spaced, reverse(p_name) AS name_rev,
        contains(p_name, 'red') AS has_red,
        CAST(regexp_extract(p_brand, 'Brand#([0-9]+)', 1) AS INTEGER) AS brand_no,
        printf('%s-%05d', p_brand, p_size) AS label, length(p_name) AS name_len,
        string_split(p_name, ' ')[1] AS first_word, len(string_split(p_name, ' ')) AS n_words,
        repeat(substr(p_type, 1, 3), 2) AS rep,
        array_to_string(list_sort(string_split(p_name, ' ')), '|') AS sorted_words,
        regexp_replace(p_name, 'red', 'Red', 'g') AS name_cap FROM part""",
    "list_ops": """SELECT p_partkey, array_to_string(list_reverse(w), ' ') AS reversed,
        array_to_string(list_append(w, 'new'), ' ') AS appended,
        array_to_string(list_sort(list_distinct(list_append(w, 'red'))), ' ') AS set_added, w[1] AS head,
        array_to_string(w[2:], ' ') AS tail, array_to_string(regexp_extract_all(p_name, '.'), '-') AS characters,
        'brand=' || p_brand || ';type=' || p_type AS items, printf('%.2f cm', p_size * 2.54) AS size_text
        FROM (SELECT *, string_split(p_name, ' ') AS w FROM part)""",
    "math_ops": """SELECT l_orderkey, l_linenumber, sqrt(l_quantity) AS sqrt_qty,
        round(log2(l_quantity), 9) AS log2_qty, round(exp(l_discount), 9) AS exp_disc,
        round(cos(l_tax), 9) AS cos_tax, round(pow(l_discount, 2.0), 9) AS disc_sq,
        l_quantity * l_quantity * l_quantity AS qty_cube,
        CASE WHEN l_linenumber - 1 = 0 THEN NULL ELSE 1.0 / (l_linenumber - 1) END AS recip,
        l_quantity + l_discount + l_tax AS row_sum FROM lineitem""",
    "replay_ledger_min": f"""WITH RECURSIVE o AS (SELECT event_id, user_id,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n,
            coalesce(CAST(round(CASE WHEN event_type IN ({_W}) THEN -value ELSE value END * 1000000) AS BIGINT), 0) AS a
          FROM events),
        r AS (SELECT event_id, user_id, n, CASE WHEN a >= 0 OR a >= {LEDGER_MIN} * 1000000 THEN a ELSE 0 END AS b,
                     a >= 0 OR a >= {LEDGER_MIN} * 1000000 AS accepted FROM o WHERE n = 1
          UNION ALL
          SELECT o.event_id, o.user_id, o.n,
                 CASE WHEN o.a >= 0 OR r.b + o.a >= {LEDGER_MIN} * 1000000 THEN r.b + o.a ELSE r.b END,
                 o.a >= 0 OR r.b + o.a >= {LEDGER_MIN} * 1000000
          FROM r JOIN o ON o.user_id IS NOT DISTINCT FROM r.user_id AND o.n = r.n + 1)
        SELECT event_id, user_id, b / 1000000.0::DOUBLE AS balance, accepted FROM r""",
    "replay_ledger": f"""SELECT event_id, user_id, round(sum(amount) OVER (PARTITION BY user_id
          ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS balance
        FROM (SELECT event_id, user_id, ts,
                CASE WHEN event_type IN ({_W}) THEN -value ELSE value END AS amount FROM events)""",
}
