"""Reconciliation jobs on stand-in tenancies and transactions.

Stand-in input (rows in the schema the operator expects; the job's work is
all in ``operators.reconcile``):

tenancies <- orders: TenancyID = o_orderkey, OwnerID = o_custkey, PropertyID =
'P' || o_custkey, current owner unless status 'P', occupied = o_orderdate,
vacating = occupied + (o_totalprice mod 730) days, frequency and service from
priority / customer key, rent = o_totalprice / 100, status 'Active' for 'O'.

transactions <- lineitem joined with orders: TenancyID = l_orderkey, OwnerID =
o_custkey (null when l_suppkey mod 13 = 0), PropertyID = 'P' || o_custkey
(|| l_suppkey when l_suppkey mod 5 = 0), Date = l_shipdate, Description from
the return flag, Type 'PLI' for lines 1-2, Net 295 when l_tax < 0.04 else
l_extendedprice / 100, deleted when l_discount >= 0.09.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import reconcile as R
from sparkwright.sources.tables import table

OCC_LO, OCC_HI = "1996-03-01", "1996-04-01"
TXN_LO, TXN_HI = "1996-01-01", "1997-02-01"
MONTHS_LO, MONTHS_HI = "1996-01-01", "1997-02-01"   # thirteen monthly runs in one pass

_FREQ = {"1-URGENT": "Monthly", "2-HIGH": "Three Monthly", "3-MEDIUM": "Six Monthly",
         "4-NOT SPECIFIED": "Annually", "5-LOW": "Weekly"}
_SERVICE = ["Managed", "Rent Collection Only", "Let Only", "Tenant Find"]
_DESC = {"N": "Letting Fee", "R": "Letting fee - renewal"}


def tenancies(spark, root):
    o = table(spark, root, "orders")
    freq = F.lit(None).cast("string")
    for k, v in _FREQ.items():
        freq = F.when(F.col("o_orderpriority") == k, v).otherwise(freq)
    svc = F.element_at(F.array(*[F.lit(s) for s in _SERVICE]),
                       (F.pmod(F.col("o_custkey"), F.lit(4)) + 1).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("TenancyID"), F.col("o_custkey").alias("OwnerID"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("PropertyID"),
        (F.col("o_orderstatus") != "P").alias("blnCurrentOwner"),
        F.col("o_orderdate").cast("timestamp").alias("dteOccupiedDate"),
        F.timestamp_add("DAY", F.pmod(F.floor("o_totalprice"), F.lit(730)).cast("int"),
                        F.col("o_orderdate").cast("timestamp")).alias("dteVacatingDate"),
        freq.alias("strRentalFrequency"), svc.alias("strServiceProvided"),
        (F.col("o_totalprice") / 100.0).alias("dblRentalAmount"),
        F.when(F.col("o_orderstatus") == "O", "Active").otherwise("Ended").alias("Tenancy Status"))


def transactions(spark, root):
    li = table(spark, root, "lineitem")
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    j = li.join(o, "l_orderkey")
    desc = F.lit("Management fee")
    for k, v in _DESC.items():
        desc = F.when(F.col("l_returnflag") == k, v).otherwise(desc)
    prop = F.concat(F.lit("P"), F.col("o_custkey").cast("string"))
    return j.select(
        F.col("l_orderkey").alias("TenancyID"),
        F.when(F.pmod("l_suppkey", F.lit(13)) == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("OwnerID"),
        F.when(F.pmod("l_suppkey", F.lit(5)) == 0, F.concat(prop, F.col("l_suppkey").cast("string")))
         .otherwise(prop).alias("PropertyID"),
        F.col("l_shipdate").cast("timestamp").alias("Date"), desc.alias("Description"),
        F.when(F.col("l_linenumber") <= 2, "PLI").otherwise("PLX").alias("Type"),
        F.when(F.col("l_tax") < 0.04, F.lit(295.0)).otherwise(F.col("l_extendedprice") / 100.0)
         .alias("Net"),
        (F.col("l_discount") >= 0.09).alias("blnDeleted"))


def _frame(spark, root, lo=OCC_LO, hi=OCC_HI):
    return R.reconcile_frame(tenancies(spark, root), transactions(spark, root), lo, hi, TXN_LO, TXN_HI)


def _run(spark, root, lo=OCC_LO, hi=OCC_HI):
    f = _frame(spark, root, lo, hi)
    return f.filter(F.col("Matched")), f.filter(~F.col("Matched"))


def reconcile(spark, root):
    """Matched tenancies of one month with expected fee and error flags."""
    m, _ = _run(spark, root)
    return m.select(F.col("TenancyID").alias("tenancy_id"), F.col("O_ID_B").alias("o_id_b"),
                    F.col("P_ID_B").alias("p_id_b"), F.col("Tenancy Length").alias("tenancy_length"),
                    scalar.round_half_away("Monthly Rent", 6).alias("monthly_rent"), scalar.round_half_away("Cost", 6).alias("cost"),
                    F.col("Net").alias("net"), F.col("Description").alias("description"),
                    F.col("Potential Interest").alias("potential_interest"), F.col("Error").alias("error"))


def reconcile_missing(spark, root):
    """Tenancies of one month without a matching fee (or with an ownerless one)."""
    _, miss = _run(spark, root)
    return miss.select(F.col("TenancyID").alias("tenancy_id"),
                       F.col("strServiceProvided").alias("service"),
                       F.col("dblRentalAmount").alias("rental_amount"), F.col("Tenancy Status").alias("status"))


def reconcile_tables(spark, root):
    """The four report tables of one month in one pass, stacked with their
    table number; each table's own columns are filled, the others are null."""
    rows = R.report_rows(_frame(spark, root))
    t = F.col("table_no")

    def only(col, tables, alias):
        return F.when(t.isin(*tables), col).alias(alias)

    return rows.select(
        "table_no", F.to_date("dteOccupiedDate").alias("occupied"), F.col("TenancyID").alias("tenancy_id"),
        F.col("strServiceProvided").alias("service"),
        only(scalar.round_half_away("Monthly Rent", 6), (1, 2), "monthly_rent"),
        only(F.col("Tenancy Length"), (1, 2), "tenancy_length"),
        only(F.col("Net"), (1, 2), "net"), only(scalar.round_half_away("Cost", 6), (1, 2), "cost"),
        only(F.col("Description"), (2,), "description"),
        only(F.col("dblRentalAmount"), (3, 4), "rental_amount"),
        only(F.col("Tenancy Status"), (3, 4), "status"))


def reconcile_stats(spark, root):
    """total, correct, incorrect, missing for one month."""
    return R.stats(_frame(spark, root))


def reconcile_shares(spark, root):
    """Share of each outcome with cumulative pie-slice angles."""
    s = R.shares(R.stats(_frame(spark, root)))
    return s.select("outcome", "n", scalar.round_half_away("share", 6).alias("share"),
                    scalar.round_half_away("angle_start", 6).alias("angle_start"), scalar.round_half_away("angle_end", 6).alias("angle_end"))


def reconcile_monthly(spark, root):
    """Counts for every month of the period from one join (not one run per month)."""
    f = _frame(spark, root, MONTHS_LO, MONTHS_HI)
    return R.stats(f.withColumn("month", F.date_format("dteOccupiedDate", "yyyy-MM")), "month")


JOBS = {
    "reconcile": reconcile,
    "reconcile_missing": reconcile_missing,
    "reconcile_tables": reconcile_tables,
    "reconcile_stats": reconcile_stats,
    "reconcile_shares": reconcile_shares,
    "reconcile_monthly": reconcile_monthly,
}

_FREQ_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _FREQ.items()) + " END"
_SVC_SQL = "CASE o_custkey % 4 " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_SERVICE)) + " END"
_DESC_SQL = ("CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _DESC.items())
             + " ELSE 'Management fee' END")


def _base(lo, hi):
    return f"""t AS (
      SELECT o_orderkey AS tid, o_custkey AS owner_x, 'P' || CAST(o_custkey AS VARCHAR) AS prop_x,
        o_orderdate AS occ, o_orderdate + to_days(CAST(floor(o_totalprice) AS BIGINT) % 730) AS vac,
        {_FREQ_SQL} AS freq, {_SVC_SQL} AS svc, o_totalprice / 100.0 AS amount,
        CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Ended' END AS status
      FROM orders WHERE o_orderdate >= TIMESTAMP '{lo}' AND o_orderdate < TIMESTAMP '{hi}'
        AND o_orderstatus <> 'P'),
    x AS (
      SELECT l_orderkey AS tid, CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE o_custkey END AS owner_y,
        CASE WHEN l_suppkey % 5 = 0 THEN 'P' || CAST(o_custkey AS VARCHAR) || CAST(l_suppkey AS VARCHAR)
             ELSE 'P' || CAST(o_custkey AS VARCHAR) END AS prop_y,
        lower({_DESC_SQL}) AS descr,
        CASE WHEN l_tax < 0.04 THEN 295.0 ELSE l_extendedprice / 100.0 END AS net
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      WHERE l_shipdate >= TIMESTAMP '{TXN_LO}' AND l_shipdate < TIMESTAMP '{TXN_HI}'
        AND l_discount < 0.09 AND l_linenumber <= 2 AND contains(lower({_DESC_SQL}), 'letting')),
    j AS (SELECT t.*, x.owner_y, x.prop_y, x.descr, x.net FROM t LEFT JOIN x USING (tid)),
    m AS (
      SELECT *, round_even((epoch_us(vac) - epoch_us(occ)) / 1e6 / 86400.0 / 30.436875, 0) AS len,
        CASE freq WHEN 'Monthly' THEN amount / 1.0 WHEN 'Three Monthly' THEN amount / 3.0
                  WHEN 'Six Monthly' THEN amount / 6.0 WHEN 'Annually' THEN amount / 12.0 END AS rent
      FROM j WHERE owner_y IS NOT NULL),
    e AS (
      SELECT *, CASE WHEN svc = 'Let Only' AND len >= 12.0 THEN greatest(amount * 0.75, 500.0)
                     WHEN svc = 'Let Only' AND len <= 11.0 THEN greatest(amount * 0.5, 350.0)
                     WHEN svc IN ('Managed', 'Rent Collection Only') THEN 295.0 END AS cost
      FROM m),
    f AS (SELECT *, CASE WHEN descr = 'letting fee' THEN 0 ELSE 1 END AS pi,
                    CASE WHEN cost = net THEN 0 ELSE 1 END AS err FROM e),
    miss AS (SELECT * FROM j WHERE owner_y IS NULL)"""


_STATS = """SELECT {by} count(*) AS total, CAST(sum(CASE WHEN e = 0 THEN 1 ELSE 0 END) AS BIGINT) AS correct,
      CAST(sum(CASE WHEN e = 1 THEN 1 ELSE 0 END) AS BIGINT) AS incorrect,
      CAST(sum(CASE WHEN e IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing
    FROM (SELECT {sel} err AS e FROM f UNION ALL SELECT {sel} NULL FROM miss) {group}"""

ORACLE = {
    "reconcile": f"""WITH {_base(OCC_LO, OCC_HI)}
        SELECT replace(CAST(tid AS VARCHAR), '-', ' - ') AS tenancy_id,
          CASE WHEN owner_x = owner_y THEN 1 ELSE 0 END AS o_id_b,
          CASE WHEN prop_x = prop_y THEN 1 ELSE 0 END AS p_id_b, len AS tenancy_length,
          round(rent, 6) AS monthly_rent, round(cost, 6) AS cost, net, descr AS description,
          pi AS potential_interest, err AS error FROM f""",
    "reconcile_missing": f"""WITH {_base(OCC_LO, OCC_HI)}
        SELECT replace(CAST(tid AS VARCHAR), '-', ' - ') AS tenancy_id, svc AS service,
          amount AS rental_amount, status FROM miss""",
    "reconcile_tables": f"""WITH {_base(OCC_LO, OCC_HI)},
        rows AS (
          SELECT CASE WHEN pi = 0 THEN 1 ELSE 2 END AS table_no, occ, tid, svc, rent, len, net, cost, descr,
                 NULL::DOUBLE AS amount, NULL::VARCHAR AS status FROM f WHERE err = 1
          UNION ALL
          SELECT CASE WHEN status = 'Active' THEN 3 ELSE 4 END, occ, tid, svc, NULL, NULL, NULL, NULL, NULL,
                 amount, status FROM miss)
        SELECT table_no, CAST(occ AS DATE) AS occupied, replace(CAST(tid AS VARCHAR), '-', ' - ') AS tenancy_id,
          svc AS service,
          CASE WHEN table_no IN (1, 2) THEN round(rent, 6) END AS monthly_rent,
          CASE WHEN table_no IN (1, 2) THEN len END AS tenancy_length,
          CASE WHEN table_no IN (1, 2) THEN net END AS net,
          CASE WHEN table_no IN (1, 2) THEN round(cost, 6) END AS cost,
          CASE WHEN table_no = 2 THEN descr END AS description,
          CASE WHEN table_no IN (3, 4) THEN amount END AS rental_amount,
          CASE WHEN table_no IN (3, 4) THEN status END AS status FROM rows""",
    "reconcile_stats": f"WITH {_base(OCC_LO, OCC_HI)} " + _STATS.format(by="", sel="", group=""),
    "reconcile_shares": f"""WITH {_base(OCC_LO, OCC_HI)},
        s AS ({_STATS.format(by="", sel="", group="")}),
        l AS (SELECT 'correct' AS outcome, correct AS n, 0 AS o FROM s
              UNION ALL SELECT 'incorrect', incorrect, 1 FROM s UNION ALL SELECT 'missing', missing, 2 FROM s),
        sh AS (SELECT outcome, n, o, 100.0 * n / sum(n) OVER () AS share FROM l),
        c AS (SELECT *, sum(share) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / 100.0
                        * 2.0 * 3.141592653589793 AS ae FROM sh)
        SELECT outcome, n, round(share, 6) AS share,
          round(ae - share / 100.0 * 2.0 * 3.141592653589793, 6) AS angle_start, round(ae, 6) AS angle_end FROM c""",
    "reconcile_monthly": f"WITH {_base(MONTHS_LO, MONTHS_HI)} " + _STATS.format(
        by="month,", sel="strftime(occ, '%Y-%m') AS month,", group="GROUP BY month"),
}
