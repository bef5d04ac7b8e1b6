"""Fee reconciliation of tenancies against ledger transactions
(F5, F6, F8, F10, J2, J6, J7, H7, H20, H23, H25, H26, A14, A15, W5, U4, K4).

Inputs use the column names of the original tables:

tenancies:    TenancyID, OwnerID, PropertyID, blnCurrentOwner, dteOccupiedDate,
              dteVacatingDate, strRentalFrequency, strServiceProvided,
              dblRentalAmount, `Tenancy Status`
transactions: TenancyID, OwnerID, PropertyID, Date, Description, Type, Net, blnDeleted

One lazy plan: both outputs (matched, missing) come from the same joined frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.functions import scalar
from sparkwright.operators import agg, joins

# Fixed values --------------------------------------------------------------
# Rent divisor per rental frequency (anything else: no monthly rent).
RENT_DIVISOR = {"Monthly": 1.0, "Three Monthly": 3.0, "Six Monthly": 6.0, "Annually": 12.0}
# Flat fee per service; 'Let Only' depends on the tenancy length.
FLAT_FEE = {"Managed": 295.0, "Rent Collection Only": 295.0}
LET_ONLY = "Let Only"
LET_SHORT_MAX_MONTHS, LET_SHORT_RATE, LET_SHORT_FLOOR = 11.0, 0.50, 350.0
LET_LONG_MIN_MONTHS, LET_LONG_RATE, LET_LONG_FLOOR = 12.0, 0.75, 500.0
STANDARD_DESCRIPTION = "letting fee"
TEXT_FILTER, TYPE_FILTER = "letting", "PLI"
ACTIVE = "Active"
# ---------------------------------------------------------------------------


def monthly_rent(freq, amount):
    """Rent per month from the rental frequency."""
    out = F.lit(None).cast("double")
    for k, d in RENT_DIVISOR.items():
        out = F.when(freq == k, amount / d).otherwise(out)
    return out


def expected_fee(service, length, amount):
    """Fee the service should have cost (H26); null when no rule applies."""
    out = F.lit(None).cast("double")
    for k, v in FLAT_FEE.items():
        out = F.when(service == k, F.lit(v)).otherwise(out)
    short = scalar.greatest_strict(amount * LET_SHORT_RATE, LET_SHORT_FLOOR)
    long_ = scalar.greatest_strict(amount * LET_LONG_RATE, LET_LONG_FLOOR)
    out = F.when((service == LET_ONLY) & (length <= LET_SHORT_MAX_MONTHS), short).otherwise(out)
    out = F.when((service == LET_ONLY) & (length >= LET_LONG_MIN_MONTHS), long_).otherwise(out)
    return out


def prepare(tenancies: DataFrame, transactions: DataFrame, occ_lo, occ_hi, txn_lo, txn_hi) -> DataFrame:
    """Filter both sides (ranges pushed to the scans), left-join, flag.

    Returns the joined frame with ``_x``/``_y`` suffixes for shared columns,
    the agreement flags O_ID_B / P_ID_B and the normalised TenancyID.
    """
    t = tenancies.filter((F.col("dteOccupiedDate") >= F.lit(occ_lo).cast("timestamp"))
                         & (F.col("dteOccupiedDate") < F.lit(occ_hi).cast("timestamp")))
    t = scalar.exclude_where(t, F.col("blnCurrentOwner") == F.lit(False))
    x = transactions.filter((F.col("Date") >= F.lit(txn_lo).cast("timestamp"))
                            & (F.col("Date") < F.lit(txn_hi).cast("timestamp")))
    x = scalar.exclude_where(x, F.col("blnDeleted") == F.lit(True))
    x = x.withColumn("Description", F.lower("Description"))
    x = x.filter(F.col("Description").contains(TEXT_FILTER) & (F.col("Type") == TYPE_FILTER))
    m = joins.left_join_suffixed(t, x, "TenancyID")
    return (m.withColumn("TenancyID", F.replace(F.col("TenancyID").cast("string"), F.lit("-"), F.lit(" - ")))
             .withColumn("O_ID_B", joins.agree_flag(F.col("OwnerID_x"), F.col("OwnerID_y")))
             .withColumn("P_ID_B", joins.agree_flag(F.col("PropertyID_x"), F.col("PropertyID_y"))))


def evaluate(joined: DataFrame) -> DataFrame:
    """Add ``Matched`` (the right owner is not null), tenancy length, monthly
    rent, expected cost, interest and error flags.

    The flags are meaningful for matched rows; missing rows keep them null.
    """
    matched = F.col("OwnerID_y").isNotNull()
    length = scalar.months_between_whole("dteOccupiedDate", "dteVacatingDate")
    m = joined.withColumn("Matched", matched)
    m = m.withColumn("Tenancy Length", F.when(matched, length))
    m = m.withColumn("Monthly Rent", F.when(matched, monthly_rent(F.col("strRentalFrequency"),
                                                                  F.col("dblRentalAmount"))))
    m = m.withColumn("Cost", F.when(matched, expected_fee(F.col("strServiceProvided"),
                                                          F.col("Tenancy Length"), F.col("dblRentalAmount"))))
    # null description or cost counts as "different" (pandas NaN comparisons)
    m = m.withColumn("Potential Interest", F.when(matched, F.when(
        F.col("Description") == STANDARD_DESCRIPTION, 0).otherwise(1)))
    return m.withColumn("Error", F.when(matched, F.when(F.col("Cost") == F.col("Net"), 0).otherwise(1)))


def reconcile_frame(tenancies, transactions, occ_lo, occ_hi, txn_lo, txn_hi) -> DataFrame:
    """One evaluated frame holding matched and missing rows (``Matched`` flag)."""
    return evaluate(prepare(tenancies, transactions, occ_lo, occ_hi, txn_lo, txn_hi))


def reconcile(tenancies, transactions, occ_lo, occ_hi, txn_lo, txn_hi) -> tuple[DataFrame, DataFrame]:
    """(matched-and-evaluated, missing) frames of one run (J6 split of one frame)."""
    f = reconcile_frame(tenancies, transactions, occ_lo, occ_hi, txn_lo, txn_hi)
    return f.filter(F.col("Matched")), f.filter(~F.col("Matched"))


_TABLE_COLS = {
    "fee_errors": ["dteOccupiedDate", "TenancyID", "strServiceProvided", "Monthly Rent", "Tenancy Length",
                   "Net", "Cost"],
    "other_errors": ["dteOccupiedDate", "TenancyID", "strServiceProvided", "Monthly Rent", "Tenancy Length",
                     "Net", "Cost", "Description"],
    "missing_active": ["dteOccupiedDate", "TenancyID", "strServiceProvided", "dblRentalAmount", "Tenancy Status"],
    "missing_other": ["dteOccupiedDate", "TenancyID", "strServiceProvided", "dblRentalAmount", "Tenancy Status"],
}


def table_number():
    """Report table of each row (K4): 1 fee errors, 2 other errors, 3 missing
    and active, 4 missing and not active (null status counts as not active)."""
    matched, err, pi = F.col("Matched"), F.col("Error") == 1, F.col("Potential Interest")
    return (F.when(matched & err & (pi == 0), 1).when(matched & err & (pi == 1), 2)
             .when(~matched & (F.col("Tenancy Status") == ACTIVE), 3)
             .when(~matched & scalar.not_equal_null_safe(F.col("Tenancy Status"), F.lit(ACTIVE)), 4))


def report_rows(frame: DataFrame) -> DataFrame:
    """All four report tables in one pass: rows with their ``table_no``."""
    return frame.withColumn("table_no", table_number()).filter(F.col("table_no").isNotNull())


def report_tables(frame: DataFrame) -> dict[str, DataFrame]:
    """The four report tables (K4) as separate frames with their own columns."""
    rows = report_rows(frame)
    return {name: rows.filter(F.col("table_no") == i).select(*cols)
            for i, (name, cols) in enumerate(_TABLE_COLS.items(), 1)}


def stats(frame: DataFrame, by=None) -> DataFrame:
    """total / correct / incorrect / missing counts (A14), optionally per ``by`` (U4); one pass."""
    by = [] if by is None else ([by] if isinstance(by, str) else list(by))
    g = frame.groupBy(*by) if by else frame.groupBy()
    m = F.col("Matched")
    return g.agg(F.count(F.lit(1)).alias("total"),
                 agg.count_if(m & (F.col("Error") == 0)).alias("correct"),
                 agg.count_if(m & (F.col("Error") == 1)).alias("incorrect"),
                 agg.count_if(~m).alias("missing"))


def shares(stats_row: DataFrame) -> DataFrame:
    """Percentage share of each outcome with pie-slice bounds."""
    long = stats_row.select(F.lit(1).alias("_one"), "correct", "incorrect", "missing").unpivot(
        ["_one"], ["correct", "incorrect", "missing"], "outcome", "n").drop("_one")
    order = F.when(F.col("outcome") == "correct", 0).when(F.col("outcome") == "incorrect", 1).otherwise(2)
    s = agg.share(long.withColumn("_o", order), "n", "share")
    return agg.cumulative_share(s, ["_o"], "share").drop("_o")
