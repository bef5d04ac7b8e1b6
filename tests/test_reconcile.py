import datetime as dt

from sparkwright.operators import reconcile as R

T_SCHEMA = ("TenancyID string, OwnerID long, PropertyID string, blnCurrentOwner boolean, "
            "dteOccupiedDate timestamp, dteVacatingDate timestamp, strRentalFrequency string, "
            "strServiceProvided string, dblRentalAmount double, `Tenancy Status` string")
X_SCHEMA = ("TenancyID string, OwnerID long, PropertyID string, Date timestamp, Description string, "
            "Type string, Net double, blnDeleted boolean")


def _d(y, m, d):
    return dt.datetime(y, m, d)


def test_rules_and_split(spark):
    occ = _d(2017, 11, 5)
    ten = [
        ("A-1", 1, "p1", True, occ, occ + dt.timedelta(days=335), "Monthly", "Let Only", 1000.0, "Active"),   # 11 months
        ("A-2", 2, "p2", None, occ, occ + dt.timedelta(days=366), "Annually", "Let Only", 400.0, "Active"),   # 12 months
        ("A-3", 3, "p3", True, occ, None, "Three Monthly", "Let Only", 900.0, "Ended"),                        # no length
        ("A-4", 4, "p4", True, occ, occ, "Weekly", "Managed", 10.0, None),                                      # fee ok
        ("A-5", 5, "p5", True, occ, occ, "Monthly", "Managed", 10.0, "Active"),                                 # owner null
        ("A-6", 6, "p6", False, occ, occ, "Monthly", "Managed", 10.0, "Active"),                                # not current
        ("A-7", 7, "p7", True, occ, occ, "Monthly", "Managed", 10.0, None),                                     # no txn
        ("A-8", 8, "p8", True, _d(2017, 12, 1), occ, "Monthly", "Managed", 10.0, "Active"),                     # other month
    ]
    txd = _d(2017, 6, 1)
    txn = [
        ("A-1", 1, "p1", txd, "Letting Fee", "PLI", 500.0, False),
        ("A-2", 2, "px", txd, "LETTING fee", "PLI", 500.0, None),
        ("A-3", 3, "p3", txd, "letting fee extra", "PLI", 1.0, False),
        ("A-4", 4, "p4", txd, "letting fee", "PLI", 295.0, False),
        ("A-5", None, "p5", txd, "letting fee", "PLI", 295.0, False),
        ("A-7", 7, "p7", txd, "letting fee", "PLI", 295.0, True),          # deleted
        ("A-7", 7, "p7", txd, "letting fee", "ABC", 295.0, False),         # wrong type
        ("A-7", 7, "p7", _d(2019, 1, 1), "letting fee", "PLI", 295.0, False),  # outside window
    ]
    t = spark.createDataFrame(ten, T_SCHEMA)
    x = spark.createDataFrame(txn, X_SCHEMA)
    frame = R.reconcile_frame(t, x, "2017-11-01", "2017-12-01", "2017-01-01", "2018-02-01")
    m, miss = R.reconcile(t, x, "2017-11-01", "2017-12-01", "2017-01-01", "2018-02-01")
    got = {r["TenancyID"]: (r["Tenancy Length"], r["Cost"], r["Error"], r["Potential Interest"],
                            r["O_ID_B"], r["P_ID_B"], r["Monthly Rent"]) for r in m.collect()}
    assert got == {
        "A - 1": (11.0, 500.0, 0, 0, 1, 1, 1000.0),
        "A - 2": (12.0, 500.0, 0, 0, 1, 0, 400.0 / 12),
        "A - 3": (None, None, 1, 1, 1, 1, 300.0),
        "A - 4": (0.0, 295.0, 0, 0, 1, 1, None),
    }
    assert sorted(r["TenancyID"] for r in miss.collect()) == ["A - 5", "A - 7"]
    tables = R.report_tables(frame)
    assert [r["TenancyID"] for r in tables["other_errors"].collect()] == ["A - 3"]
    assert tables["fee_errors"].count() == 0
    assert [r["TenancyID"] for r in tables["missing_active"].collect()] == ["A - 5"]
    assert [r["TenancyID"] for r in tables["missing_other"].collect()] == ["A - 7"]
    s = R.stats(frame).collect()[0]
    assert (s["total"], s["correct"], s["incorrect"], s["missing"]) == (6, 3, 1, 2)
    assert s["total"] == s["correct"] + s["incorrect"] + s["missing"]
    sh = {r["outcome"]: r for r in R.shares(R.stats(frame)).collect()}
    assert abs(sum(r["share"] for r in sh.values()) - 100.0) < 1e-9
    assert abs(sh["missing"]["angle_end"] - 2 * 3.141592653589793) < 1e-9
