import datetime as dt

from pyspark.sql import functions as F

from dwkit.operators.scd import current, scd1_merge, scd2_classify, scd2_merge, with_default_member

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1)


def _batch(spark, rows):
    return spark.createDataFrame(rows, "carrier_code string, carrier_name string")


def test_scd2_first_load_rerun_change_and_missing(spark):
    b1 = _batch(spark, [("AA", "American"), ("NK", "Spirit"), ("ZZ", None)])
    d1 = scd2_merge(None, b1, "carrier_code", ["carrier_name"], "airline_key", T1)
    assert d1.count() == 3
    assert scd2_merge(d1, b1, "carrier_code", ["carrier_name"], "airline_key", T2).count() == 3   # re-run: no-op
    b2 = _batch(spark, [("NK", "Spirit (Ch. 11)"), ("ZZ", None), ("B6", "JetBlue")])              # AA missing
    d2 = scd2_merge(d1, b2, "carrier_code", ["carrier_name"], "airline_key", T2)
    rows = {(r.carrier_code, r.carrier_name): r for r in d2.collect()}
    assert len(rows) == 5
    old, new = rows[("NK", "Spirit")], rows[("NK", "Spirit (Ch. 11)")]
    assert not old.is_current_record and old.scd_expiry_date == T2
    assert new.is_current_record and new.scd_effective_date == T2 and new.airline_key == 5
    assert rows[("B6", "JetBlue")].scd_effective_date == dt.datetime(1900, 1, 1)   # never-seen key
    assert rows[("AA", "American")].is_current_record                              # missing key untouched
    assert rows[("ZZ", None)].is_current_record                                    # null compares equal
    # one current row per key; versions of a key do not overlap
    assert current(d2).groupBy("carrier_code").count().where(F.col("count") > 1).count() == 0
    assert sorted(r.airline_key for r in d2.collect()) == [1, 2, 3, 4, 5]


def test_scd2_classify(spark):
    d1 = scd2_merge(None, _batch(spark, [("AA", "A"), ("NK", "N")]), "carrier_code", ["carrier_name"],
                    "airline_key", T1)
    got = {r.carrier_code: r.scd_status for r in scd2_classify(
        d1, _batch(spark, [("AA", "A"), ("NK", "N2"), ("B6", "B")]), "carrier_code", ["carrier_name"]).collect()}
    assert got == {"AA": "unchanged", "NK": "changed", "B6": "new"}


def test_scd1_upsert_and_default_member(spark):
    inc = spark.createDataFrame([("JFK", "New York"), ("LAX", "LA")], "code string, city string")
    d1 = scd1_merge(None, inc, "code", ["city"], "sk")
    d2 = scd1_merge(d1, spark.createDataFrame([("LAX", "Los Angeles"), ("ORD", "Chicago")],
                                              "code string, city string"), "code", ["city"], "sk")
    got = {r.code: (r.sk, r.city) for r in d2.collect()}
    assert got == {"JFK": (1, "New York"), "LAX": (2, "Los Angeles"), "ORD": (3, "Chicago")}
    assert scd1_merge(d2, d2.select("code", "city"), "code", ["city"], "sk").count() == 3
    dm = with_default_member(d2, {"sk": 0, "code": "N/A", "city": "N/A"})
    assert dm.count() == 4 and with_default_member(dm, {"sk": 0, "code": "N/A", "city": "N/A"}).count() == 4


def test_reason_sheet_merge_keeps_default_member(spark):
    from dwkit.operators.dims import reason_dim
    sheet = spark.createDataFrame([("B", "Weather (updated)", "External", "No"), ("E", "New reason", "X", "Y")],
                                  "cancellation_code string, reason_description string, responsible_party string, "
                                  "compensation_eligibility string")
    d = {r.cancellation_code: r for r in reason_dim(spark, incoming=sheet).collect()}
    assert d["N/A"].cancellation_key == 0 and d["B"].cancellation_key == 2
    assert d["B"].reason_description == "Weather (updated)" and d["E"].cancellation_key == 5
    assert len(d) == 6


def test_calendar_only_if_missing(spark):
    from dwkit.operators.dims import add_missing_dates, date_dim
    have = date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    want = date_dim(spark, dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    out = add_missing_dates(have, want)
    assert out.count() == 20 and out.select("date_key").distinct().count() == 20


def test_reason_sheet_length_limits(spark):
    import pytest
    from dwkit.operators.dims import reason_dim
    sheet = spark.createDataFrame([("ABCD", "x", "y", "z")], "cancellation_code string, reason_description string, "
                                  "responsible_party string, compensation_eligibility string")
    with pytest.raises(Exception):
        reason_dim(spark, incoming=sheet).collect()
