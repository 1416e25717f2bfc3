import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from dwkit.operators.quality import reconcile
from dwkit.plans.pipeline import run
from dwkit.sources import (FLAT_SCHEMA, COMPLETION_SCHEMA, append, convert_types, latest_version, read_csv,
                           read_table, refresh, us_region_reference, write_csv, write_version)

HEADER = [f.name for f in FLAT_SCHEMA.fields]


def _row(**kw):
    base = dict(year=2024, month=1, day_of_month=1, day_of_week=2, fl_date="2024-01-01", op_unique_carrier="AA",
                op_carrier_fl_num=100, origin="JFK", origin_city_name="New York, NY", origin_state_nm="New York",
                dest="LAX", dest_city_name="Los Angeles, CA", dest_state_nm="California", crs_dep_time=900,
                dep_time=905.0, dep_delay=5.0, taxi_out=10.0, wheels_off=915.0, wheels_on=1200.0, taxi_in=5.0,
                crs_arr_time=1210, arr_time=1205.0, arr_delay=-5.0, cancelled=0, cancellation_code="",
                diverted=0, crs_elapsed_time=370.0, actual_elapsed_time=360.0, air_time=345.0, distance=2475.0,
                carrier_delay=0, weather_delay=0, nas_delay=0, security_delay=0, late_aircraft_delay=0)
    base.update(kw)
    return ",".join('"%s"' % v if isinstance(v, str) and "," in v else str(v) for v in (base[h] for h in HEADER))


def test_pipeline_from_flat_csv(spark):
    d = tempfile.mkdtemp(prefix="dwkit-pipe-", dir="/tmp")
    rows = [_row(), _row(fl_date="2024-01-02", day_of_month=2, arr_delay=30.0, carrier_delay=30),
            _row(fl_date="2024-01-02", day_of_month=2, cancelled=1, cancellation_code="B  ", dep_time="",
                 arr_delay=""),
            _row(op_unique_carrier="NK", op_carrier_fl_num=7, origin="SJU", origin_city_name="San Juan, PR",
                 origin_state_nm="Atlantis", cancelled=1, cancellation_code="")]
    with open(os.path.join(d, "flat.csv"), "w") as fh:
        fh.write(",".join(HEADER) + "\n" + "\n".join(rows) + "\n")
    with open(os.path.join(d, "feed.csv"), "w") as fh:
        fh.write("operation_id,accm_txn_complete_time\n1,2024-01-01 12:00:59\n1,2024-01-03 00:00:00\n77,2024-01-05 00:00:00\n")
    flat = read_csv(spark, os.path.join(d, "flat.csv"), FLAT_SCHEMA, date_format="yyyy-MM-dd")
    feed = read_csv(spark, os.path.join(d, "feed.csv"), COMPLETION_SCHEMA, timestamp_format="yyyy-MM-dd HH:mm:ss")
    w = run(spark, flat, feed, us_region_reference(spark), os.path.join(d, "dw"), dt.datetime(2025, 1, 1))
    r = reconcile(w["prepared"], w["fact_loaded"], w["fact_errors"]).first()
    assert r.balanced and r.source_rows == 4
    assert r.rejected_rows == 1                 # SJU's state has no region -> airport quarantined -> fact reject
    assert w["airport_errors"].count() == 1
    reasons = {x.operation_id: x.cancellation_key for x in w["fact"].collect()}
    codes = {x.operation_id: x.cancellation_code_clean for x in w["prepared"].collect()}
    assert sorted(codes.values()) == ["A", "B", "N/A", "N/A"]    # padded 'B  ' cleaned, blank -> 'A'
    assert sorted(reasons.values()) == [0, 0, 2]
    assert w["accum_errors"].count() == 1
    assert w["delay_record"].count() == 1
    flights = w["flight"].count()
    assert flights == 2


def test_csv_round_trip_versioning_and_conversion(spark):
    d = tempfile.mkdtemp(prefix="dwkit-src-", dir="/tmp")
    df = spark.createDataFrame([(1, "abc"), (2, "toolong")], "id int, s string")
    write_csv(df, os.path.join(d, "csv"))
    back = read_csv(spark, os.path.join(d, "csv"), "id int, s string", columns=["s"])
    assert sorted(r.s for r in back.collect()) == ["abc", "toolong"]
    with pytest.raises(Exception):
        convert_types(df, {"s": ("string", 3)}).collect()
    assert convert_types(df.where("id = 1"), {"s": ("string", 3)}).count() == 1
    base = os.path.join(d, "table")
    assert latest_version(base) is None
    v1 = write_version(df, base)
    v2 = write_version(df.where("id = 1"), base)
    assert latest_version(base) == v2 and v1 != v2
    assert read_table(spark, base).count() == 1
    refresh(df, os.path.join(d, "stg"))
    refresh(df.where("id = 2"), os.path.join(d, "stg"))
    append(df, os.path.join(d, "stg"))
    assert spark.read.parquet(os.path.join(d, "stg")).count() == 3


def test_write_routed_and_assert_unique(spark):
    from dwkit.operators.quality import assert_unique
    from dwkit.sources import read_branch, write_routed
    d = tempfile.mkdtemp(prefix="dwkit-route-", dir="/tmp")
    df = spark.range(10).withColumn("ok", F.col("id") % 3 != 0)
    write_routed(df, "ok", os.path.join(d, "routed"))
    ok = read_branch(spark, os.path.join(d, "routed"), "ok", True)
    bad = read_branch(spark, os.path.join(d, "routed"), "ok", False)
    assert ok.count() == 6 and bad.count() == 4
    assert "PartitionFilters: [isnotnull(ok" in ok._jdf.queryExecution().executedPlan().toString()
    assert_unique(df, ["id"])
    with pytest.raises(AssertionError):
        assert_unique(df.union(df.limit(1)), ["id"])


def test_incremental_load_scd2_and_stable_ids(spark):
    from dwkit.plans.pipeline import run_increment
    d = tempfile.mkdtemp(prefix="dwkit-inc-", dir="/tmp")
    names1 = spark.createDataFrame([("AA", "American"), ("NK", "Spirit")], "carrier_code string, carrier_name string")
    names2 = spark.createDataFrame([("AA", "American Airlines"), ("NK", "Spirit")],
                                   "carrier_code string, carrier_name string")

    def load(rows, name):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(",".join(HEADER) + "\n" + "\n".join(rows) + "\n")
        return read_csv(spark, os.path.join(d, name), FLAT_SCHEMA, date_format="yyyy-MM-dd")

    first = load([_row(), _row(fl_date="2024-01-02", day_of_month=2, arr_delay=30.0, carrier_delay=30),
                  _row(op_unique_carrier="NK", op_carrier_fl_num=7)], "b1.csv")
    w1 = run(spark, first, None, us_region_reference(spark), os.path.join(d, "w1"), dt.datetime(2024, 1, 5),
             carrier_names=names1)
    second = load([_row(fl_date="2024-02-01", day_of_month=1, month=2),
                   _row(op_carrier_fl_num=200, dest="ORD", dest_city_name="Chicago, IL", dest_state_nm="Illinois",
                        fl_date="2024-02-02", day_of_month=2, month=2)], "b2.csv")
    w2 = run_increment(spark, w1, second, us_region_reference(spark), os.path.join(d, "w2"),
                       dt.datetime(2024, 2, 1), carrier_names=names2)
    air = {(r.carrier_code, r.carrier_name): r for r in w2["dim_airline"].collect()}
    assert len(air) == 3 and not air[("AA", "American")].is_current_record
    assert air[("AA", "American Airlines")].scd_expiry_date == dt.datetime(9999, 12, 31)
    f1 = {(r.carrier_code, r.flight_number, r.dest_code): r.flight_id for r in w1["flight"].collect()}
    f2 = {(r.carrier_code, r.flight_number, r.dest_code): r.flight_id for r in w2["flight"].collect()}
    assert all(f2[k] == v for k, v in f1.items()) and f2[("AA", 200, "ORD")] == max(f1.values()) + 1
    fact = w2["fact_loaded"].collect()
    assert sorted(r.operation_key for r in fact) == [1, 2, 3, 4, 5]
    assert sorted(r.operation_id for r in fact) == [1, 2, 3, 4, 5]
    new_aa = {r.airline_key for r in fact if r.operation_id >= 4}
    assert new_aa == {air[("AA", "American Airlines")].airline_key}
    assert w2["dim_date"].count() == 4           # each batch's date range: Jan 1-2, then Feb 1-2 added


def test_pipeline_cli(spark, capsys):
    from dwkit.plans.pipeline import main
    d = tempfile.mkdtemp(prefix="dwkit-cli-", dir="/tmp")
    with open(os.path.join(d, "flat.csv"), "w") as fh:
        fh.write(",".join(HEADER) + "\n" + "\n".join([_row(), _row(op_unique_carrier="B6")]) + "\n")
    main(["--flat", os.path.join(d, "flat.csv"), "--out", os.path.join(d, "dw")])
    out = capsys.readouterr().out
    assert "fact_loaded 2" in out and "dim_airline 2" in out


def test_pipeline_rerun_reuses_complete_tables(spark):
    d = tempfile.mkdtemp(prefix="dwkit-rerun-", dir="/tmp")
    with open(os.path.join(d, "flat.csv"), "w") as fh:
        fh.write(",".join(HEADER) + "\n" + "\n".join([_row(), _row(op_unique_carrier="B6")]) + "\n")
    flat = read_csv(spark, os.path.join(d, "flat.csv"), FLAT_SCHEMA, date_format="yyyy-MM-dd")
    w1 = run(spark, flat, None, us_region_reference(spark), os.path.join(d, "dw"), dt.datetime(2025, 1, 1))
    files_before = sorted(w1["fact_loaded"].inputFiles())
    w2 = run(spark, flat, None, us_region_reference(spark), os.path.join(d, "dw"), dt.datetime(2025, 1, 1))
    assert sorted(w2["fact_loaded"].inputFiles()) == files_before and w2["fact_loaded"].count() == 2


def test_other_input_loads_anew_and_increments_keep_completions(spark):
    from dwkit.operators.quality import reconcile
    from dwkit.plans.pipeline import run_increment
    d = tempfile.mkdtemp(prefix="dwkit-again-", dir="/tmp")

    def load(rows, name):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(",".join(HEADER) + "\n" + "\n".join(rows) + "\n")
        return read_csv(spark, os.path.join(d, name), FLAT_SCHEMA, date_format="yyyy-MM-dd")

    regions, ts = us_region_reference(spark), dt.datetime(2025, 1, 1)
    one = load([_row(), _row(op_unique_carrier="B6")], "one.csv")
    two = load([_row(op_carrier_fl_num=n) for n in range(300, 305)], "two.csv")
    assert run(spark, one, None, regions, os.path.join(d, "dw"), ts)["fact_loaded"].count() == 2
    assert run(spark, two, None, regions, os.path.join(d, "dw"), ts)["fact_loaded"].count() == 5
    feed = spark.createDataFrame([(1, dt.datetime(2024, 1, 3)), (2, dt.datetime(2024, 1, 4))],
                                 "operation_id long, accm_txn_complete_time timestamp_ntz")
    w1 = run(spark, one, feed, regions, os.path.join(d, "dw2"), ts)
    w2 = run_increment(spark, w1, two, regions, os.path.join(d, "dw3"), ts)
    done = {r.operation_id for r in w2["fact"].where("accm_txn_complete_time IS NOT NULL").collect()}
    assert done == {1, 2} and w2["fact"].count() == 7
    r = reconcile(w2["flat"], w2["fact_loaded"], w2["fact_errors"]).first()
    assert r.source_rows == 7 and r.balanced
    again = run_increment(spark, w1, two, regions, os.path.join(d, "dw3"), ts)
    assert sorted(again["fact_segment"].inputFiles()) == sorted(w2["fact_segment"].inputFiles())


def test_cli_takes_carrier_names(spark, capsys):
    from dwkit.plans.pipeline import main
    d = tempfile.mkdtemp(prefix="dwkit-names-", dir="/tmp")
    with open(os.path.join(d, "flat.csv"), "w") as fh:
        fh.write(",".join(HEADER) + "\n" + "\n".join([_row(), _row(op_unique_carrier="B6")]) + "\n")
    with open(os.path.join(d, "names.csv"), "w") as fh:
        fh.write("carrier_code,carrier_name\nAA,American Airlines\n")
    main(["--flat", os.path.join(d, "flat.csv"), "--carriers", os.path.join(d, "names.csv"), "--out", os.path.join(d, "dw")])
    assert "1 carrier codes without a name, the first: B6" in capsys.readouterr().out
    from dwkit.plans.pipeline import current_load
    got = {tuple(r) for r in spark.read.parquet(current_load(spark, os.path.join(d, "dw")) + "/airline").collect()}
    assert got == {("AA", "American Airlines"), ("B6", "Unknown")}


def test_a_failing_listing_is_not_an_absent_table(spark):
    from dwkit.sources.files import exists
    assert not exists(spark, "/tmp/surely/not/there")
    with pytest.raises(Exception):
        exists(spark, "nosuchscheme://host/table")


def test_an_order_of_2000_lines(spark):
    from dwkit.plans.fixtures import order_lines
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(1)
    many = line.crossJoin(spark.range(2000)).drop("id").withColumn("l_quantity", F.lit(40.0))
    r = order_lines(many).first()
    assert max(r.carrier_delay, r.weather_delay, r.nas_delay) == 80_000


def test_read_table_sql_and_view(spark):
    from dwkit.sources import read_table
    spark.range(3).createOrReplaceTempView("dwkit_t")
    assert read_table(spark, "dwkit_t").count() == 3
    assert read_table(spark, "", sql="SELECT count(*) AS n FROM dwkit_t").first().n == 3


def test_only_a_missing_path_means_no_version(spark, tmp_path):
    from dwkit.sources.files import _versions
    assert _versions(spark, str(tmp_path / "none")) == []
    with pytest.raises(Exception, match="nosuchscheme"):
        _versions(spark, "nosuchscheme://host/table")
