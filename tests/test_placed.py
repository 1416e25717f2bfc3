import datetime as dt

from pyspark.sql import functions as F

from dwkit.operators.snapshot import apply_completions, apply_completions_placed, open_snapshot
from dwkit.operators.windows import surrogate_placed, with_surrogate
from dwkit.plans.fact import load_fact, prepare_keyed
from dwkit.operators.dims import date_dim, reason_dim

DAY = dt.datetime(2024, 1, 1)


def exchanges(df):
    return [line.split("Exchange ")[1].split("(")[0] for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
            if "Exchange " in line and "BroadcastExchange" not in line]


def by_month(spark):
    """Ids that repeat, in one month and in two, and null ones."""
    of = [(i, 202401 + i % 3, float(i)) for i in range(60)] + [(7, 202402, -1.0), (7, 202401, -2.0), (None, 202401, 0.5), (None, 202403, 1.5)]
    return spark.createDataFrame(of, "operation_id long, month_key int, x double").repartition(5)


def test_numbers_are_dense_by_key_and_rows_move_once(spark, tmp_path):
    by_month(spark).write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out = surrogate_placed(df, "sk", "month_key", "operation_id", start=11)
    assert exchanges(out)[0] == "rangepartitioning" and exchanges(out).count("rangepartitioning") == 1    # the other one counts partitions
    got, want = out.collect(), with_surrogate(df, "sk", ["operation_id", "month_key"], start=11).collect()
    assert out.columns == ["sk", *df.columns] and sorted(r.sk for r in got) == list(range(11, 11 + df.count()))
    alike = lambda rows: sorted((r.sk, str(r.operation_id), r.month_key) for r in rows)
    assert alike(got) == alike(want) and sorted(r.x for r in got) == sorted(r.x for r in want)


def test_completions_move_with_the_fact_to_its_place(spark, tmp_path):
    fact = open_snapshot(by_month(spark).withColumn("fl_date", F.lit(dt.date(2024, 1, 1))))
    feed = spark.createDataFrame([(i, DAY + dt.timedelta(days=i)) for i in range(0, 40, 2)] + [(7, DAY), (7, DAY + dt.timedelta(days=3)),
                                 (900, DAY), (None, DAY), (8, None)], "operation_id long, accm_txn_complete_time timestamp_ntz")
    rows = lambda df: sorted(map(str, df.collect()))
    for n in (1, 2):                                  # the second time rows are closed already
        want = apply_completions(fact, feed, DAY)
        got = apply_completions_placed(fact, feed, "month_key", str(tmp_path / f"stage-{n}"), DAY)
        assert got[0].columns == want[0].columns and rows(got[0]) == rows(want[0]) and rows(got[1]) == rows(want[1])
        assert rows(want[1])[0].startswith("Row(operation_id=900") and len(rows(want[1])) == 2
        fact, feed = want[0], feed.withColumn("accm_txn_complete_time", F.lit(DAY))
    got[0].write.partitionBy("month_key").parquet(str(tmp_path / "fact"))
    stored = spark.read.parquet(str(tmp_path / "fact"))
    again, _ = apply_completions_placed(stored, feed, "month_key", str(tmp_path / "stage-3"), DAY)
    assert exchanges(again) == ["rangepartitioning"]


def test_routes_meet_only_the_columns_that_are_kept(spark, tmp_path):
    parts = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]
    keyed = spark.createDataFrame([(i, 10, dt.date(2024, 1, 1 + i), 2024, 1, 1 + i, 1.0, 0, None, *[i] * 5) for i in range(3)],
                                  "operation_id long, flight_id int, fl_date date, year int, month int, day_of_month int, dep_delay double, "
                                  "cancelled int, cancellation_code string, " + ", ".join(f"{p} int" for p in parts))
    route = spark.createDataFrame([(10, 10, "AA", "J", "L", 5.0)], "route_key int, flight_id int, carrier_code string, origin_code string, dest_code string, distance double")
    airline = spark.createDataFrame([(1, "AA", True)], "airline_key int, carrier_code string, is_current_record boolean")
    airport = spark.createDataFrame([(1, "J"), (2, "L")], "airport_key int, airport_code string")
    fact, errors = load_fact(prepare_keyed(keyed), date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2)), airline, airport, route, reason_dim(spark),
                             DAY, stage_path=str(tmp_path / "stage"))
    staged = spark.read.parquet(str(tmp_path / "stage")).columns
    assert not {"year", "month", "day_of_month", "cancellation_code"} & set(staged) and "cancellation_code_clean" in staged
    assert sorted((r.operation_key, r.operation_id, r.month_key, r.total_delay_minutes) for r in fact.collect()) == [(1, 0, 202401, 0), (2, 1, 202401, 5)]
    assert [r.raw_row.split("|")[0] for r in errors.collect()] == ["2"]
