import datetime as dt

from pyspark.sql import functions as F

from dwkit.operators.aggregates import correlation
from dwkit.operators.dims import date_dim, reason_dim
from dwkit.plans.fact import load_fact
from dwkit.sources.reference import US_FEDERAL_HOLIDAYS_2024


def test_row_failing_two_lookups_gives_one_error_row(spark):
    prepared = spark.createDataFrame([
        (1, 10, dt.date(2024, 1, 1), 0, "N/A"),     # fine
        (2, 11, dt.date(2024, 1, 1), 1, "B"),       # route has unknown carrier and unknown dest
        (3, 10, dt.date(2030, 1, 1), 0, "N/A"),     # date outside the calendar
    ], "operation_id long, flight_id int, fl_date date, cancelled int, cancellation_code_clean string")
    for p in ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
              "total_delay_minutes"]:
        prepared = prepared.withColumn(p, F.lit(0).cast("short"))
    dates = date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    airline = spark.createDataFrame([(1, "AA", True)], "airline_key int, carrier_code string, is_current_record boolean")
    airport = spark.createDataFrame([(1, "JFK"), (2, "LAX")], "airport_key int, airport_code string")
    route = spark.createDataFrame([(10, 10, "AA", "JFK", "LAX", 2475.0), (11, 11, "ZZ", "JFK", "XXX", 100.0)],
                                  "route_key int, flight_id int, carrier_code string, origin_code string, "
                                  "dest_code string, distance double")
    fact, errors = load_fact(prepared, dates, airline, airport, route, reason_dim(spark), dt.datetime(2025, 1, 1))
    assert [r.operation_id for r in fact.collect()] == [1]
    errs = {r.raw_row.split("|")[0]: r.error_description for r in errors.collect()}
    assert errs == {"2": "lookup failed: airline_key,dest_airport_key", "3": "lookup failed: date_key"}
    assert fact.count() + errors.count() == prepared.count()
    assert fact.first().operation_key == 1 and fact.first().cancellation_key == 0


def test_calendar_holidays_and_weekends(spark):
    d = {r.full_date: r for r in date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31),
                                          US_FEDERAL_HOLIDAYS_2024).collect()}
    assert len(d) == 366
    assert d[dt.date(2024, 7, 4)].is_public_holiday and not d[dt.date(2024, 7, 5)].is_public_holiday
    assert sum(r.is_public_holiday for r in d.values()) == 11
    assert d[dt.date(2024, 12, 28)].is_weekend and d[dt.date(2024, 12, 28)].day_name == "Saturday"
    assert d[dt.date(2024, 12, 31)].week_of_year == 1 and d[dt.date(2024, 12, 31)].year == 2024


def test_correlation_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert correlation(df, "a", "b").first().correlation is None
