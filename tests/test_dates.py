"""Days, windows and pushdown."""

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.functions.dates import (
    as_instant,
    date_key,
    floor_hour,
    on_day,
    since,
    since_day,
    years_before,
)
from tidemark.sources.layers import read_silver
from tidemark.sources.seeds import date_dimension

MICRO = timedelta(microseconds=1)


def times(spark, *moments, kind="timestamp"):
    df = spark.createDataFrame([(m,) for m in moments], "event_ts timestamp")
    return df.select(F.col("event_ts").cast(kind).alias("event_ts"))


def test_date_key(spark):
    assert times(spark, datetime(2024, 2, 9, 23, 59)).select(date_key(F.col("event_ts"))).first()[0] == 20240209


def test_a_day_begins_at_midnight_and_ends_before_the_next(spark):
    start, end = datetime(2024, 1, 5), datetime(2024, 1, 6)
    for kind in ("timestamp", "timestamp_ntz"):
        df = times(spark, start - MICRO, start, end - MICRO, end, kind=kind)
        assert [r[0] for r in on_day(df, "2024-01-05").collect()] == [start, end - MICRO]


def test_rolling_window_includes_its_edge(spark):
    as_of = datetime(2024, 1, 10, 12)
    edge = as_of - timedelta(hours=2)
    for kind in ("timestamp", "timestamp_ntz"):
        df = times(spark, edge - MICRO, edge, edge + MICRO, kind=kind)
        assert df.filter(since("event_ts", as_of, hours=2)).count() == 2


def test_rolling_days_start_at_midnight(spark):
    as_of = datetime(2024, 1, 10, 12)
    df = times(spark, datetime(2024, 1, 8) - MICRO, datetime(2024, 1, 8), datetime(2024, 1, 10, 1))
    assert df.filter(since_day("event_ts", as_of, 2)).count() == 2
    days = spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 1, 8),)], "d date")
    assert days.filter(since_day("d", as_of, 2)).count() == 1


def test_moments_with_a_zone_mean_the_same_instant(spark):
    plus_two = datetime(2024, 1, 10, 14, tzinfo=timezone(timedelta(hours=2)))
    assert as_instant(plus_two) == datetime(2024, 1, 10, 12)
    assert floor_hour(plus_two + timedelta(minutes=59)) == datetime(2024, 1, 10, 12)


def test_years_before_a_leap_day():
    assert years_before(datetime(2024, 2, 29, 5), 1) == datetime(2023, 2, 28, 5)
    assert years_before(datetime(2024, 3, 1), 2) == datetime(2022, 3, 1)


def test_day_filter_prunes_partitions_and_reaches_the_files(spark, folder, plan):
    rows = spark.createDataFrame(
        [("a", datetime(2024, 1, 5), 2024, 1, 5, "b"), ("c", datetime(2024, 1, 6), 2024, 1, 6, "b")],
        "reading_id string, event_ts timestamp, _year int, _month int, _day int, _batch_id string")
    rows.write.partitionBy("_year", "_month", "_day", "_batch_id").parquet(f"{folder}/sensors")
    day = read_silver(spark, folder, "sensors", "2024-01-05").select("reading_id")
    assert [r[0] for r in day.collect()] == ["a"]
    text = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_year" in text and "_day" in text
    assert "GreaterThanOrEqual(event_ts" in text


def test_calendar(spark):
    days = date_dimension(spark)
    assert days.count() == 1461
    row = days.filter("date_key = 20240107").first()  # a Sunday in ISO week 1
    assert (row.full_date, row.quarter, row.week, row.day_of_week, row.is_weekend) == (date(2024, 1, 7), 1, 1, 7, 1)
    assert days.filter("date_key = 20240108").first().day_of_week == 1
    assert days.agg(F.max("full_date")).first()[0] == date(2027, 12, 31)
