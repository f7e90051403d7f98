"""Dimensions that are defined rather than loaded."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key

# The sensor sites.
SENSOR_LOCATIONS = (
    ("LOC-001", "Warehouse A", 3.1390, 101.6869, "multi"),
    ("LOC-002", "Factory B", 1.3521, 103.8198, "multi"),
    ("LOC-003", "Office C", 13.7563, 100.5018, "multi"),
    ("LOC-004", "Depot D", 22.3193, 114.1694, "multi"),
    ("LOC-005", "Plant E", 37.5665, 126.9780, "multi"),
)

# First and last day of the calendar.
CALENDAR_START = date(2024, 1, 1)
CALENDAR_END = date(2027, 12, 31)


def seed_sensor_locations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(SENSOR_LOCATIONS),
        "location_id string, site_name string, latitude double, longitude double, sensor_type string",
    )


def date_dimension(spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END) -> DataFrame:
    """One row per day, both ends included; weeks and weekdays as in ISO 8601."""
    days = spark.range((end - start).days + 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
    weekday = F.weekday("full_date") + 1
    return days.select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.weekofyear("full_date").alias("week"),
        weekday.alias("day_of_week"),
        weekday.isin(6, 7).cast("int").alias("is_weekend"),
    )
