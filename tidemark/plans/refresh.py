"""Rolling rebuilds of the warehouse aggregates: only the newest days or hours.

These differ on purpose from the marts: inner joins instead of left joins, no status
filter, a fixed temperature band instead of 3σ.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casting import project_to
from tidemark.functions.dates import as_instant, floor_hour, newer
from tidemark.operators.joins import star_inner
from tidemark.operators.sinks import write_window
from tidemark.plans.marts import computed_at
from tidemark.schemas import WAREHOUSE

# Width of the windows and the normal temperature band.
DAYS_BACK = 2
HOURS_BACK = 2
WARM, COLD = 35, 10


def day_cutoff(as_of: datetime):
    return as_instant(as_of).date() - timedelta(days=DAYS_BACK)


def hour_cutoff(as_of: datetime) -> datetime:
    """Start of the hour ``HOURS_BACK`` before ``as_of``: the first hour is rebuilt whole."""
    return floor_hour(as_of - timedelta(hours=HOURS_BACK))


def refresh_daily_revenue(fact_sales: DataFrame, dim_customer: DataFrame, dim_product: DataFrame,
                          as_of: datetime) -> DataFrame:
    recent = newer(fact_sales, "event_ts", day_cutoff(as_of))
    daily = (star_inner(recent, dim_product, dim_customer)
             .groupBy("date_key", F.to_date("event_ts").alias("full_date"), "region", "category")
             .agg(F.count(F.lit(1)).alias("total_orders"),
                  F.sum("total_amount").alias("total_revenue"),
                  F.avg("total_amount").alias("avg_order_value"))
             .withColumn("_computed_at", computed_at(as_of)))
    return project_to(daily, WAREHOUSE["agg_daily_revenue"].schema)


def refresh_hourly_sensor(fact: DataFrame, as_of: datetime) -> DataFrame:
    recent = newer(fact, "event_ts", hour_cutoff(as_of))
    mean = F.avg("temperature")
    hourly = (recent.groupBy(F.date_trunc("hour", "event_ts").alias("hour_ts"), "location_id")
              .agg(mean.alias("avg_temp"),
                   F.avg("pressure").alias("avg_pressure"),
                   F.avg("humidity").alias("avg_humidity"),
                   F.count(F.lit(1)).alias("reading_count"),
                   ((mean > WARM) | (mean < COLD)).cast("int").alias("anomaly_flag"))
              .withColumn("_computed_at", computed_at(as_of)))
    return project_to(hourly, WAREHOUSE["agg_hourly_sensor"].schema)


def refresh_trading_volume(fact: DataFrame, as_of: datetime) -> DataFrame:
    recent = newer(fact, "event_ts", day_cutoff(as_of))
    daily = (recent.groupBy("date_key", F.to_date("event_ts").alias("full_date"), "asset")
             .agg(F.sum("quantity").alias("total_volume"),
                  F.count(F.lit(1)).alias("trade_count"),
                  F.avg("price").alias("avg_price"))
             .withColumn("_computed_at", computed_at(as_of)))
    return project_to(daily, WAREHOUSE["agg_trading_volume"].schema)


def refresh_aggregates(spark: SparkSession, facts: dict[str, DataFrame], root: str, as_of: datetime) -> list[str]:
    """Rebuild the newest window of the three stored aggregates."""
    fresh = {
        "agg_daily_revenue": (refresh_daily_revenue(
            facts["fact_sales"], facts["dim_customer"], facts["dim_product"], as_of), day_cutoff(as_of)),
        "agg_hourly_sensor": (refresh_hourly_sensor(
            facts["fact_sensor_readings"], as_of), hour_cutoff(as_of)),
        "agg_trading_volume": (refresh_trading_volume(facts["fact_trades"], as_of), day_cutoff(as_of)),
    }
    return [write_window(spark, rows, root, WAREHOUSE[name], cutoff)
            for name, (rows, cutoff) in fresh.items()]
