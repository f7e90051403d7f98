"""Intermediate models and marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import literal
from tidemark.operators.joins import star_left

CANCELLED = "cancelled"  # fixed value
SIGMAS = 3  # fixed value: an hour further than this from its day's mean is an anomaly


def computed_at(as_of: datetime | None = None) -> Column:
    moment = F.current_timestamp() if as_of is None else literal(as_of).cast("timestamp")
    return moment.alias("_computed_at")


def int_daily_revenue(stg_sales: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders, revenue, average order value and units per day, region and category."""
    sales = stg_sales.filter(F.col("status") != CANCELLED)
    return (star_left(sales, dim_product, dim_customer)
            .groupBy("date_key", F.to_date("event_ts").alias("full_date"), "region", "category")
            .agg(F.count(F.lit(1)).alias("total_orders"),
                 F.sum("total_amount").alias("total_revenue"),
                 F.avg("total_amount").alias("avg_order_value"),
                 F.sum("quantity").alias("total_units")))


def agg_daily_revenue(daily: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return daily.select("date_key", "full_date", "region", "category", "total_orders",
                        "total_revenue", "avg_order_value", "total_units", computed_at(as_of))


def plausible(stg_sensors: DataFrame) -> DataFrame:
    """Readings whose three values are all known and in range."""
    return stg_sensors.filter("temp_in_range and pressure_in_range and humidity_in_range")


def hourly_moments(readings: DataFrame) -> DataFrame:
    """Per location and hour: count, sums and squared deviations — enough for any longer period."""
    def moments(name: str) -> list[Column]:
        value = F.col(name).cast("double")
        return [F.sum(value).alias(f"sum_{name}"),
                (F.var_pop(value) * F.count(value)).alias(f"dev_{name}")]

    return (readings.groupBy("location_id", F.date_trunc("hour", "event_ts").alias("hour_ts"))
            .agg(F.count(F.lit(1)).alias("reading_count"),
                 *moments("temperature"), *moments("pressure"),
                 F.avg("humidity").alias("avg_humidity")))


def day_stats(readings: DataFrame) -> DataFrame:
    """Mean and population deviation of temperature and pressure per location and calendar day."""
    return (readings.groupBy("location_id", F.date_trunc("day", "event_ts").alias("day_ts"))
            .agg(F.avg("temperature").alias("avg_temp_day"),
                 F.stddev_pop("temperature").alias("std_temp_day"),
                 F.avg("pressure").alias("avg_pressure_day"),
                 F.stddev_pop("pressure").alias("std_pressure_day")))


def outside(value: str, mean: str, deviation: str) -> Column:
    return F.abs(F.col(value) - F.col(mean)) > SIGMAS * F.col(deviation)


def int_sensor_anomalies(stg_sensors: DataFrame) -> DataFrame:
    """Hourly averages with the statistics of their location and day, and the 3σ flag.

    The readings are scanned and shuffled once, as partial sums per location and hour.
    The day's mean and deviation are merged from its at most 24 hours, which replaces
    a second pass over all readings and the join of hours with days.
    """
    hourly = hourly_moments(plausible(stg_sensors)).withColumn(
        "_day", F.date_trunc("day", F.col("hour_ts")))
    day = Window.partitionBy("location_id", "_day")
    count = F.col("reading_count")

    def mean_of(name: str) -> Column:
        return F.sum(f"sum_{name}").over(day) / F.sum(count).over(day)

    def deviation_of(name: str, mean: str) -> Column:
        shift = F.col(f"sum_{name}") / count - F.col(mean)
        return F.sqrt(F.sum(F.col(f"dev_{name}") + count * shift * shift).over(day)
                      / F.sum(count).over(day))

    with_means = hourly.withColumns({
        "avg_temp": F.col("sum_temperature") / count,
        "avg_pressure": F.col("sum_pressure") / count,
        "avg_temp_day": mean_of("temperature"),
        "avg_pressure_day": mean_of("pressure"),
    })
    with_deviations = with_means.withColumns({
        "std_temp_day": deviation_of("temperature", "avg_temp_day"),
        "std_pressure_day": deviation_of("pressure", "avg_pressure_day"),
    })
    return with_deviations.select(
        "location_id", "hour_ts", "avg_temp", "avg_pressure", "avg_humidity", "reading_count",
        "avg_temp_day", "std_temp_day", "avg_pressure_day", "std_pressure_day",
        outside("avg_temp", "avg_temp_day", "std_temp_day").alias("temp_anomaly"),
    )


def agg_hourly_sensor(anomalies: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return anomalies.select(
        "location_id", "hour_ts", "avg_temp", "avg_pressure", "avg_humidity", "reading_count",
        F.col("temp_anomaly").cast("int").alias("anomaly_flag"), computed_at(as_of))


def agg_trading_volume(stg_trades: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (stg_trades.groupBy("date_key", F.to_date("event_ts").alias("full_date"), "asset")
            .agg(F.sum("quantity").alias("total_volume"),
                 F.count(F.lit(1)).alias("trade_count"),
                 F.avg("price").alias("avg_price"),
                 F.sum("total_value").alias("total_value"),
                 F.count_if(F.col("side") == "buy").alias("buy_count"),
                 F.count_if(F.col("side") == "sell").alias("sell_count"))
            .withColumn("_computed_at", computed_at(as_of)))
