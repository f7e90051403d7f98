"""The ready reports. Every one is filter, group, order, limit on a mart or a fact.

Equal values are ordered by key, so a limit always keeps the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import recent, recent_days, since
from tidemark.plans.marts import int_sensor_anomalies, outside


def revenue_by_day(fact_sales: DataFrame, as_of: datetime, days: int = 30) -> DataFrame:
    return (recent(fact_sales, "event_ts", as_of, days=days)
            .groupBy(F.to_date("event_ts").alias("date"))
            .agg(F.sum("total_amount").alias("revenue")).orderBy("date"))


def top_products(fact_sales: DataFrame, as_of: datetime | None = None, limit: int = 10) -> DataFrame:
    return (fact_sales.groupBy("product_id")
            .agg(F.sum("total_amount").alias("revenue"), F.sum("quantity").alias("units"))
            .orderBy(F.desc("revenue"), "product_id").limit(limit))


def latest_anomalies(agg_hourly_sensor: DataFrame, as_of: datetime | None = None, limit: int = 50) -> DataFrame:
    return (agg_hourly_sensor.filter("anomaly_flag = 1")
            .select("location_id", "hour_ts", "avg_temp", "anomaly_flag")
            .orderBy(F.desc("hour_ts"), "location_id").limit(limit))


def trading_volume(agg_trading_volume: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """The price is the plain mean of the daily means."""
    return (recent_days(agg_trading_volume, "full_date", as_of, days).groupBy("asset")
            .agg(F.sum("total_volume").alias("volume"), F.avg("avg_price").alias("avg_price"))
            .orderBy(F.desc("volume"), "asset"))


def platform_engagement(fact_social: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (fact_social.groupBy("platform")
            .agg(*[F.sum(c).alias(c) for c in ("likes", "shares", "comments")])
            .orderBy(F.desc("likes"), "platform"))


def sensor_overview(fact_sensors: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    return (recent(fact_sensors, "event_ts", as_of, hours=hours).groupBy("location_id")
            .agg(F.avg("temperature").alias("avg_temp"), F.avg("humidity").alias("avg_humidity"),
                 F.count(F.lit(1)).alias("readings")))


def revenue_by_region(agg_daily_revenue: DataFrame, as_of: datetime, days: int = 7, limit: int = 50) -> DataFrame:
    return (recent_days(agg_daily_revenue, "full_date", as_of, days).groupBy("region")
            .agg(F.sum("total_revenue").alias("total_revenue"))
            .orderBy(F.desc("total_revenue"), "region").limit(limit))


def row_count(table: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("rows"))


def insight_count(llm_insights: DataFrame, as_of: datetime, hours: int = 24) -> DataFrame:
    return row_count(llm_insights.filter(since("created_at", as_of, hours=hours)))


def recent_anomaly_count(agg_hourly_sensor: DataFrame, as_of: datetime, hours: int = 1) -> DataFrame:
    return row_count(agg_hourly_sensor.filter("anomaly_flag = 1")
                     .filter(since("hour_ts", as_of, hours=hours)))


def revenue_over_time(agg_daily_revenue: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (agg_daily_revenue.groupBy(F.col("full_date").alias("time"))
            .agg(F.sum("total_revenue").alias("revenue")).orderBy("time"))


def temperature_series(agg_hourly_sensor: DataFrame, as_of: datetime, hours: int = 6) -> DataFrame:
    return (agg_hourly_sensor.filter(since("hour_ts", as_of, hours=hours))
            .select(F.col("hour_ts").alias("time"), "location_id", "avg_temp")
            .orderBy("time", "location_id"))


def top_assets(agg_trading_volume: DataFrame, as_of: datetime, days: int = 7, limit: int = 10) -> DataFrame:
    return (recent_days(agg_trading_volume, "full_date", as_of, days).groupBy("asset")
            .agg(F.sum("total_volume").alias("volume"))
            .orderBy(F.desc("volume"), "asset").limit(limit))


def insight_history(llm_insights: DataFrame, as_of: datetime | None = None, limit: int = 20) -> DataFrame:
    return (llm_insights.select("insight_id", "query_type", "user_query", "response",
                                "model_used", "latency_ms", "created_at")
            .orderBy(F.desc("created_at"), "insight_id").limit(limit))


def regions_vs_average(agg_daily_revenue: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Each region's revenue of a day against the mean of all regions that day."""
    regions = (agg_daily_revenue.groupBy("full_date", "region")
               .agg(F.sum("total_revenue").cast("double").alias("revenue")))
    mean = F.avg("revenue").over(Window.partitionBy("full_date"))
    return (regions.withColumn("avg_revenue", mean)
            .withColumn("position", F.when(F.col("revenue") > F.col("avg_revenue"), "above")
                        .when(F.col("revenue") < F.col("avg_revenue"), "below").otherwise("equal")))


def top_assets_vs_previous_day(agg_trading_volume: DataFrame, as_of: datetime | None = None,
                               limit: int = 3) -> DataFrame:
    """The leading assets of every day with their volume on the calendar day before."""
    daily = (agg_trading_volume.groupBy("full_date", "asset")
             .agg(F.sum("total_volume").alias("volume")))
    by_asset = Window.partitionBy("asset").orderBy("full_date")
    yesterday = F.when(F.lag("full_date").over(by_asset) == F.date_sub("full_date", 1),
                       F.lag("volume").over(by_asset))
    ranked = daily.withColumn("previous_volume", yesterday).withColumn(
        "position", F.row_number().over(
            Window.partitionBy("full_date").orderBy(F.desc("volume"), "asset")))
    return ranked.filter(F.col("position") <= limit)


def engagement_growth(stg_social: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Weighted engagement per platform and week, and its change over the week before."""
    weekly = (stg_social.groupBy("platform", F.to_date(F.date_trunc("week", "event_ts")).alias("week"))
              .agg(F.sum("weighted_engagement").alias("engagement")))
    by_platform = Window.partitionBy("platform").orderBy("week")
    before = F.when(F.lag("week").over(by_platform) == F.date_sub("week", 7),
                    F.lag("engagement").over(by_platform))
    return (weekly.withColumn("previous_engagement", before)
            .withColumn("growth", F.try_divide(
                (F.col("engagement") - F.col("previous_engagement")).cast("double"),
                F.col("previous_engagement"))))


def unusual_locations(stg_sensors: DataFrame, as_of: datetime, hours: int = 6) -> DataFrame:
    """Hours of the last ``hours`` whose temperature or pressure is outside 3σ of the day.

    Day statistics need whole days, so the readings are cut at the start of the first day. Hours and their
    day come out of one scan.
    """
    whole_days = recent_days(stg_sensors, "event_ts", as_of - timedelta(hours=hours), 0)
    annotated = int_sensor_anomalies(whole_days).filter(since("hour_ts", as_of, hours=hours))
    flagged = annotated.withColumn("pressure_anomaly", outside("avg_pressure", "avg_pressure_day", "std_pressure_day"))
    return flagged.filter("temp_anomaly or pressure_anomaly").select(
        "location_id", "hour_ts", "reading_count", "avg_temp", "avg_pressure", F.date_trunc("day", "hour_ts").alias("day_ts"),
        "avg_temp_day", "std_temp_day", "avg_pressure_day", "std_pressure_day", "temp_anomaly", "pressure_anomaly",
    ).orderBy("location_id", "hour_ts")


def status_breakdown(fact_sales: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (fact_sales.groupBy("status")
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
            .orderBy("status"))


def anomaly_heatmap(agg_hourly_sensor: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Anomalous hours per location (rows) and hour of the day (columns h00 … h23)."""
    hours = range(24)
    return (agg_hourly_sensor.groupBy("location_id")
            .agg(*[F.count_if((F.hour("hour_ts") == h) & (F.col("anomaly_flag") == 1)).alias(f"h{h:02d}")
                   for h in hours]))


def buy_sell_ratio(agg_trading_volume: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (agg_trading_volume.groupBy("asset")
            .agg(F.sum("buy_count").alias("buys"), F.sum("sell_count").alias("sells"))
            .withColumn("ratio", F.try_divide(F.col("buys").cast("double"), F.col("sells")))
            .orderBy("asset"))


def price_trend(agg_trading_volume: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return agg_trading_volume.select("asset", "full_date", "avg_price").orderBy("asset", "full_date")


def sentiment_breakdown(silver_social: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return (silver_social.groupBy("platform", "sentiment")
            .agg(F.count(F.lit(1)).alias("posts")).orderBy("platform", "sentiment"))


@dataclass(frozen=True)
class Report:
    build: Callable[..., DataFrame]
    table: str
    options: dict = field(default_factory=dict)


REPORTS: dict[str, Report] = {
    "revenue_by_day": Report(revenue_by_day, "fact_sales"),
    "top_products": Report(top_products, "fact_sales"),
    "top_5_products": Report(top_products, "fact_sales", {"limit": 5}),
    "latest_anomalies": Report(latest_anomalies, "agg_hourly_sensor"),
    "trading_volume": Report(trading_volume, "agg_trading_volume"),
    "platform_engagement": Report(platform_engagement, "fact_social_engagement"),
    "sensor_overview": Report(sensor_overview, "fact_sensor_readings"),
    "revenue_by_region": Report(revenue_by_region, "agg_daily_revenue"),
    "sales_count": Report(row_count, "fact_sales"),
    "reading_count": Report(row_count, "fact_sensor_readings"),
    "insight_count": Report(insight_count, "llm_insights"),
    "recent_anomaly_count": Report(recent_anomaly_count, "agg_hourly_sensor"),
    "revenue_over_time": Report(revenue_over_time, "agg_daily_revenue"),
    "temperature_series": Report(temperature_series, "agg_hourly_sensor"),
    "top_assets": Report(top_assets, "agg_trading_volume"),
    "insight_history": Report(insight_history, "llm_insights"),
    "regions_vs_average": Report(regions_vs_average, "agg_daily_revenue"),
    "top_assets_vs_previous_day": Report(top_assets_vs_previous_day, "agg_trading_volume"),
    "engagement_growth": Report(engagement_growth, "stg_social"),
    "unusual_locations": Report(unusual_locations, "stg_sensors"),
    "status_breakdown": Report(status_breakdown, "fact_sales"),
    "anomaly_heatmap": Report(anomaly_heatmap, "agg_hourly_sensor"),
    "buy_sell_ratio": Report(buy_sell_ratio, "mart_trading_volume"),
    "price_trend": Report(price_trend, "agg_trading_volume"),
    "sentiment_breakdown": Report(sentiment_breakdown, "silver_social"),
}


def run_report(name: str, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], as_of: datetime) -> DataFrame:
    """Build a report by name from the tables given (frames, or functions that make them)."""
    report = REPORTS[name]
    table = tables[report.table]
    return report.build(table() if callable(table) else table, as_of=as_of, **report.options)
