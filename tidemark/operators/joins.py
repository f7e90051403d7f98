"""Joins of facts with dimensions and of hours with their day.

No side is forced into a broadcast: dimensions grow with the business. Spark
broadcasts a side whose size, estimated or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``; above it the join shuffles, and a hot key
(say, one guest account with a third of the sales) is split by the skew join of
adaptive execution. That split needs a shuffle of its own right below both sides of
the join, see ``unpartitioned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"  # fixed value: name of a missing region or category


def unpartitioned(dimension: DataFrame) -> DataFrame:
    """A dimension that is free of the partitioning that made it.

    A dimension fresh from its latest-per-key window is already partitioned by the
    join key. Spark would join on that partitioning, and a hot fact key could not be
    split. REBALANCE moves the dimension once. A stored dimension does not need it.
    """
    return dimension.hint("rebalance")


def star_left(sales: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Every sale with its category and region; what a dimension lacks is ``unknown``."""
    joined = (sales
              .join(dim_product.select("product_id", "category"), "product_id", "left")
              .join(dim_customer.select("customer_id", "region"), "customer_id", "left"))
    return joined.withColumns({
        "region": F.coalesce("region", F.lit(UNKNOWN)),
        "category": F.coalesce("category", F.lit(UNKNOWN)),
    })


def star_inner(sales: DataFrame, dim_product: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Only sales whose customer and product are known."""
    return (sales
            .join(dim_customer.select("customer_id", "region"), "customer_id", "inner")
            .join(dim_product.select("product_id", "category"), "product_id", "inner"))


def with_day_stats(hourly: DataFrame, stats: DataFrame) -> DataFrame:
    """Hours with the statistics of their location and calendar day."""
    day = stats.withColumnRenamed("location_id", "_location")
    return hourly.join(
        day,
        (F.col("location_id") == F.col("_location"))
        & (F.date_trunc("day", F.col("hour_ts")) == F.col("day_ts")),
        "left",
    ).drop("_location")


def on_days_of(fact: DataFrame, calendar: DataFrame, chosen: Column, *columns: str) -> DataFrame:
    """Facts of the days that a condition on the calendar chooses, with the named columns of the calendar.

    On a stored fact, whose folders are its days, the chosen days become a filter on the folders while the query
    runs (dynamic partition pruning): other days are not opened. Days missing from the calendar drop out.
    """
    return fact.join(calendar.filter(chosen).select("date_key", *columns), "date_key")
