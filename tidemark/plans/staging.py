"""Staging models: light cleaning on top of the facts. Lazy, so they are views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.filters import in_range, one_of, present

# What a sensor can physically report, and the two sides of a trade.
TEMPERATURE_RANGE = (-50, 85)
PRESSURE_RANGE = (870, 1085)
HUMIDITY_RANGE = (0, 100)
SIDES = ("buy", "sell")
# Weights of an interaction.
SHARE_WEIGHT, COMMENT_WEIGHT = 3, 2


def _lower(name: str) -> Column:
    return F.lower(F.trim(F.col(name)))


def stg_sales(fact: DataFrame) -> DataFrame:
    kept = present(fact, "sale_id", "customer_id", "product_id").filter(F.col("total_amount") > 0)
    return kept.withColumns({
        "quantity": F.col("quantity").try_cast("bigint"),
        "unit_price": F.col("unit_price").cast("decimal(18,2)"),
        "total_amount": F.col("total_amount").cast("decimal(18,2)"),
        "status": _lower("status"),
    })


def stg_sensors(fact: DataFrame) -> DataFrame:
    return present(fact, "reading_id", "location_id").withColumns({
        "temp_in_range": in_range("temperature", *TEMPERATURE_RANGE),
        "pressure_in_range": in_range("pressure", *PRESSURE_RANGE),
        "humidity_in_range": in_range("humidity", *HUMIDITY_RANGE),
    })


def stg_trades(fact: DataFrame) -> DataFrame:
    cleaned = fact.withColumns({"asset": F.upper(F.trim("asset")), "side": _lower("side")})
    return (present(cleaned, "trade_id")
            .filter((F.col("quantity") > 0) & (F.col("price") > 0) & one_of("side", SIDES)))


def stg_social(fact: DataFrame) -> DataFrame:
    return present(fact, "post_id", "platform").withColumns({
        "platform": _lower("platform"),
        "content_type": _lower("content_type"),
        "weighted_engagement": F.col("likes") + F.col("shares") * SHARE_WEIGHT
        + F.col("comments") * COMMENT_WEIGHT,
    })
