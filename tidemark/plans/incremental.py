"""Marts that are stored by day, of which only the days whose facts have changed are computed again."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key
from tidemark.operators.sinks import (
    FINGERPRINT,
    day_fingerprint,
    day_marks,
    mark_days,
    mark_text,
    move_folder,
    observed,
    partition_folders,
    path_exists,
    read_text,
    remove_folder,
    slice_folders,
    slice_of,
    write_text,
)
from tidemark.plans import marts, staging
from tidemark.schemas import WAREHOUSE
from tidemark.sources.layers import read_days, read_warehouse

DAY = "_day"


@dataclass(frozen=True)
class Mart:
    """A mart whose rows of a day depend on that day's facts, and on the named columns of dimensions."""

    fact: str
    build: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]
    dimensions: Mapping[str, tuple[str, str]]  # table → its key, and the column that the mart takes


def _daily_revenue(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    daily = marts.int_daily_revenue(staging.stg_sales(fact), dims["dim_product"], dims["dim_customer"])
    return marts.agg_daily_revenue(daily).withColumn(DAY, F.col("date_key"))


def _hourly_sensor(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    hourly = marts.agg_hourly_sensor(marts.int_sensor_anomalies(staging.stg_sensors(fact)))
    return hourly.withColumn(DAY, date_key(F.col("hour_ts")))


def _trading_volume(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return marts.agg_trading_volume(staging.stg_trades(fact)).withColumn(DAY, F.col("date_key"))


MARTS = {
    "agg_daily_revenue": Mart("fact_sales", _daily_revenue, {"dim_product": ("product_id", "category"), "dim_customer": ("customer_id", "region")}),
    "agg_hourly_sensor": Mart("fact_sensor_readings", _hourly_sensor, {}),
    "agg_trading_volume": Mart("fact_trades", _trading_volume, {}),
}


def mark_table(spark: SparkSession, warehouse_root: str, table: str) -> dict[int, str]:
    """Marks of all stored days. Days that have none (not written by ``load_fact``) are read once and marked."""
    path, spec = f"{warehouse_root}/{table}", WAREHOUSE[table]
    stored = {slice_of(f) for f in slice_folders(spark, path, spec)}
    marks_now = {day: mark for day, mark in day_marks(spark, path).items() if day in stored}
    unmarked = stored - marks_now.keys()
    if unmarked:
        # One row a day; a day without rows is marked as well.
        rows = read_days(spark, warehouse_root, table, unmarked).groupBy("date_key").agg(*day_fingerprint(spec)).collect()
        made = {**dict.fromkeys(unmarked, mark_text((0, 0, 0))), **{r.date_key: mark_text([r[n] for n in FINGERPRINT]) for r in rows}}
        marks_now |= made
        mark_days(spark, path, marks_now)
    return marks_now


def _state(spark: SparkSession, path: str) -> dict:
    """What the mart was made of: marks of its days, and the folder with the dimensions it used."""
    if not path_exists(spark, f"{path}/_made_of"):
        return {"days": {}, "dimensions": None}
    return json.loads(read_text(spark, f"{path}/_made_of"))


def _write_state(spark: SparkSession, path: str, state: dict) -> None:
    staged = f"{path}/_made_of-{uuid.uuid4().hex}"
    write_text(spark, staged, json.dumps(state))
    if path_exists(spark, f"{path}/_made_of"):
        remove_folder(spark, f"{path}/_made_of")  # a run that dies here builds everything again
    move_folder(spark, staged, f"{path}/_made_of")


def _changed_keys(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    before, after = old.select(key, F.col(value).alias("_before")), new.select(key, F.col(value).alias("_after"))
    found = before.withColumn("_was", F.lit(True)).join(after.withColumn("_is", F.lit(True)), key, "full")
    return found.where("_was is null or _is is null or not (_before <=> _after)").select(key)


def _days_of_changed_dimensions(spark: SparkSession, mart: Mart, warehouse_root: str, kept: str | None,
                                dims: Mapping[str, DataFrame], days: Collection[int]) -> set[int]:
    """Days with a fact whose dimension row changed in what the mart takes of it: of the facts, only keys are read."""
    if not mart.dimensions or not days:
        return set()
    found: set[int] = set()
    for name, (key, value) in mart.dimensions.items():
        changed = _changed_keys(spark.read.parquet(f"{kept}/{name}"), dims[name], key, value)
        if not changed.isEmpty():
            facts = read_days(spark, warehouse_root, mart.fact, days).select("date_key", key)
            found |= {r.date_key for r in facts.join(changed, key, "left_semi").select("date_key").distinct().collect()}
    return found


def changed_days(spark: SparkSession, name: str, warehouse_root: str, mart_root: str, dims: Mapping[str, DataFrame]) -> tuple[set[int], dict[int, str]]:
    """Days of a mart that must be computed again, and the marks of all days of its fact."""
    mart, path = MARTS[name], f"{mart_root}/{name}"
    now, state = mark_table(spark, warehouse_root, mart.fact), _state(spark, path)
    before = {int(day): mark for day, mark in state["days"].items()}
    changed = {day for day in now.keys() | before.keys() if now.get(day) != before.get(day)}
    same = now.keys() - changed
    if mart.dimensions and same:
        if not state["dimensions"] or not path_exists(spark, state["dimensions"]):
            return set(now) | changed, now
        changed |= _days_of_changed_dimensions(spark, mart, warehouse_root, state["dimensions"], dims, same)
    return changed, now


def refresh_mart(spark: SparkSession, name: str, warehouse_root: str, mart_root: str,
                 seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[int]:
    """Bring a mart up to date with its fact and dimensions; returns the days that were computed again.

    Every stored day of a fact has a mark of what it holds (rows and hashes, kept in the name of a file). Days
    whose mark differs from the one the mart was made of, days that came or went, and days with a fact whose
    dimension row changed are read, computed and replaced; all others are neither listed nor opened. Late events
    of old days are covered however old they are. The marks are written last: a run that dies does its days again.
    """
    mart, path = MARTS[name], f"{mart_root}/{name}"
    dims = {d: read_warehouse(spark, warehouse_root, d) for d in mart.dimensions}
    changed, now = changed_days(spark, name, warehouse_root, mart_root, dims)
    old = _state(spark, path)["dimensions"]
    if not changed and (old or not mart.dimensions) and path_exists(spark, f"{path}/_made_of"):
        return []
    kept = None
    if mart.dimensions:  # what the days to come are compared with: read before, written before
        kept = f"{path}/_dimensions-{uuid.uuid4().hex}"
        for d, (key, value) in mart.dimensions.items():
            dims[d].select(key, value).write.parquet(f"{kept}/{d}")
    rows = mart.build(read_days(spark, warehouse_root, mart.fact, changed), dims)
    # One name a day.
    written = Observation()
    (seen(rows).hint("rebalance", DAY).observe(written, F.collect_set(DAY).alias("days")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path))
    filled = set(observed(written, "days") or ())
    for folder in partition_folders(spark, path, f"{DAY}=*"):
        if slice_of(folder) in changed - filled:
            remove_folder(spark, folder)
    _write_state(spark, path, {"days": now, "dimensions": kept})
    if old:
        remove_folder(spark, old)
    return sorted(changed)


def read_mart(spark: SparkSession, mart_root: str, name: str) -> DataFrame:
    """A stored mart without the column of its folders."""
    return spark.read.parquet(f"{mart_root}/{name}").drop(DAY)
