"""Hourly averages as a stream that loses no late reading.

Below ``root``: ``partials`` (sums by hour, in a folder for each day and micro-batch), ``hours`` (the averages of closed hours), ``late``
(readings of hours that were closed when they came) and small marks. Every batch owns its folders, so a replay
replaces itself.
"""

from __future__ import annotations

import json
from collections.abc import Collection
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.dates import date_key
from tidemark.operators.sinks import (
    complete,
    file_names,
    partition_folders,
    path_exists,
    read_text,
    remove_folder,
    slice_of,
    write_text,
)
from tidemark.streaming.settings import writer
from tidemark.streaming.topics import MARKS_KEPT, batch_name, last_committed, write_batch_part

DAY, HOUR = "_date", "_hour"
AVERAGES = {"temperature": "avg_temp", "pressure": "avg_pressure", "humidity": "avg_humidity"}
_BOUNDS, _FOLDED = "_bounds", "_folded"


def hour_slice(moment: datetime) -> int:
    return int(moment.strftime("%Y%m%d%H"))


def _slice(time_col: str):
    return F.date_format(time_col, "yyyyMMddHH").cast("int")


def partial_hours(readings: DataFrame) -> DataFrame:
    """Sums and counts by batch, hour and location: what averages can be merged from."""
    sums = [m for c in AVERAGES for m in (F.sum(F.col(c).cast("double")).alias(f"_sum_{c}"), F.count(c).alias(f"_n_{c}"))]
    return (readings.groupBy("_batch_id", F.date_trunc("hour", "event_ts").alias("hour_ts"), "location_id")
            .agg(*sums, F.count(F.lit(1)).alias("reading_count")))


def merged_hours(partials: DataFrame) -> DataFrame:
    """Averages out of partial sums; an average of no value is NULL."""
    sums = [F.sum(f"_{kind}_{c}").alias(f"_{kind}_{c}") for c in AVERAGES for kind in ("sum", "n")]
    totals = partials.groupBy("hour_ts", "location_id").agg(*sums, F.sum("reading_count").alias("reading_count"))
    averages = [(F.col(f"_sum_{c}") / F.nullif(F.col(f"_n_{c}"), F.lit(0))).alias(name) for c, name in AVERAGES.items()]
    return totals.select("hour_ts", "location_id", *averages, "reading_count")


def _replace(rows: DataFrame, path: str, *parts: str) -> None:
    (rows.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(path))


def _store_partials(rows: DataFrame, root: str) -> None:
    _replace(partial_hours(rows).withColumn(DAY, date_key(F.col("hour_ts"))), f"{root}/partials", DAY, "_batch_id")


def _build(spark: SparkSession, root: str, hours: Collection[int]) -> None:
    """Compute and replace some hours; only folders of their days are opened, and files by their range of hours."""
    days = {h // 100 for h in hours}
    folders = [f for f in partition_folders(spark, f"{root}/partials", f"{DAY}=*") if slice_of(f) in days]
    if folders and hours:
        rows = spark.read.option("basePath", f"{root}/partials").parquet(*folders)
        first, last = (F.lit(datetime.strptime(str(h), "%Y%m%d%H")).cast("timestamp") for h in (min(hours), max(hours)))
        rows = rows.filter(F.col("hour_ts").between(first, last)).filter(_slice("hour_ts").isin(*hours))
        _replace(merged_hours(rows).withColumn(HOUR, _slice("hour_ts")), f"{root}/hours", HOUR)


def _close(spark: SparkSession, root: str, since: int, until: int) -> None:
    """Build the hours from ``since`` on before ``until``, as far as days are stored."""
    if since < until:
        days = (slice_of(f) for f in partition_folders(spark, f"{root}/partials", f"{DAY}=*"))
        _build(spark, root, [h for day in days for h in range(day * 100, day * 100 + 24) if since <= h < until])


def _bound_before(spark: SparkSession, root: str, batch_id: int) -> dict:
    """What earlier batches left: the newest time seen and the first hour that is still open."""
    earlier = [int(n) for n in file_names(spark, f"{root}/{_BOUNDS}") if n.isdigit() and int(n) < batch_id]
    return json.loads(read_text(spark, f"{root}/{_BOUNDS}/{max(earlier)}")) if earlier else {"newest": None, "open_from": 0}


def _batch(readings: DataFrame, batch_id: int, root: str, topic: str, lateness: timedelta) -> None:
    spark = readings.sparkSession
    before, name = _bound_before(spark, root, batch_id), batch_name(topic, batch_id)
    on_time = _slice("event_ts") >= before["open_from"]
    timed = readings.filter(F.col("event_ts").isNotNull()).persist()
    try:
        seen = timed.agg(F.max(F.unix_micros("event_ts")).alias("newest"), F.count_if(~on_time).alias("late")).first()
        newest = max((t for t in (before["newest"], seen.newest) if t is not None), default=None)
        open_from = before["open_from"]
        if newest is not None:
            edge = datetime.fromtimestamp(newest // 1_000_000, timezone.utc) - lateness
            open_from = max(open_from, hour_slice(edge))
        if seen.late:
            write_batch_part(timed.filter(~on_time), f"{root}/late", name)
        _store_partials(timed.filter(on_time).withColumn("_batch_id", F.lit(name)), root)
    finally:
        timed.unpersist()
    _close(spark, root, before["open_from"], open_from)
    # Written last: a batch that dies is done again from what stood before it.
    write_text(spark, f"{root}/{_BOUNDS}/{batch_id}", json.dumps({"newest": newest, "open_from": open_from}))
    if batch_id >= MARKS_KEPT:
        remove_folder(spark, f"{root}/{_BOUNDS}/{batch_id - MARKS_KEPT}")


def hourly_with_late(readings: DataFrame, root: str, checkpoint: str, lateness: timedelta, topic: str = "sensors",
                     available_now: bool = False) -> StreamingQuery:
    """Hourly averages by location; an hour closes ``lateness`` after its end, by the newest event of earlier batches.

    Readings of open hours become partial sums, stored by hour; an hour that closes is merged from them once.
    Readings of closed hours are stored as they are in ``late``, however old, and wait for ``fold_late``. A
    micro-batch shuffles its sums by hour and location only and opens the hours it closes.
    """
    return writer(readings, f"hourly_{topic}", checkpoint, available_now).foreachBatch(
        lambda batch, batch_id: _batch(batch, batch_id, root, topic, lateness)).start()


def read_late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Readings that came after their hour had closed, folded or not."""
    path = f"{root}/late"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_hours(spark: SparkSession, root: str) -> DataFrame:
    """Closed hours."""
    return spark.read.parquet(f"{root}/hours").drop(HOUR)


def fold_late(spark: SparkSession, root: str, checkpoint: str) -> list[int]:
    """Rebuild the closed hours that late readings belong to; returns them.

    Taken are batches that the stream has committed and no earlier run has folded. Their sums join those of
    their hours under the names of their batches, so a run that died is repeated without counting twice. May
    run beside the stream: an hour is closed before a reading can be late for it, and is not written by the stream again.
    """
    last, done = last_committed(spark, checkpoint), set(file_names(spark, f"{root}/{_FOLDED}"))
    folders = {f.rsplit("=", 1)[1]: f for f in partition_folders(spark, f"{root}/late", "_batch_id=*")
               if complete(spark, f) and int(f.rsplit("_", 1)[1]) <= last}
    new = sorted(folders.keys() - done)
    if not new:
        return []
    rows = spark.read.option("basePath", f"{root}/late").parquet(*[folders[n] for n in new])
    hours = [r[0] for r in rows.select(_slice("event_ts")).distinct().collect()]  # hours, not readings
    _store_partials(rows.withColumn("_batch_id", F.concat(F.lit("late_"), "_batch_id")), root)
    _build(spark, root, hours)
    for name in new:
        write_text(spark, f"{root}/{_FOLDED}/{name}", "")
    return sorted(hours)
