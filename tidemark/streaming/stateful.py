"""Streams that remember: de-duplication and hourly averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LANE = "_lane"


def dedup_stream(df: DataFrame, key: str, lateness: str, time_col: str = "event_ts", lanes: int = 1) -> DataFrame:
    """First event per key. A key is forgotten ``lateness`` after the newest event time seen.

    A stream cannot drop duplicates before its shuffle, so one key that is repeated
    without end (a producer that keeps re-sending) would fill one task. With
    ``lanes`` > 1 duplicates are first dropped per key *and* lane, where the lane is
    given by the reading task, and then per key: at most ``lanes`` rows of a key reach
    the second step. The price is a second state, so use it when such keys occur.
    """
    keyed = df.filter(F.col(key).isNotNull() & F.col(time_col).isNotNull()).withWatermark(time_col, lateness)
    if lanes > 1:
        laned = keyed.withColumn(_LANE, F.spark_partition_id() % lanes)
        keyed = laned.dropDuplicatesWithinWatermark([key, _LANE]).drop(_LANE)
    return keyed.dropDuplicatesWithinWatermark([key])


def hourly_sensor_stream(df: DataFrame, lateness: str) -> DataFrame:
    """Hourly averages per location; an hour is emitted once the watermark has passed it.

    State is one row per open hour and location, and readings are averaged before the
    shuffle, so a busy location costs no more than a quiet one.
    """
    hour = F.window("event_ts", "1 hour")
    return (df.withWatermark("event_ts", lateness).groupBy(hour.alias("_hour"), "location_id")
            .agg(F.avg("temperature").alias("avg_temp"), F.avg("pressure").alias("avg_pressure"),
                 F.avg("humidity").alias("avg_humidity"), F.count(F.lit(1)).alias("reading_count"))
            .select(F.col("_hour.start").alias("hour_ts"), "location_id", "avg_temp",
                    "avg_pressure", "avg_humidity", "reading_count"))


def newest_stream(df: DataFrame, key: str, apart: str, lateness: str, time_col: str = "event_ts") -> DataFrame:
    """Newest event per key, emitted once: the rule of the batch layer, for streams.

    Copies of a key belong together while each lies at most ``apart`` from another one in event time. The
    state holds one row for each open key: the newest copy so far, equal times decided by the other columns as
    in ``latest_per_key``, so neither order nor batch of arrival matters. A key leaves the state, and its row is
    emitted, when the watermark (``lateness`` behind the newest event) has passed its newest copy by ``apart``.
    Copies that come later still are a second row, which the fact builder drops. Rows without key or time are left out.

    Copies are merged in the task that reads them before the shuffle (a setting of the session), so a key that a
    producer sends again and again costs one row a task.
    """
    tie = [f.name for f in df.schema.fields if f.name not in (key, time_col) and not isinstance(f.dataType, T.MapType)]
    timed = df.filter(F.col(key).isNotNull() & F.col(time_col).isNotNull()).withWatermark(time_col, lateness)
    newest = F.max_by(F.struct(*df.columns), F.struct(time_col, *tie))
    return (timed.groupBy(F.session_window(time_col, apart).alias("_open"), F.col(key).alias("_key"))
            .agg(newest.alias("_newest")).select("_newest.*"))
