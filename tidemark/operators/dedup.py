"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import Table


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """The newest row of every key; rows without a key are dropped.

    Equal times are decided by ``tie_break`` (by default all other columns), so the
    result does not depend on the order of arrival. Spark keeps at most one row per
    key and task *before* the shuffle (WindowGroupLimit), so a key that owns a large
    share of the rows sends one row per task and no task receives the whole group.
    """
    if tie_break is None:
        tie_break = [f.name for f in df.schema.fields
                     if f.name not in (*keys, order_col) and not isinstance(f.dataType, T.MapType)]
    newest_first = [F.col(c).desc_nulls_last() for c in (order_col, *tie_break)]
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def deduplicate(df: DataFrame, key: str, order_col: str = "event_ts",
                tie_break: Sequence[str] | None = None) -> DataFrame:
    """Latest event per key inside a batch."""
    return latest_per_key(df, [key], order_col, tie_break)


def latest_version(df: DataFrame, keys: Sequence[str], version_col: str = "_loaded_at",
                   tie_break: Sequence[str] | None = None) -> DataFrame:
    """Newest loaded version per key, as a replacing merge leaves it."""
    return latest_per_key(df, keys, version_col, tie_break)


def merged_dimension(df: DataFrame, table: Table) -> DataFrame:
    """``latest_version`` with the key and version column the table declares."""
    return latest_version(df, table.order_by, table.version_column)
