"""Row filters that several plans share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_type(df: DataFrame, event_type: str) -> DataFrame:
    """One event type of a mixed topic."""
    return df.filter(F.col("event_type") == event_type)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    for name in columns:
        df = df.filter(F.col(name).isNotNull())
    return df


def in_range(column: str, low: float, high: float) -> Column:
    """Both ends belong to the range; NULL stays NULL and is dropped by a filter."""
    return F.col(column).between(low, high)


def one_of(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isin(*values)
