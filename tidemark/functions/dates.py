"""Calendar keys and time filters that reach the scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import DAY_COLUMNS


def date_key(ts: Column) -> Column:
    """yyyyMMdd as an int, by arithmetic: no text formatting per row."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def day_columns(df: DataFrame, time_column: str = "event_ts") -> DataFrame:
    ts = F.col(time_column)
    year, month, day = DAY_COLUMNS
    return df.withColumns({year: F.year(ts), month: F.month(ts), day: F.dayofmonth(ts)})


def as_instant(moment: datetime) -> datetime:
    """The same moment as a naive UTC time."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return moment


def literal(moment: datetime | date) -> Column:
    """A literal that compares with a date, a timestamp or a timestamp without zone.

    Text is promoted to the column's own type, so the column stays bare and the
    comparison is pushed down to the files.
    """
    if isinstance(moment, datetime):
        return F.lit(as_instant(moment).isoformat(sep=" "))
    return F.lit(moment.isoformat())


def on_day(df: DataFrame, day: str | date, time_column: str = "event_ts") -> DataFrame:
    """Rows of one calendar day: prunes partitions where the table has them, and row groups."""
    day = date.fromisoformat(day) if isinstance(day, str) else day
    ts = F.col(time_column)
    kept = df.filter((ts >= literal(day)) & (ts < literal(day + timedelta(days=1))))
    if set(DAY_COLUMNS) <= set(df.columns):
        for name, value in zip(DAY_COLUMNS, (day.year, day.month, day.day), strict=True):
            kept = kept.filter(F.col(name) == value)
    return kept


def since(column: str | Column, as_of: datetime, **interval: float) -> Column:
    """``column`` is not older than ``interval`` before ``as_of``."""
    column = F.col(column) if isinstance(column, str) else column
    return column >= literal(as_of - timedelta(**interval))


def since_day(column: str | Column, as_of: datetime, days: int) -> Column:
    """``column`` falls on or after the calendar day ``days`` before ``as_of``."""
    column = F.col(column) if isinstance(column, str) else column
    return column >= literal(as_instant(as_of).date() - timedelta(days=days))


def newer(df: DataFrame, time_column: str, moment: datetime | date) -> DataFrame:
    """Rows not older than ``moment``; a stored day key prunes the older partitions.

    ``date_key`` always is the calendar day of the row's own time, so its bound drops no row.
    """
    kept = df.filter(F.col(time_column) >= literal(moment))
    if "date_key" in df.columns:
        day = as_instant(moment).date() if isinstance(moment, datetime) else moment
        kept = kept.filter(F.col("date_key") >= int(day.strftime("%Y%m%d")))
    return kept


def recent(df: DataFrame, time_column: str, as_of: datetime, **interval: float) -> DataFrame:
    """``since`` on a frame that may be stored by day."""
    return newer(df, time_column, as_of - timedelta(**interval))


def recent_days(df: DataFrame, time_column: str, as_of: datetime, days: int) -> DataFrame:
    """``since_day`` on a frame that may be stored by day."""
    return newer(df, time_column, as_instant(as_of).date() - timedelta(days=days))


def floor_hour(moment: datetime) -> datetime:
    return as_instant(moment).replace(minute=0, second=0, microsecond=0)


def years_before(moment: datetime, years: int) -> datetime:
    moment = as_instant(moment)
    try:
        return moment.replace(year=moment.year - years)
    except ValueError:  # 29 February
        return moment.replace(year=moment.year - years, day=28)
