"""Repeatable surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*columns: str | Column) -> Column:
    """md5 of the business key: the same row gets the same key in every run."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("-", *[p.cast("string") for p in parts]))
