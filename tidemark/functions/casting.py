"""From raw strings to declared types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The raw layer's spellings of "no value".
NO_VALUE = ("", "None")


def blank_to_null(column: Column) -> Column:
    """NULL for the spellings of "no value"; any other text is left as it is."""
    return F.when(~F.trim(column).isin(*NO_VALUE), column)


def to_type(column: Column, data_type: T.DataType) -> Column:
    """Cast raw text; what cannot be read becomes NULL instead of failing the job."""
    cleaned = blank_to_null(column)
    if isinstance(data_type, T.StringType):
        return cleaned
    text = F.trim(cleaned)
    if isinstance(data_type, (T.IntegerType, T.LongType)):
        # "5.0" is a whole number too.
        return F.coalesce(text.try_cast(data_type),
                          text.try_cast("decimal(38,6)").try_cast(data_type))
    return text.try_cast(data_type)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: matched in any letter case, missing ones NULL, others dropped."""
    present: dict[str, str] = {}
    for name in df.columns:
        if present.get(name.lower()) not in schema.names:
            present[name.lower()] = name

    def typed(target: T.StructField) -> Column:
        source = present.get(target.name.lower())
        if source is None:
            value = F.lit(None).cast(target.dataType)
        elif isinstance(df.schema[source].dataType, T.StringType):
            value = to_type(F.col(f"`{source}`"), target.dataType)
        else:
            value = F.col(f"`{source}`").try_cast(target.dataType)
        return value.alias(target.name)

    return df.select([typed(f) for f in schema.fields])


def project_to(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Select the target columns by name; columns absent from ``df`` take their default or NULL."""
    defaults = defaults or {}
    present = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in present else defaults.get(f.name, F.lit(None)))
        .cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def normalise_event_time(df: DataFrame, candidates: Sequence[str] = ("event_ts", "created_at")) -> DataFrame:
    """One time column: the first candidate that holds a value, called event_ts."""
    present = [c for c in candidates if c in df.columns]
    kept = [c for c in df.columns if c not in present]
    return df.select(*kept, F.coalesce(*[F.col(c) for c in present]).alias("event_ts"))
