"""Event topics: one JSON object per message."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
BROKER_COLUMNS = ("_kafka_ts", "offset", "partition")

# A backlog is worked off in bounded steps instead of one endless first batch.
TOPIC_DEFAULTS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
    "maxOffsetsPerTrigger": "50000000",
}
FILE_DEFAULTS = {"maxFilesPerTrigger": "1000"}


def read_events(spark: SparkSession, topic: str, options: dict[str, str] | None = None) -> DataFrame:
    """Subscribe to a topic: columns ``value``, ``_kafka_ts``, ``offset``, ``partition``.

    ``options["format"]`` names the source. ``kafka`` is the default; ``text``
    reads a folder of JSON lines (``options["path"]``) and has no offsets.
    """
    options = dict(options or {})
    source = options.pop("format", "kafka")
    if source == "kafka":
        stream = (spark.readStream.format("kafka")
                  .options(**{**TOPIC_DEFAULTS, "subscribe": topic, **options}).load())
        return stream.select(
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("_kafka_ts"), "offset", "partition",
        )
    path = options.pop("path")
    stream = (spark.readStream.format(source)
              .options(**{**FILE_DEFAULTS, **options}).load(path))
    return stream.select(
        "value",
        F.col("_metadata.file_modification_time").alias("_kafka_ts"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit(None).cast("int").alias("partition"),
    )


def parse_events(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (),
                 corrupt: bool = False) -> DataFrame:
    """JSON text to typed columns; unreadable fields are NULL.

    ``corrupt=True`` adds the text of lines with an unreadable part as ``_corrupt_record``.
    """
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value"), wanted, {"columnNameOfCorruptRecord": CORRUPT})
    df = df.select(parsed.alias("_event"), *keep).select("_event.*", *keep)
    return df if corrupt else df.drop(CORRUPT)


def raw_fields(value: Column) -> Column:
    """A JSON object as map<string,string>: every key is kept, values as written."""
    return F.from_json(value, T.MapType(T.StringType(), T.StringType()))
