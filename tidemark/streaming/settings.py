"""Triggers and checkpoints shared by all streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

INTERVAL = "30 seconds"  # fixed value: length of a micro-batch


def writer(stream: DataFrame, name: str, checkpoint: str, available_now: bool = False) -> DataStreamWriter:
    """A writer with checkpoint and trigger; ``available_now`` works off what is there and stops."""
    out = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return out.trigger(availableNow=True) if available_now else out.trigger(processingTime=INTERVAL)


def drain(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``available_now`` query; its failure is raised here."""
    query.awaitTermination()
    return query
