"""Topics to typed tables: the columns of the batch silver layer, one folder for each micro-batch."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import types as T

from tidemark.functions.casting import normalise_event_time, project_to
from tidemark.functions.dates import day_columns
from tidemark.operators.filters import of_type, present
from tidemark.operators.sinks import (
    complete,
    file_names,
    move_folder,
    partition_folders,
    path_exists,
    read_text,
    remove_folder,
    replace_folder,
    write_silver,
    write_text,
)
from tidemark.schemas import ENTITIES, TOPICS, Entity, topic_entities, topic_schema
from tidemark.sources.events import parse_events, read_events
from tidemark.streaming.settings import writer


def typed_stream(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Parsed events with one time column and the time of processing."""
    return normalise_event_time(parse_events(raw, schema)).withColumn("_processed_at", F.current_timestamp())


def take_entity(events: DataFrame, entity: Entity) -> DataFrame:
    """The entity's own events out of a topic, with the columns of its silver table.

    Events need a time; customers and products need their key instead, they are not stored by day.
    """
    own = of_type(events, entity.event_type) if entity.event_type else events
    own = present(own, entity.key if entity.dimension else "event_ts")
    return project_to(day_columns(own), entity.silver_schema)


def batch_name(topic: str, batch_id: int) -> str:
    return f"stream_{topic}_{batch_id:09d}"


def write_batch_part(rows: DataFrame, path: str, name: str) -> None:
    """One micro-batch in a folder of its own: a replayed batch replaces itself.

    Rows are gathered into files of the advisory size whatever days they belong to, so the number of files
    follows the amount of data.
    """
    replace_folder(rows.drop("_batch_id").hint("rebalance"), f"{path}/_batch_id={name}")


def route_stream(events: DataFrame, entities: Sequence[Entity], root: str, name: str, checkpoint: str, topic: str,
                 available_now: bool = False) -> StreamingQuery:
    """One read of a topic into one table for each entity."""
    def write_tables(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # parsed once for all tables; spills to disk
        try:
            for entity in entities:
                write_batch_part(take_entity(batch, entity), f"{root}/{entity.name}", batch_name(topic, batch_id))
        finally:
            batch.unpersist()

    return writer(events, name, checkpoint, available_now).foreachBatch(write_tables).start()


def append_stream(events: DataFrame, entity: Entity, root: str, name: str, checkpoint: str,
                  available_now: bool = False) -> StreamingQuery:
    """A topic of one kind into its table."""
    def write_table(batch: DataFrame, batch_id: int) -> None:
        write_batch_part(take_entity(batch, entity), f"{root}/{entity.name}", batch_name(entity.topic, batch_id))

    return writer(events, name, checkpoint, available_now).foreachBatch(write_table).start()


def stream_topic(spark: SparkSession, topic: str, silver_root: str, options: Mapping[str, str],
                 available_now: bool = False) -> StreamingQuery:
    """A topic to its typed tables; trades leave the transfers of their topic out, as the batch job does."""
    events = typed_stream(read_events(spark, topic, dict(options)), topic_schema(topic))
    entities, name, checkpoint = topic_entities(topic), f"silver_{topic}", f"{silver_root}/_checkpoints/{topic}"
    if len(entities) > 1:
        return route_stream(events, entities, silver_root, name, checkpoint, topic, available_now)
    return append_stream(events, entities[0], silver_root, name, checkpoint, available_now)


def stream_transactions(spark: SparkSession, silver_root: str, options: Mapping[str, str],
                        available_now: bool = False) -> StreamingQuery:
    return stream_topic(spark, "transactions", silver_root, options, available_now)


def run_all(spark: SparkSession, silver_root: str, options: Mapping[str, Mapping[str, str]],
            available_now: bool = False) -> list[StreamingQuery]:
    """Start every topic. Waits; if one stream fails, the others are stopped and its error is raised."""
    started: list[StreamingQuery] = []
    try:
        started += [stream_topic(spark, t, silver_root, options[t], available_now) for t in TOPICS]
        if available_now:
            for query in started:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
    finally:
        for query in started:
            if query.isActive:
                query.stop()
    return started


_GATHERED, _MARKS = ".gathered-", "_gathered"
#: Micro-batches for which the mark of their gathering is kept; a checkpoint keeps 100.
MARKS_KEPT = 1000


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that a stream has committed and will not write again; -1 before the first."""
    done = [n for n in file_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(map(int, done), default=-1)


def _stream_of(spark: SparkSession, checkpoint: str) -> str:
    """What tells a stream from one that began again with an empty checkpoint."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"][:8]


def _ready(spark: SparkSession, path: str, last: int) -> list[str]:
    """Folders of batches that are whole (their job has committed) and final (their stream has)."""
    return [f for f in partition_folders(spark, path, "_batch_id=stream_*")
            if int(f.rsplit("_", 1)[1]) <= last and complete(spark, f)]


def gather_streamed(spark: SparkSession, stream_root: str, silver_root: str, table: str,
                    checkpoint: str | None = None) -> str | None:
    """Move the micro-batches that a stream has committed into the silver table, as one batch; returns its name.

    May run beside the stream. Taken are folders whose writing job has ended and whose batch stands in the
    commit log of the stream's checkpoint: one that is being written, or may be written again, stays. Each
    taken batch leaves a mark, by which the next gathering knows a replay of it (from a checkpoint set back)
    and drops it; until then its rows are in both places, which is one row in gold. Many small batches become files by event day; the batch is
    named by its stream and last micro-batch. The gathered folders are first renamed to names that readers pass
    over, then removed; a run that dies before the renaming is repeated whole, and rows that are in both places
    are one row in gold.
    """
    path, entity = f"{stream_root}/{table}", ENTITIES[table]
    checkpoint = checkpoint or f"{stream_root}/_checkpoints/{entity.topic}"
    last = last_committed(spark, checkpoint)
    if last < 0 or not path_exists(spark, path):
        return None
    stream, ready = _stream_of(spark, checkpoint), _ready(spark, path, last)
    gathered = set(file_names(spark, f"{path}/{_MARKS}"))
    folders = []
    for folder in ready:
        if f"{stream}-{folder.rsplit('=', 1)[1]}" in gathered:
            remove_folder(spark, folder)  # a replay: its rows are in silver
        else:
            folders.append(folder)
    if not folders:
        return None
    name = f"{folders[-1].rsplit('=', 1)[1]}_{stream}_gathered"
    rows = spark.read.schema(entity.silver_schema).option("basePath", path).parquet(*folders)
    write_silver(present(rows, entity.key if entity.dimension else "event_ts"), silver_root, table, name)
    for folder in folders:
        batch = folder.rsplit("=", 1)[1]
        write_text(spark, f"{path}/{_MARKS}/{stream}-{batch}", "")
        aside = f"{path}/{_GATHERED}{batch}"
        move_folder(spark, folder, aside)
        remove_folder(spark, aside)
    _forget_marks(spark, path, stream, last)
    return name


def _forget_marks(spark: SparkSession, path: str, stream: str, last: int) -> None:
    """Streams go back by the batches their checkpoint keeps at most; marks of older batches are removed."""
    for name in file_names(spark, f"{path}/{_MARKS}"):
        if name.startswith(f"{stream}-") and int(name.rsplit("_", 1)[1]) < last - MARKS_KEPT:
            remove_folder(spark, f"{path}/{_MARKS}/{name}")
