"""Run log, stream progress and layer statistics."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.operators import progress
from tidemark.operators.sinks import append_log, observed, slice_folders, slice_of, write_text
from tidemark.schemas import WAREHOUSE

RUNS = WAREHOUSE["pipeline_runs"]


class Run:
    """Counts the rows that a run reads and writes while the run's own jobs pass over them."""

    def __init__(self):
        self.row: dict = {}
        self._seen: dict[str, list[Observation]] = {"rows_read": [], "rows_written": []}

    def _counted(self, df: DataFrame, what: str) -> DataFrame:
        observation = Observation()
        self._seen[what].append(observation)
        return df.observe(observation, F.count(F.lit(1)).alias("rows"))

    def reading(self, df: DataFrame) -> DataFrame:
        return self._counted(df, "rows_read")

    def writing(self, df: DataFrame) -> DataFrame:
        return self._counted(df, "rows_written")

    def counts(self, seconds: float) -> dict[str, int]:
        """Sums of what was counted. Raises if a counted frame was never computed."""
        return {what: sum(observed(o, "rows", seconds) or 0 for o in seen) for what, seen in self._seen.items()}


@contextmanager
def logged_run(spark: SparkSession, log_path: str, job: str, stage: str, seconds: float = 30) -> Iterator[Run]:
    """Log one run of a job: rows, times and outcome; an error is logged and raised again."""
    run = Run()
    row = {"run_id": str(uuid.uuid4()), "dag_id": job, "stage": stage, "status": "running",
           "rows_read": 0, "rows_written": 0, "started_at": datetime.now(timezone.utc),
           "finished_at": None, "error_msg": None, "_loaded_at": None}
    run.row = row
    try:
        yield run
        row.update(status="success", **run.counts(seconds))
    except Exception as error:
        row.update(status="failed", error_msg=str(error))
        raise
    finally:
        row["finished_at"] = row["_loaded_at"] = datetime.now(timezone.utc)
        append_log(spark.createDataFrame([row], RUNS.schema), log_path, RUNS)


def record_run(spark: SparkSession, log_path: str, job: str, stage: str, source: DataFrame,
               transform: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame], object],
               seconds: float = 30) -> dict:
    """Run source → transform → sink as a ``logged_run``: no second pass to count. Returns the logged row."""
    with logged_run(spark, log_path, job, stage, seconds) as run:
        sink(run.writing(transform(run.reading(source))))
    return run.row


class ProgressLog(StreamingQueryListener):
    """Writes every progress event of every stream to a folder when it happens (see ``progress``).

    Spark itself remembers a bounded number of events. An event owns the file named by its stream, run and
    batch, so one that is reported twice is there once. An event that cannot be written is kept and tried
    again with the next one, and ``tries`` times when the stream ends. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str, tries: int = 5, pause: float = 1.0):
        self.spark, self.path, self.tries, self.pause = spark, path, tries, pause
        self._ended: dict[str, threading.Event] = {}
        self._unwritten: dict[str, str] = {}
        self._error: Exception | None = None

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(run_id, threading.Event())

    def _write(self) -> bool:
        """Write what is still to be written, oldest first; Spark would drop an error raised here."""
        try:
            for file, text in list(self._unwritten.items()):
                write_text(self.spark, file, text)
                del self._unwritten[file]
        except Exception as error:
            self._error = error
        return not self._unwritten

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        batch = json.loads(event.progress.json)
        row = {
            "name": batch.get("name"), "run_id": batch["runId"], "batch_id": batch["batchId"], "started_at": batch["timestamp"],
            "milliseconds": batch["durationMs"].get("triggerExecution", 0),
            "rows_read": sum(s["numInputRows"] for s in batch["sources"]),
            "rows_written": max(0, batch["sink"].get("numOutputRows", 0)),
            "sources": [{"source": s["description"], "start_offset": _text(s.get("startOffset")),
                         "end_offset": _text(s.get("endOffset")), "rows": s["numInputRows"]} for s in batch["sources"]],
        }
        self._unwritten[progress.event_file(self.path, row)] = json.dumps(row) + "\n"
        self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        for attempt in range(self.tries):
            if self._write():
                break
            time.sleep(self.pause * 2 ** attempt)
        self._end(str(event.runId)).set()

    def wait(self, query: StreamingQuery, seconds: float = 90) -> None:
        """Until all events of a stream that has ended are written; they come in order, its end last."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError(f"the end of stream {query.name} was not reported")
        if self._unwritten:
            raise OSError(f"{len(self._unwritten)} progress events could not be written to {self.path}") from self._error


def _text(offset: object) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset)


def topic_progress(spark: SparkSession, path: str) -> DataFrame:
    """Batches of every logged stream: rows taken and the offsets reached, per source."""
    return progress.read_progress(spark, path).select("name", "run_id", "batch_id", F.explode("sources").alias("s")).select(
        "name", "run_id", "batch_id", "s.source", "s.start_offset", "s.end_offset", F.col("s.rows").alias("num_input_rows"))


def record_stream_runs(spark: SparkSession, log_path: str, progress_path: str, stage: str) -> None:
    """Add micro-batches to the run log as runs; those it already has are left out. Streams may go on meanwhile.

    Looks at the events that are not folded away yet, and at the slices of the run log from the day of the
    oldest of them on. ``rows_written`` is zero where the sink does not count (files, foreachBatch).
    """
    days = progress.tail_days(spark, progress_path)
    if not days:
        return
    seconds = F.col("milliseconds") / 1000
    batches = progress.read_tail(spark, progress_path).select(
        F.concat_ws("-", "run_id", "batch_id").alias("run_id"), F.col("name").alias("dag_id"), F.lit(stage).alias("stage"),
        F.lit("success").alias("status"), "rows_read", "rows_written", "started_at",
        (F.col("started_at") + F.make_dt_interval(secs=seconds)).alias("finished_at"), F.current_timestamp().alias("_loaded_at"))
    logged = [f for f in slice_folders(spark, log_path, RUNS) if slice_of(f) >= min(days)]
    if logged:
        batches = batches.join(spark.read.schema(RUNS.schema).parquet(*logged).select("run_id"), "run_id", "left_anti")
    append_log(batches.hint("rebalance"), log_path, RUNS)


def settle_streams(spark: SparkSession, log_path: str, progress_path: str, stage: str) -> None:
    """Runs of the events that came since the last call into the run log, then fold the events.

    In this order: an event leaves the tail only after its run is logged. May be repeated at any time.
    """
    record_stream_runs(spark, log_path, progress_path, stage)
    progress.fold_progress(spark, progress_path)


def layer_stats(spark: SparkSession, root: str) -> DataFrame:
    """Files and bytes per source of a layer; contents are not read."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root).select("path", "length"))
    named = F.regexp_extract("path", r"source=([^/]+)", 1)
    return (files.groupBy(F.when(named != "", named).otherwise("other").alias("source"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size_bytes")))


def layer_total(stats: DataFrame) -> DataFrame:
    return stats.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("total_files"),
        F.round(F.coalesce(F.sum("size_bytes"), F.lit(0)) / (1024 * 1024), 2).alias("total_size_mb"))
