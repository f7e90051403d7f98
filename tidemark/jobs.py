"""The jobs as commands: ``spark-submit tidemark/jobs.py <job> …`` or ``python -m tidemark.jobs <job> …``.

``--lake`` is a folder every executor reaches. Below it: ``bronze``, ``quarantine``, ``silver``,
``silver_stream``, ``gold``, ``warehouse``, ``marts``, ``progress`` and the log ``pipeline_runs``.
"""

from __future__ import annotations

import argparse
import warnings
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import maintenance, quality, runlog, sinks
from tidemark.plans import checks, gold, incremental, refresh, silver
from tidemark.schemas import ENTITIES, TOPICS, WAREHOUSE, topic_schema
from tidemark.session import build_session, configure
from tidemark.sources import seeds
from tidemark.sources.events import read_events
from tidemark.sources.layers import read_warehouse
from tidemark.streaming import hours, landing, topics

#: How long after its end an hour of readings closes.
LATENESS = timedelta(hours=6)
#: Seconds between two rounds of writing the runs of streams that go on into the run log.
SETTLE_SECONDS = 300
PARTITIONED = tuple(t for t in WAREHOUSE.values() if t.partition_format and t is not runlog.RUNS)


def runs_path(lake: str) -> str:
    return f"{lake}/pipeline_runs"


def topic_options(options: dict[str, str], topic: str) -> dict[str, str]:
    """Source options of one topic; ``{topic}`` in a value stands for its name."""
    return {k: v.replace("{topic}", topic) for k, v in options.items()}


def _logged_streams(spark: SparkSession, lake: str, stage: str, available_now: bool, start) -> None:
    """Run streams with their progress logged; their batches become rows of the run log while the streams go on."""
    log = runlog.ProgressLog(spark, f"{lake}/progress/{stage}")

    def settle() -> None:
        runlog.settle_streams(spark, runs_path(lake), log.path, stage)

    def settle_meanwhile() -> None:
        try:
            settle()
        except Exception as error:  # the streams go on; the next round does what this one did not
            warnings.warn(f"runs of {stage} are not in the run log yet: {error}", stacklevel=2)

    spark.streams.addListener(log)
    started: list[StreamingQuery] = []
    try:
        started += start()
        for query in started:
            while available_now and not query.awaitTermination(SETTLE_SECONDS):
                settle_meanwhile()
        while not available_now and not spark.streams.awaitAnyTermination(SETTLE_SECONDS):
            settle_meanwhile()
    finally:
        for query in started:
            if query.isActive:
                query.stop()
            log.wait(query)
        spark.streams.removeListener(log)
        settle()


def land(spark: SparkSession, lake: str, options: dict[str, str], available_now: bool) -> None:
    """Every topic to raw files, what is wrong with messages to the quarantine."""
    _logged_streams(spark, lake, "bronze", available_now, lambda: [
        landing.land_bronze(read_events(spark, topic, topic_options(options, topic)), topic, f"{lake}/bronze",
                            f"{lake}/checkpoints/bronze/{topic}", available_now, bad_root=f"{lake}/quarantine")
        for topic in TOPICS
    ])


def stream(spark: SparkSession, lake: str, options: dict[str, str], available_now: bool) -> None:
    """Every topic to typed tables, next to (not inside) the batch silver layer; ``gather`` moves them there."""
    _logged_streams(spark, lake, "silver", available_now, lambda: [
        topics.stream_topic(spark, topic, f"{lake}/silver_stream", topic_options(options, topic), available_now)
        for topic in TOPICS
    ])


def stream_hours(spark: SparkSession, lake: str, options: dict[str, str], available_now: bool) -> None:
    """Sensor readings to hourly averages; readings of closed hours are kept for ``fold``."""
    readings = topics.typed_stream(read_events(spark, "sensors", topic_options(options, "sensors")), topic_schema("sensors"))
    _logged_streams(spark, lake, "hours", available_now, lambda: [
        hours.hourly_with_late(readings, f"{lake}/hours", f"{lake}/checkpoints/hours", LATENESS, available_now=available_now)])


def gather(spark: SparkSession, lake: str) -> None:
    for table in ENTITIES:
        topics.gather_streamed(spark, f"{lake}/silver_stream", f"{lake}/silver", table)


def init(spark: SparkSession, lake: str) -> None:
    """Store the two fixed dimensions and declare the warehouse tables; what is there stays."""
    for name, rows in (("dim_date", seeds.date_dimension(spark)), ("dim_sensor_location", seeds.seed_sensor_locations(spark))):
        if not sinks.path_exists(spark, f"{lake}/warehouse/{name}"):
            sinks.load_dim(rows.coalesce(1), f"{lake}/warehouse", name)
    for table in WAREHOUSE.values():
        parts = table.partitions if table.partition_format else ()
        location = runs_path(lake) if table is runlog.RUNS else f"{lake}/warehouse/{table.name}"
        sinks.ensure_table(spark, table.name, table.stored_schema if parts else table.schema, parts, location)


def rebuild_marts(spark: SparkSession, lake: str, run: runlog.Run) -> None:
    """Check the loaded facts, then compute the changed days of the three marts; a failed check fails the job."""
    quality.require_passed(checks.run_checks_by_day(spark, f"{lake}/warehouse", f"{lake}/checks"))
    for name in incremental.MARTS:
        incremental.refresh_mart(spark, name, f"{lake}/warehouse", f"{lake}/marts", run.writing)


def refresh_aggregates(spark: SparkSession, lake: str, as_of: datetime) -> None:
    """Only the slices of the window are listed and read."""
    since = {"fact_sales": refresh.day_cutoff(as_of), "fact_trades": refresh.day_cutoff(as_of),
             "fact_sensor_readings": refresh.hour_cutoff(as_of), "dim_customer": None, "dim_product": None}
    facts = {name: read_warehouse(spark, f"{lake}/warehouse", name, start) for name, start in since.items()}
    refresh.refresh_aggregates(spark, facts, f"{lake}/warehouse", as_of)


def optimize(spark: SparkSession, lake: str) -> None:
    """Rewrite slices of many files in place; aggregates are collapsed on the way."""
    for table in PARTITIONED:
        maintenance.optimize_table(spark, f"{lake}/warehouse", table)
    # Runs that end now are added to today's slice, some that began to end yesterday may still be.
    yesterday = datetime.now(timezone.utc) - timedelta(days=1)
    maintenance.optimize_table(spark, lake, runlog.RUNS, before=sinks.slice_key(yesterday, runlog.RUNS))


def expire(spark: SparkSession, lake: str, as_of: datetime) -> None:
    """Remove raw days, fact days and log days past their time."""
    maintenance.expire_bronze(spark, f"{lake}/bronze", as_of)
    for table in PARTITIONED:
        maintenance.expire_table(spark, f"{lake}/warehouse", table, as_of)


def key_values(pairs: Sequence[str]) -> dict[str, str]:
    return dict(p.split("=", 1) for p in pairs)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tidemark")
    jobs = out.add_subparsers(dest="job", required=True)

    def job(name: str, help_text: str, day: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help_text)
        sub.add_argument("--lake", required=True)
        if day:
            today = datetime.now(timezone.utc).date()
            sub.add_argument("--date", type=date.fromisoformat, default=today)
        return sub

    for name, text in (("land", "topics to raw files"), ("stream", "topics to typed tables"),
                       ("hours", "sensor readings to hourly averages")):
        sub = job(name, text)
        sub.add_argument("--option", action="append", default=[], help="source option key=value")
        sub.add_argument("--available-now", action="store_true", help="work off what is there and stop")
    job("silver", "one raw day to typed tables", day=True).add_argument("--topic", choices=TOPICS, required=True)
    job("gold", "one event day to facts, all dimensions", day=True)
    job("load", "one day of gold to the warehouse, all dimensions", day=True)
    job("marts", "check the facts, compute the changed days of the marts")
    job("refresh", "rebuild the newest days and hours of the aggregates").add_argument(
        "--as-of", type=datetime.fromisoformat, default=datetime.now(timezone.utc))
    job("gather", "streamed batches into the silver tables")
    job("fold", "late readings into the hours they belong to")
    job("init", "fixed dimensions and table declarations")
    job("optimize", "rewrite slices of many files")
    job("expire", "remove raw days, facts and log rows past their time").add_argument(
        "--as-of", type=datetime.fromisoformat, default=datetime.now(timezone.utc))
    return out


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = configure(spark) if spark else build_session(f"tidemark-{args.job}")
    lake = args.lake.rstrip("/")
    if args.job in STREAMS:  # every micro-batch is a run of its own
        STREAMS[args.job](spark, lake, key_values(args.option), args.available_now)
        return
    with runlog.logged_run(spark, runs_path(lake), args.job, STAGE_OF[args.job]) as run:
        if args.job == "silver":
            silver.bronze_to_silver(spark, f"{lake}/bronze", f"{lake}/silver", args.topic, args.date, run.writing)
        elif args.job == "gold":
            gold.silver_to_gold(spark, f"{lake}/silver", f"{lake}/gold", args.date, f"{lake}/silver_stream", run.writing)
        elif args.job == "load":
            key = int(args.date.strftime("%Y%m%d"))
            gold.gold_to_warehouse(spark, f"{lake}/gold", f"{lake}/warehouse", key, run.writing)
        elif args.job == "marts":
            rebuild_marts(spark, lake, run)
        elif args.job == "refresh":
            refresh_aggregates(spark, lake, args.as_of)
        elif args.job == "gather":
            gather(spark, lake)
        elif args.job == "fold":
            hours.fold_late(spark, f"{lake}/hours", f"{lake}/checkpoints/hours")
        elif args.job == "init":
            init(spark, lake)
        elif args.job == "optimize":
            optimize(spark, lake)
        elif args.job == "expire":
            expire(spark, lake, args.as_of)


STREAMS = {"land": land, "stream": stream, "hours": stream_hours}
STAGE_OF = {"silver": "silver", "gather": "silver", "fold": "hours", "gold": "gold", "load": "warehouse", "init": "warehouse",
            "optimize": "warehouse", "expire": "warehouse", "marts": "marts", "refresh": "marts"}


if __name__ == "__main__":
    main()
