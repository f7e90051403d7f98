"""Progress events of streams: one small file each while they are new, folded into one table a day.

Below a folder stand ``tail/day=…/<run>-<batch>.json``, an event each, and ``folded/day=…/v=…``, versions of a
day's events as Parquet. The newest version that is complete counts, together with the tail. Whatever stands
in both counts once, so a fold that dies can be repeated at any point.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sinks import (
    names_like,
    partition_folders,
    path_exists,
    read_text,
    remove_file,
    remove_folder,
    replace_folder,
    slice_of,
    write_text,
)

PROGRESS_DDL = ("name string, run_id string, batch_id bigint, started_at timestamp, milliseconds bigint, "
                "rows_read bigint, rows_written bigint, "
                "sources array<struct<source:string,start_offset:string,end_offset:string,rows:bigint>>")
_KEY = ["run_id", "batch_id"]
#: Written last: the files of the tail that a version took. A version without it is not complete.
_TAKEN = "_taken"


def event_file(path: str, row: dict) -> str:
    """The file of an event, by the day its batch began."""
    day = row["started_at"][:10].replace("-", "")
    return f"{path}/tail/day={day}/{row['run_id']}-{row['batch_id']}.json"


def tail_days(spark: SparkSession, path: str) -> list[int]:
    return [slice_of(f) for f in partition_folders(spark, path, "tail/day=*")]


def read_tail(spark: SparkSession, path: str) -> DataFrame:
    """Events that stand in files of their own."""
    folders = partition_folders(spark, path, "tail/day=*")
    return spark.read.schema(PROGRESS_DDL).json(folders) if folders else spark.createDataFrame([], PROGRESS_DDL)


def _versions(spark: SparkSession, path: str, day: int | str = "*") -> dict[int, list[int]]:
    """Complete versions of each day, ascending. Only folder names are looked at, at most two of them a day."""
    found: dict[int, list[int]] = {}
    for folder in partition_folders(spark, path, f"folded/day={day}/v=*"):
        if path_exists(spark, f"{folder}/{_TAKEN}"):
            found.setdefault(slice_of(folder.rsplit("/", 1)[0]), []).append(slice_of(folder))
    return {d: sorted(v) for d, v in found.items()}


def _events(spark: SparkSession, path: str, day: int) -> list[str]:
    return names_like(spark, f"{path}/tail/day={day}", "*.json")


def _taken(spark: SparkSession, path: str, day: int, versions: list[int]) -> set[str]:
    """Files of the tail that the newest version of a day took: they may be gone at any time."""
    return set(json.loads(read_text(spark, f"{path}/folded/day={day}/v={versions[-1]}/{_TAKEN}"))) if versions else set()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """All events, folded or not, once each. Of the tail, only files that no fold has taken yet are opened."""
    tail = {d: _events(spark, path, d) for d in tail_days(spark, path)}  # listed first: what is taken after this is not removed yet
    versions = _versions(spark, path)
    new = []
    for day, names in tail.items():
        taken, folder = _taken(spark, path, day, versions.get(day, [])), f"{path}/tail/day={day}"
        left = [f"{folder}/{n}" for n in names if n not in taken]
        new += [folder] if left and len(left) == len(names) else left  # a folder is listed faster than many paths
    reader = spark.read.schema(PROGRESS_DDL)
    rows = reader.json(new) if new else spark.createDataFrame([], PROGRESS_DDL)
    folders = [f"{path}/folded/day={d}/v={v[-1]}" for d, v in versions.items()]
    return reader.parquet(*folders).unionByName(rows).dropDuplicates(_KEY) if folders else rows


def fold_progress(spark: SparkSession, path: str) -> list[int]:
    """Take the new files of the tail into the next version of their day; returns the days that have a new version.

    A file is removed by the fold *after* the one that took it, as are versions but the newest: a reader that
    listed them has the time between two folds to read them. So a day ends as one version, whatever the number of
    its batches, and folds look at the days of the tail only. One fold at a time. Events may be written meanwhile:
    those that come after the listing stay for the next fold.
    """
    folded = []
    for day in tail_days(spark, path):
        tail, target = f"{path}/tail/day={day}", f"{path}/folded/day={day}"
        versions = _versions(spark, path, day).get(day, [])
        names, taken = _events(spark, path, day), _taken(spark, path, day, versions)
        remove_file(spark, *[f"{tail}/{n}" for n in names if n in taken])
        for old in versions[:-1]:
            remove_folder(spark, f"{target}/v={old}")
        new = [n for n in names if n not in taken]
        if new:
            rows = spark.read.schema(PROGRESS_DDL).json(tail)  # what has come since the listing is taken again next time
            if versions:
                rows = spark.read.schema(PROGRESS_DDL).parquet(f"{target}/v={versions[-1]}").unionByName(rows)
            following = f"{target}/v={versions[-1] + 1 if versions else 1}"
            replace_folder(rows.dropDuplicates(_KEY).hint("rebalance"), following)
            write_text(spark, f"{following}/{_TAKEN}", json.dumps(new))
            folded.append(day)
    # Days that are over and empty: removed only if nothing has come, the newest one never.
    for day in tail_days(spark, path)[:-1]:
        if not _events(spark, path, day):
            remove_file(spark, f"{path}/tail/day={day}")
    return folded
