"""Writers. Each one replaces exactly the partitions it owns, so a repeated run changes nothing."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import project_to
from tidemark.functions.dates import as_instant, literal
from tidemark.schemas import DAY_COLUMNS, ENTITIES, WAREHOUSE, Table


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _file_system(spark, path)
    return fs.exists(hadoop)


def partition_folders(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Partition folders below ``root``; folder names only, files are not listed."""
    hadoop, fs = _file_system(spark, f"{root}/{pattern}")
    return sorted(s.getPath().toString() for s in fs.globStatus(hadoop) or [] if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop, fs = _file_system(spark, path)
    fs.delete(hadoop, True)


def remove_file(spark: SparkSession, *paths: str) -> None:
    """Remove files, or folders without anything in them."""
    if paths:
        _, fs = _file_system(spark, paths[0])
        for path in paths:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), False)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; the target must not exist."""
    source_path, fs = _file_system(spark, source)
    if not fs.rename(source_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, replaced whole; no Spark job."""
    hadoop, fs = _file_system(spark, path)
    out = fs.create(hadoop, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file that ``write_text`` wrote."""
    hadoop, fs = _file_system(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether the job that wrote a folder has committed."""
    return path_exists(spark, f"{folder}/_SUCCESS")


def modified(spark: SparkSession, path: str) -> int:
    hadoop, fs = _file_system(spark, path)
    return fs.getFileStatus(hadoop).getModificationTime()


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none if it is not there."""
    if not path_exists(spark, folder):
        return []
    hadoop, fs = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isFile())


def names_like(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Names in a folder that match a pattern, brought over in one text however many they are."""
    hadoop, fs = _file_system(spark, f"{folder}/{pattern}")
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(hadoop))
    text = spark._jvm.scala.Predef.genericWrapArray(found).mkString("\n") if found else ""
    return sorted(line.rsplit("/", 1)[1] for line in text.split("\n") if line)


def folder_bytes(spark: SparkSession, folder: str) -> int:
    hadoop, fs = _file_system(spark, folder)
    return fs.getContentSummary(hadoop).getLength()


def count_files(spark: SparkSession, folder: str) -> int:
    """Data files of one partition folder."""
    path, fs = _file_system(spark, folder)
    return sum(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(path))


#: Codec of events in silver and gold: keys are hashes and numbers, which snappy leaves as long as they are.
STORED = "zstd"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside remove their shuffle files at their end.

    Otherwise these stay until the driver happens to collect its garbage, and a job of many writes holds the
    shuffles of all of them on disk.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def replace_folder(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Static overwrite of one folder; also right when ``df`` is empty."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with shuffles_freed(df.sparkSession):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_silver(df: DataFrame, root: str, table: str, batch_id: str) -> str:
    """Store one batch: events under ``_year=…/_month=…/_day=…/_batch_id=…``, dimensions under ``_batch_id=…``.

    A batch is one raw day; its rows may belong to other event days. A second run of the
    batch replaces the first one, also where the first one had days that the second has not,
    and never touches rows of the same event day that another batch brought. The day stands
    outermost, so reading a day lists that day only. De-duplication left the rows hashed by
    key; REBALANCE gathers them by day (and splits a day that is too big for one task), so a
    backlog of many days does not become a file per day and task.
    """
    entity, target, spark = ENTITIES[table], f"{root}/{table}", df.sparkSession
    rows = df.drop("_batch_id")
    if entity.dimension:
        replace_folder(rows.hint("rebalance"), f"{target}/_batch_id={batch_id}")
        return target
    # A batch spans a bounded number of days, so their names fit in one set.
    days, written = F.struct(*DAY_COLUMNS), Observation()
    gathered = rows.hint("rebalance", *DAY_COLUMNS).withColumn("_batch_id", F.lit(batch_id))
    with shuffles_freed(spark):
        (gathered.observe(written, F.collect_set(days).alias("days")).write.mode("overwrite").option("compression", STORED)
         .option("partitionOverwriteMode", "dynamic").partitionBy(*entity.partitions).parquet(target))
    filled = {tuple(day) for day in observed(written, "days") or ()}
    for folder in partition_folders(spark, target, f"_year=*/_month=*/_day=*/_batch_id={batch_id}"):
        if tuple(int(p.split("=")[1]) for p in folder.split("/")[-4:-1]) not in filled:
            remove_folder(spark, folder)
    return target


def observed(observation: Observation, name: str, seconds: float = 30):
    """A metric of a job that has ended. Waits a little for it to arrive; raises if no job computed it."""
    found: list = []
    waiting = threading.Thread(target=lambda: found.append(observation.get.get(name)), daemon=True)
    waiting.start()
    waiting.join(seconds)
    if not found:
        raise RuntimeError("an observed frame was not computed: the sink ran no action")
    return found[0]


def write_gold_fact(df: DataFrame, root: str, table: str, partition_col: str = "date_key",
                    many_days: bool = False) -> str:
    """Replace the partitions ``df`` has rows for; all others stay.

    One day is written as it is read, without a shuffle. ``many_days`` gathers rows
    by day first; use it for a rebuild from rows that are not stored by day.
    """
    target = f"{root}/{table}"
    if many_days:
        df = df.hint("rebalance", partition_col)
    with shuffles_freed(df.sparkSession):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", STORED)
         .partitionBy(partition_col).parquet(target))
    return target


def write_gold_dim(df: DataFrame, root: str, table: str) -> str:
    """Full replace."""
    target = f"{root}/{table}"
    replace_folder(df, target)
    return target


def stored_layout(df: DataFrame, table: Table) -> DataFrame:
    """Rows with the partition columns of a warehouse table, in the order of its sort key."""
    time = F.col(table.time_column)
    placed = df.withColumn("_p", F.date_format(time, table.partition_format).cast("int"))
    if table.slice_format:
        placed = placed.withColumn("_s", F.date_format(time, table.slice_format).cast("int"))
    return placed.sortWithinPartitions(*table.partitions, *table.order_by)


def load_fact(df: DataFrame, root: str, table: str, date_key: int) -> str:
    """Replace one date_key of a warehouse fact, also by nothing; columns go by name.

    The day stands in its month (or day) partition, its rows in the order of the declared key.
    """
    spec, target = WAREHOUSE[table], f"{root}/{table}"
    rows = df.filter(F.col("date_key") == date_key)
    rows = project_to(rows, spec.schema, {"_loaded_at": F.current_timestamp()})
    part = str(date_key)[:len(spec.partition_format)]
    rows = rows.drop("date_key").sortWithinPartitions(*[c for c in spec.order_by if c != "date_key"])
    spark, written = df.sparkSession, Observation()
    # A day has no mark while it is written: what a run that died has left is seen as changed.
    unmark_day(spark, target, date_key)
    replace_folder(rows.observe(written, *day_fingerprint(spec)), f"{target}/_p={part}/date_key={date_key}")
    mark_day(spark, target, date_key, [observed(written, n) for n in FINGERPRINT])
    return target


FINGERPRINT = ("n_rows", "xor_of_rows", "sum_of_rows")


def day_fingerprint(table: Table) -> list[Column]:
    """Aggregates that tell two contents of a day apart, whatever the order of rows and files.

    Number of rows, and two sums of hashes of a row's columns but the audit ones; repeated rows cancel in the
    first sum, not in the second.
    """
    columns = [c for c in table.schema.names if c not in ("date_key", "_loaded_at", "_batch_id")]
    return [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bit_xor(F.xxhash64(*columns)), F.lit(0)).alias("xor_of_rows"),
            F.coalesce(F.sum(F.pmod(F.xxhash64(F.lit("sum"), *columns), F.lit(1 << 31))), F.lit(0)).alias("sum_of_rows")]


def mark_text(fingerprint: Sequence[int]) -> str:
    return ".".join(f"{x & (1 << 64) - 1:x}" for x in fingerprint)


_UNKNOWN = "unknown"


def mark_day(spark: SparkSession, path: str, date_key: int, fingerprint: Sequence[int]) -> None:
    """The fingerprint of a stored day as the name of an empty file, in place of the one it had."""
    _set_mark(spark, path, date_key, mark_text(fingerprint))


def unmark_day(spark: SparkSession, path: str, date_key: int) -> None:
    """What a day holds is unknown until it is marked again."""
    _set_mark(spark, path, date_key, _UNKNOWN)


def _set_mark(spark: SparkSession, path: str, date_key: int, mark: str) -> None:
    others = [n for n in file_names(spark, f"{path}/_marks") if n.startswith(f"{date_key}.") and n != f"{date_key}.{mark}"]
    write_text(spark, f"{path}/_marks/{date_key}.{mark}", "")
    for name in others:
        remove_folder(spark, f"{path}/_marks/{name}")


def mark_days(spark: SparkSession, path: str, marks: Mapping[int, str]) -> None:
    """Marks of many days in one file; days that are marked on their own later count by that."""
    staged = f"{path}/_marks/.{uuid.uuid4().hex}"
    write_text(spark, staged, json.dumps(marks))
    for old in [n for n in file_names(spark, f"{path}/_marks") if n.startswith("all-")]:
        remove_folder(spark, f"{path}/_marks/{old}")
    move_folder(spark, staged, f"{path}/_marks/all-{uuid.uuid4().hex}")
    for name in file_names(spark, f"{path}/_marks"):
        if name.split(".", 1)[0] in map(str, marks) and name.endswith(f".{_UNKNOWN}"):
            remove_folder(spark, f"{path}/_marks/{name}")


def day_marks(spark: SparkSession, path: str) -> dict[int, str]:
    """Marks of the stored days: one listing, and one file. A day with an unknown mark has none."""
    names = file_names(spark, f"{path}/_marks")
    found: dict[int, str] = {}
    for name in names:
        if name.startswith("all-"):
            found |= {int(day): mark for day, mark in json.loads(read_text(spark, f"{path}/_marks/{name}")).items()}
    own = [n.split(".", 1) for n in names if n[:1].isdigit()]
    found |= {int(day): mark for day, mark in own}
    for day, mark in own:
        if mark == _UNKNOWN:
            found.pop(int(day), None)
    return found


def load_dim(df: DataFrame, root: str, table: str) -> str:
    """Replace a warehouse dimension; columns go by name."""
    rows = project_to(df, WAREHOUSE[table].schema, {"_loaded_at": F.current_timestamp()})
    return write_gold_dim(rows, root, table)


def rebuild_window(current: DataFrame, fresh: DataFrame, time_col: str, cutoff: datetime | date) -> DataFrame:
    """Rows before the cut-off as they are, everything from it on freshly computed."""
    kept = current.filter(F.col(time_col) < literal(cutoff))
    return kept.unionByName(project_to(fresh, current.schema))


def write_window(spark: SparkSession, fresh: DataFrame, root: str, table: Table, cutoff: datetime | date) -> str:
    """``rebuild_window`` on a stored aggregate: the slices (days or hours) from the cut-off on are replaced.

    The cut-off is the edge of a slice, so nothing that stays is read or written. A slice
    of the window that has no rows any more is removed. A run that dies between removing
    old slices and moving new ones in place loses only what the next run computes again.
    """
    path, first = f"{root}/{table.name}", slice_key(cutoff, table)
    rows = project_to(fresh, table.schema, {"_computed_at": F.current_timestamp()})
    rows = rows.filter(F.col(table.time_column) >= literal(cutoff))
    # The window spans a bounded number of slices, so their names fit in one set.
    written = Observation()
    out = stored_layout(rows, table).observe(written, F.collect_set(table.slice_column).alias("slices"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*table.partitions).parquet(path))
    filled = set(observed(written, "slices") or ())
    for folder in slice_folders(spark, path, table):
        if first <= slice_of(folder) and slice_of(folder) not in filled:
            remove_folder(spark, folder)
    return path


def slice_key(moment: datetime | date, table: Table) -> int:
    """The slice that holds a moment; as a key, it compares with the keys of other slices."""
    pattern = {"yyyyMMdd": "%Y%m%d", "yyyyMMddHH": "%Y%m%d%H"}[table.slice_format or "yyyyMMdd"]
    return int((as_instant(moment) if isinstance(moment, datetime) else moment).strftime(pattern))


def slice_folders(spark: SparkSession, path: str, table: Table) -> list[str]:
    return partition_folders(spark, path, f"_p=*/{table.slice_column}=*") if path_exists(spark, path) else []


def slice_of(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: tuple[str, ...] = (), location: str | None = None) -> None:
    """Create the table if it does not exist; an existing one is left alone."""
    if spark.catalog.tableExists(name):
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location:
        statement += f" LOCATION '{location}'"
    spark.sql(statement)


def materialize(df: DataFrame, name: str, kind: str, location: str | None = None) -> DataFrame:
    """A model as a view (computed when read) or as a stored table."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        if location:
            writer = writer.option("path", location)
        writer.saveAsTable(name)
    else:
        raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
    return spark.table(name)


def append_log(df: DataFrame, path: str, table: Table) -> str:
    """Add rows to a log table; columns go by name. A log with a time to live is stored by day."""
    rows = project_to(df, table.schema)
    if table.partition_format:
        stored_layout(rows, table).write.mode("append").partitionBy(*table.partitions).parquet(path)
    else:
        rows.write.mode("append").parquet(path)
    return path
