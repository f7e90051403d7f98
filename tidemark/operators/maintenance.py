"""What a warehouse does in the background, as explicit jobs."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casting import project_to
from tidemark.functions.dates import as_instant, literal, years_before
from tidemark.operators.sinks import (
    count_files,
    folder_bytes,
    move_folder,
    partition_folders,
    path_exists,
    remove_folder,
    slice_folders,
    slice_of,
    stored_layout,
)
from tidemark.schemas import BRONZE_KEEP_DAYS, Table

#: A stored file of a fact should have about so many bytes.
FILE_BYTES = 128 << 20


def summing_compaction(df: DataFrame, keys: Sequence[str], additive: Sequence[str],
                       weighted: Mapping[str, str], flags: Sequence[str] = (),
                       ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Collapse rows with an equal sort key.

    Additive measures are summed. An average whose sum is stored is their quotient
    again (``ratios``: sum and count), so collapsing in any number of steps gives the
    same value; other averages are re-derived from their weights. Flags keep a raised
    value and every other column its largest one. Column order and types stay as they were.
    """
    ratios = ratios or {}

    def merged(field: T.StructField) -> Column:
        name, value = field.name, F.col(field.name)
        if name in additive:
            result = F.sum(value)
        elif name in ratios:
            total, count = (F.sum(c) for c in ratios[name])
            result = F.try_divide(total, count)
        elif name in weighted:
            # A count has 19 digits at most; a wider type would cost places of the average.
            weight = F.col(weighted[name]).cast("decimal(19,0)")
            if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
                value, weight = value.cast("double"), weight.cast("double")
            result = F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))
        else:
            result = F.max(value)
        return result.cast(field.dataType).alias(name)

    rest = [f for f in df.schema.fields if f.name not in keys]
    assert set(flags) <= {f.name for f in rest}
    return df.groupBy(*keys).agg(*[merged(f) for f in rest]).select(*df.columns)


def compacted(df: DataFrame, table: Table) -> DataFrame:
    """``summing_compaction`` with the roles the table declares."""
    return summing_compaction(df, table.order_by, table.additive, table.weighted, table.flags,
                              table.ratios)


def apply_retention(df: DataFrame, time_col: str, interval: Mapping[str, int], as_of: datetime) -> DataFrame:
    """Rows still inside their time to live; an empty interval keeps everything."""
    return df.filter(F.col(time_col) > literal(retention_limit(interval, as_of))) if interval else df


def retention_limit(interval: Mapping[str, int], as_of: datetime) -> datetime:
    if "years" in interval:
        return years_before(as_of, interval["years"])
    return as_instant(as_of) - timedelta(**interval)


def retained(df: DataFrame, table: Table, as_of: datetime) -> DataFrame:
    """``apply_retention`` with the period the table declares."""
    return apply_retention(df, table.time_column, table.keep, as_of) if table.keep else df


def expire_bronze(spark: SparkSession, root: str, as_of: datetime, days: int = BRONZE_KEEP_DAYS) -> list[str]:
    """Remove whole raw day folders older than ``days``; returns what was removed."""
    limit = (as_instant(as_of) - timedelta(days=days)).date()
    removed = []
    for folder in partition_folders(spark, root, "source=*/year=*/month=*/day=*"):
        parts = dict(p.split("=", 1) for p in folder.split("/") if "=" in p)
        day = datetime(int(parts["year"]), int(parts["month"]), int(parts["day"])).date()
        if day < limit:
            remove_folder(spark, folder)
            removed.append(folder)
    return removed


def compact_table(spark: SparkSession, source: str, target: str, partition_by: Sequence[str],
                  sort_by: Sequence[str] = ()) -> str:
    """Rewrite a table of many small files into a new folder with files of the advisory size.

    REBALANCE merges small partitions and splits large ones, so a partition that
    holds most of the table is written by many tasks.
    """
    df = spark.read.parquet(source)
    packed = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_by)
    packed.write.mode("errorifexists").partitionBy(*partition_by).parquet(target)
    return target


def cluster_write(df: DataFrame, path: str, partition_by: Sequence[str], sort_cols: Sequence[str]) -> str:
    """Partition by stored columns and keep rows in sort-key order inside the files.

    REBALANCE gathers the rows of a partition and splits one that is too big for a task, also if all its
    rows have one sort key; the input is computed once.
    """
    ordered = df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *sort_cols)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return path


def range_cluster(df: DataFrame, path: str, partition_by: Sequence[str], sort_cols: Sequence[str], files: int) -> str:
    """Store rows so that a filter on the first sort column opens few files: key ranges of files do not overlap.

    Spark samples the rows, chooses quantiles of (partition, key) as splitters and gives each range to a task. A
    key with more rows than a file should have is cut by the other sort columns and a hash of the row, so no
    task gets all its rows and only its own files share that key; there are fewer such keys than files. ``df``
    is read three times (once its key alone) and should be a stored table.
    """
    rest = [c for c in sort_cols if c not in partition_by]
    keys = [*partition_by, *rest[:1]]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.count()
    heavy = counts.where(F.col("_n") * files > total).withColumn("_heavy", F.lit(True)).drop("_n")
    same = [df[k].eqNullSafe(heavy[k]) for k in keys]
    marked = df.join(F.broadcast(heavy), same, "left").select(df["*"], "_heavy")
    cuts = [F.when(F.col("_heavy"), F.col(c)) for c in rest[1:]] + [F.when(F.col("_heavy"), F.xxhash64(*df.columns))]
    ranged = marked.withColumns({f"_cut{i}": c for i, c in enumerate(cuts)}).repartitionByRange(
        max(1, files), *keys, *[f"_cut{i}" for i in range(len(cuts))])
    ordered = ranged.select(df.columns).sortWithinPartitions(*partition_by, *rest)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return path


def store_table(df: DataFrame, root: str, table: Table) -> str:
    """A whole warehouse table with the partitions and order that it declares."""
    placed = stored_layout(project_to(df, table.schema, {"_loaded_at": F.current_timestamp()}), table)
    return cluster_write(placed, f"{root}/{table.name}", table.partitions, table.order_by)


def expire_table(spark: SparkSession, root: str, table: Table, as_of: datetime) -> list[str]:
    """Remove the slices of a stored table whose time to live has passed whole; returns what was removed."""
    if not table.keep:
        return []
    limit = int(retention_limit(table.keep, as_of).strftime("%Y%m%d"))
    removed = [f for f in slice_folders(spark, f"{root}/{table.name}", table) if int(f.rsplit("=", 1)[1][:8]) < limit]
    for folder in removed:
        remove_folder(spark, folder)
    return removed


_OLD = ".old-"


def finish_swaps(spark: SparkSession, path: str, table: Table) -> None:
    """After a run that died while it swapped folders: bring back a slice whose new one did not arrive."""
    if not path_exists(spark, path):
        return
    for folder in partition_folders(spark, path, f"_p=*/{_OLD}*"):
        parent, name = folder.rsplit("/", 1)
        target = f"{parent}/{name.removeprefix(_OLD)}"
        if path_exists(spark, target):
            remove_folder(spark, folder)
        else:
            move_folder(spark, folder, target)
    for folder in partition_folders(spark, path, ".compact-*"):
        remove_folder(spark, folder)


def optimize_table(spark: SparkSession, root: str, table: Table, file_bytes: int = FILE_BYTES, before: int | None = None) -> list[str]:
    """Rewrite the slices of a stored table that hold several files, and switch to the new ones.

    With ``before``, slices from that one on are left alone: in a log, those that rows may still be added to.

    All such slices are read and written by one job into a folder that readers pass over; aggregates are
    collapsed on the way. Slices above ``file_bytes`` are cut into files by ranges of the sort key, and are
    rewritten once they hold clearly more files than they need. Then each old slice is renamed aside, the new
    one renamed in place and the old one removed. ``finish_swaps`` repairs what a run left that died in between.
    Returns the rewritten slices.
    """
    path = f"{root}/{table.name}"
    finish_swaps(spark, path, table)
    closed = [f for f in slice_folders(spark, path, table) if before is None or slice_of(f) < before]
    files = {f: n for f in closed if (n := count_files(spark, f)) > 1}
    size = {f: folder_bytes(spark, f) for f in files}
    large = [f for f in files if size[f] > file_bytes and not table.additive]
    small = [f for f in files if f not in large]
    # A range may begin in one slice and end in the next, and sorted files are smaller: only clearly too many count.
    large = [f for f in large if files[f] > 2 * (math.ceil(size[f] / file_bytes) + 1)]
    rewritten: list[str] = []
    for folders in (small, large):
        if not folders:
            continue
        rows = spark.read.schema(table.stored_schema).option("basePath", path).parquet(*folders).select(table.schema.names)
        staged = f"{path}/.compact-{uuid.uuid4().hex}"
        if folders is large:
            range_cluster(stored_layout(rows, table), staged, table.partitions, table.order_by, math.ceil(sum(size[f] for f in large) / file_bytes))
        else:
            rows = compacted(rows, table) if table.additive else rows
            cluster_write(stored_layout(rows, table), staged, table.partitions, table.order_by)
        rewritten += _swap(spark, path, staged, table)
    return rewritten


def _swap(spark: SparkSession, path: str, staged: str, table: Table) -> list[str]:
    rewritten = []
    for new in partition_folders(spark, staged, f"_p=*/{table.slice_column}=*"):
        month, name = new.rsplit("/", 2)[1:]
        target, aside = f"{path}/{month}/{name}", f"{path}/{month}/{_OLD}{name}"
        move_folder(spark, target, aside)
        move_folder(spark, new, target)
        remove_folder(spark, aside)
        rewritten.append(target)
    remove_folder(spark, staged)
    return rewritten
