"""Reading the lake layers. Every reader prunes to the partitions it needs."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from datetime import date as Date
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import on_day
from tidemark.operators.sinks import ensure_table, folder_bytes, partition_folders, path_exists, slice_folders, slice_key, slice_of
from tidemark.operators.versions import current_folder
from tidemark.schemas import ENTITIES, FACT_SOURCES, WAREHOUSE, bronze_columns, parse_ddl

LANDING_COLUMNS = ("_kafka_offset", "_kafka_partition", "_ingested_at")
ARRIVAL_PARTITIONS = ("year", "month", "day", "hour", "batch")
BRONZE_PARTITIONS = ("source", *ARRIVAL_PARTITIONS)


def bronze_schema(topic: str) -> T.StructType:
    """All text; keys outside the known ones are kept in ``_extra``."""
    names = (*bronze_columns(topic), *LANDING_COLUMNS)
    text = ", ".join(f"{n} string" for n in names)
    parts = ", ".join(f"{n} string" for n in BRONZE_PARTITIONS)
    return parse_ddl(f"{text}, _extra map<string,string>, {parts}")


def read_bronze(spark: SparkSession, root: str, source: str, date: str | Date,
                merge_schema: bool = False) -> DataFrame:
    """One source-day of raw files.

    Only that day's folder is listed, so planning does not grow with the age of the
    lake. ``merge_schema`` reads foreign files whose columns differ from file to file.
    """
    day = Date.fromisoformat(date) if isinstance(date, str) else date
    folder = f"{root}/source={source}/year={day:%Y}/month={day:%m}/day={day:%d}"
    reader = spark.read.option("basePath", root)
    if merge_schema:
        return reader.option("mergeSchema", True).parquet(folder)
    return reader.schema(bronze_schema(source)).parquet(folder)


def read_silver(spark: SparkSession, root: str, table: str, date: str | Date | None = None) -> DataFrame:
    """A silver table, or one calendar day of it; of an event table only that day's folder is listed."""
    entity, path = ENTITIES[table], f"{root}/{table}"
    reader = spark.read.schema(entity.silver_schema)
    if date is None:
        return reader.parquet(path)
    if entity.dimension:
        return on_day(reader.parquet(path), date)
    day = Date.fromisoformat(date) if isinstance(date, str) else date
    folder = f"{path}/_year={day.year}/_month={day.month}/_day={day.day}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], entity.silver_schema)
    return on_day(reader.option("basePath", path).parquet(folder), day)


def silver_slices(spark: SparkSession, root: str, table: str, most: int) -> list[DataFrame]:
    """A silver event table in parts of whole days, of ``most`` bytes of files unless one day has more.

    Together the parts hold every day once. Folders are sized by month, and by day where a month is above ``most``.
    """
    entity, path = ENTITIES[table], f"{root}/{table}"
    parts: list[list[str]] = []
    room = 0
    for month in partition_folders(spark, path, "_year=*/_month=*"):
        sized = [(month, folder_bytes(spark, month))]
        if sized[0][1] > most:
            sized = [(day, folder_bytes(spark, day)) for day in partition_folders(spark, month, "_day=*")]
        for folder, size in sized:
            if not parts or size > room:
                parts.append([])
                room = most
            parts[-1].append(folder)
            room -= size
    reader = spark.read.schema(entity.silver_schema).option("basePath", path)
    return [reader.parquet(*folders) for folders in parts] or [read_silver(spark, root, table)]


def read_streamed(spark: SparkSession, root: str, table: str, date: str | Date | None = None) -> DataFrame:
    """What the streams have written and nobody has gathered yet: the columns of the silver table."""
    entity, path = ENTITIES[table], f"{root}/{table}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], entity.silver_schema)
    rows = spark.read.schema(entity.silver_schema).parquet(path)
    return rows if date is None else on_day(rows, date)


def read_gold_partition(spark: SparkSession, root: str, table: str, date_key: int | None = None) -> DataFrame:
    """One date_key of a gold fact, or a whole fact, or the newest version of a dimension.

    Of one day only its folder is listed, and a day without rows is an empty frame. Facts have the schema
    that the registry declares.
    """
    path, spec = f"{root}/{table}", WAREHOUSE[table]
    if "date_key" not in spec.schema.names or table == "dim_date":
        return spark.read.parquet(current_folder(spark, path))
    if date_key is None:
        return spark.read.schema(gold_schema(table)).parquet(path)
    folder = f"{path}/date_key={date_key}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], gold_schema(table))
    return spark.read.schema(gold_schema(table)).option("basePath", path).parquet(folder)


def gold_schema(table: str) -> T.StructType:
    """Columns of the fact with the types they have in silver; the day key is a folder."""
    silver = {f.name: f for entity in ENTITIES.values() for f in entity.silver_schema.fields if FACT_SOURCES.get(table) == entity.name}
    fields = [silver.get(f.name, f) for f in WAREHOUSE[table].schema.fields if f.name != "date_key"]
    return T.StructType([*fields, T.StructField("date_key", T.IntegerType())])


def read_warehouse(spark: SparkSession, root: str, table: str, since: Date | datetime | None = None) -> DataFrame:
    """A stored warehouse table, or the slices of it from a moment on.

    With ``since``, older folders are neither listed nor opened: only folder names are looked at.
    """
    spec, path = WAREHOUSE[table], f"{root}/{table}"
    if spec.partition_format is None:
        return spark.read.schema(spec.schema).parquet(path)
    reader = spark.read.schema(spec.stored_schema).option("basePath", path)
    if since is None:
        return reader.parquet(path).select(spec.schema.names)
    first = slice_key(since, spec)
    folders = [f for f in slice_folders(spark, path, spec) if slice_of(f) >= first]
    found = reader.parquet(*folders) if folders else spark.createDataFrame([], spec.stored_schema)
    return found.select(spec.schema.names)


def read_days(spark: SparkSession, root: str, table: str, days: Collection[int]) -> DataFrame:
    """Some days of a stored fact: only their folders are listed and opened."""
    spec, path = WAREHOUSE[table], f"{root}/{table}"
    folders = [f for f in slice_folders(spark, path, spec) if slice_of(f) in days]
    found = spark.read.schema(spec.stored_schema).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], spec.stored_schema)
    return found.select(spec.schema.names)


def discover_layer(spark: SparkSession, root: str) -> DataFrame:
    """Columns of a layer as Spark finds them: name, type, position, partition column or not."""
    found = spark.read.option("mergeSchema", True).parquet(root)
    stored = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(root)
    partitions = set(found.columns) - set(stored.columns)
    rows = [(i, f.name, f.dataType.simpleString(), f.name in partitions)
            for i, f in enumerate(found.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string, is_partition boolean")


def register_layer(spark: SparkSession, name: str, root: str, schema: T.StructType, partitions: Sequence[str]) -> DataFrame:
    """A folder of partitions as a table of the catalog, with the partitions found now; returns them.

    Folders are listed by tasks (``recoverPartitions``), so a layer of many days costs the driver one entry for
    each partition and no file. Called again, it adds partitions that came since and forgets those whose folder is gone. The
    result has the partition columns as text: one row for each registered partition.
    """
    ensure_table(spark, name, schema, tuple(partitions), root)
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    found = F.str_to_map("partition", F.lit("/"), F.lit("="))
    return spark.sql(f"SHOW PARTITIONS {name}").select(*[F.element_at(found, c).alias(c) for c in partitions])
