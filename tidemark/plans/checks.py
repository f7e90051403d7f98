"""Declared data tests that read only the days that changed since they last ran, and an index of keys."""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import CHECKS
from tidemark.operators.sinks import move_folder, path_exists, read_text, remove_folder, write_text
from tidemark.plans.incremental import mark_table
from tidemark.schemas import WAREHOUSE
from tidemark.sources.layers import read_days

KEY = "_key"
REPORT = "table_name string, column_name string, test string, failures bigint"


def _state(spark: SparkSession, path: str) -> dict:
    """What the index holds: for each day its mark, run and missing values; the folder of repeated keys and their number."""
    if not path_exists(spark, f"{path}/_state"):
        return {"days": {}, "repeated": None, "failures": 0}
    return json.loads(read_text(spark, f"{path}/_state"))


def _switch(spark: SparkSession, path: str, state: dict) -> None:
    """The one step by which a run takes effect; one that dies in between indexes everything again."""
    staged = f"{path}/_state-{uuid.uuid4().hex}"
    write_text(spark, staged, json.dumps(state))
    if path_exists(spark, f"{path}/_state"):
        remove_folder(spark, f"{path}/_state")
    move_folder(spark, staged, f"{path}/_state")


def _key_type(table: str, key: str) -> T.DataType:
    return WAREHOUSE[table].schema[key].dataType


def _index_schema(table: str, key: str) -> T.StructType:
    return T.StructType().add(KEY, _key_type(table, key)).add("rows", T.LongType()).add("date_key", T.IntegerType())


def _indexed(spark: SparkSession, path: str, schema: T.StructType, days: Mapping[str, dict]) -> DataFrame:
    """Keys of some days of the index, with their number of rows."""
    folders = [f"{path}/keys/{day['run']}/date_key={d}" for d, day in days.items() if day["rows"]]
    if not folders:
        return spark.createDataFrame([], schema).select(KEY, "rows")
    return spark.read.schema(T.StructType(schema.fields[:2])).parquet(*folders).where(F.col(KEY).isNotNull())


def _index_days(spark: SparkSession, table: str, key: str, nullable: Sequence[str], warehouse_root: str, path: str,
                days: Collection[int], marks: Mapping[int, str]) -> dict[str, dict]:
    """Store the keys of changed days; the facts are scanned once, and only the tested columns."""
    run = uuid.uuid4().hex
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in nullable]
    rows = read_days(spark, warehouse_root, table, days).groupBy("date_key", F.col(key).alias(KEY)).agg(
        F.count(F.lit(1)).alias("rows"), *nulls)
    (rows.hint("rebalance", "date_key").sortWithinPartitions("date_key", KEY).write.partitionBy("date_key")
     .parquet(f"{path}/keys/{run}"))
    schema = T.StructType([*_index_schema(table, key).fields, *[T.StructField(f"_null_{c}", T.LongType()) for c in nullable]])
    totals = (spark.read.schema(schema).parquet(f"{path}/keys/{run}").groupBy("date_key")
              .agg(F.sum("rows").alias("rows"), *[F.sum(f"_null_{c}").alias(f"_null_{c}") for c in nullable]))
    found = {r.date_key: r for r in totals.collect()}  # one row a day
    return {str(d): {"mark": marks[d], "run": run, "rows": found[d].rows if d in found else 0,
                     "nulls": {c: found[d][f"_null_{c}"] if d in found else 0 for c in nullable}} for d in days}


def _repeated_now(old: DataFrame, gone: DataFrame, new: DataFrame, kept: DataFrame) -> DataFrame:
    """Repeated keys after some days changed from ``gone`` to ``new``; only keys of these days are counted again."""
    touched = gone.select(KEY).union(new.select(KEY)).distinct()
    elsewhere = kept.join(touched, KEY, "left_semi")
    counted = elsewhere.unionByName(new).groupBy(KEY).agg(F.sum("rows").alias("rows")).where("rows > 1")
    return old.join(touched, KEY, "left_anti").unionByName(counted)


def _drop_unused(spark: SparkSession, path: str, before: dict, after: dict) -> None:
    """Folders that no day of the index names any more."""
    used = {day["run"] for day in after["days"].values()}
    for day, entry in before["days"].items():
        if entry["run"] not in used:
            remove_folder(spark, f"{path}/keys/{entry['run']}")
        elif after["days"].get(day, entry)["run"] != entry["run"] or day not in after["days"]:
            remove_folder(spark, f"{path}/keys/{entry['run']}/date_key={day}")
    if before["repeated"] and before["repeated"] != after["repeated"]:
        remove_folder(spark, before["repeated"])


def update_index(spark: SparkSession, table: str, key: str, nullable: Sequence[str], warehouse_root: str,
                 index_root: str) -> tuple[dict, list[int]]:
    """Bring the index of a unique key up to date; returns its state and the days that were read.

    The index holds, for each stored day of a fact, its keys and their numbers of rows. Days whose mark differs
    from the indexed one, and days that came or went, are scanned (gone ones in the index alone). Their keys, old
    and new, are counted again over the index; of all other keys the verdict stands. The fact's other days are not
    opened. Nothing that the last state names is overwritten: a run that dies leaves the last state as it was.
    """
    path, schema = f"{index_root}/{table}/{key}", _index_schema(table, key)
    before, marks = _state(spark, path), mark_table(spark, warehouse_root, table)
    days = before["days"]
    changed = [d for d, mark in marks.items() if days.get(str(d), {}).get("mark") != mark]
    gone = {d: entry for d, entry in days.items() if int(d) not in marks or int(d) in set(changed)}
    if not changed and not gone:
        return before, []
    new = _index_days(spark, table, key, nullable, warehouse_root, path, changed, marks) if changed else {}
    kept = {d: entry for d, entry in days.items() if d not in gone}
    counts = T.StructType(schema.fields[:2])
    old = spark.read.schema(counts).parquet(before["repeated"]) if before["repeated"] else spark.createDataFrame([], counts)
    repeated = f"{path}/repeated-{uuid.uuid4().hex}"
    _repeated_now(old, *[_indexed(spark, path, schema, part) for part in (gone, new, kept)]).write.parquet(repeated)
    after = {"days": kept | new, "repeated": repeated, "failures": spark.read.schema(counts).parquet(repeated).count()}
    _switch(spark, path, after)
    _drop_unused(spark, path, before, after)
    return after, sorted({*changed, *map(int, gone)})


def run_checks_by_day(spark: SparkSession, warehouse_root: str, index_root: str,
                      spec: Mapping[str, Mapping[str, Sequence[str]]] = CHECKS) -> DataFrame:
    """The report of ``run_checks`` on stored facts, from changed days and the index; a table needs a unique column."""
    found: list[tuple[str, str, str, int]] = []
    for table, tests in spec.items():
        unique = [c for c, kinds in tests.items() if "unique" in kinds]
        if not unique:
            raise ValueError(f"{table} declares no unique column to index")
        nullable = [c for c, kinds in tests.items() if "not_null" in kinds]
        for i, key in enumerate(unique):
            state, _ = update_index(spark, table, key, nullable if i == 0 else (), warehouse_root, index_root)
            found.append((table, key, "unique", state["failures"]))
            if i == 0:
                found += [(table, c, "not_null", sum(day["nulls"][c] for day in state["days"].values())) for c in nullable]
    return spark.createDataFrame(found, REPORT)


def repeated_keys(spark: SparkSession, table: str, key: str, index_root: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows, as of the last run."""
    path, schema = f"{index_root}/{table}/{key}", T.StructType(_index_schema(table, key).fields[:2])
    folder = _state(spark, path)["repeated"]
    rows = spark.read.schema(schema).parquet(folder) if folder else spark.createDataFrame([], schema)
    return rows.withColumnRenamed(KEY, key)
