"""Silver to star schema: facts are projections, dimensions keep the latest version."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date as Date
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import date_key, literal, on_day
from tidemark.functions.keys import surrogate_key
from tidemark.operators import versions
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.sinks import load_dim, load_fact, write_gold_fact
from tidemark.schemas import ENTITIES, WAREHOUSE
from tidemark.schemas import FACT_SOURCES as FACTS
from tidemark.sources.layers import read_gold_partition, read_silver, read_streamed, silver_slices

Day = str | Date | None

#: Bytes of silver files for each core that a rebuild of all days takes into one job.
SLICE_BYTES = 32 << 20


def _stamp(as_of: datetime | None) -> Column:
    moment = F.current_timestamp() if as_of is None else literal(as_of).cast("timestamp")
    return moment.alias("_loaded_at")


def project_fact(name: str, silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The columns that the registry declares for a fact, one row for each silver row."""
    made = {
        "date_key": date_key(F.col("event_ts")).alias("date_key"),
        "sale_id": surrogate_key("order_id", "product_id", "date_key").alias("sale_id"),
        "_loaded_at": _stamp(as_of),
    }
    columns, key = WAREHOUSE[name].schema.names, made.pop("date_key")
    # A day key that is there stays a plain column, so its bound moves below the window that made the rows.
    rows = silver if "date_key" in silver.columns else silver.withColumn("date_key", key)
    return rows.select([made.get(c, F.col(c)) for c in columns])


def build_fact(name: str, silver: DataFrame, date: Day = None, as_of: datetime | None = None,
               gather: bool = False) -> DataFrame:
    """A fact of one event day, or of every day: the newest row of each key and day.

    De-duplication in silver ends at the batch; a message delivered on two raw days, or by a batch and a
    stream, is in silver twice. Of rows with one event time the one of the last batch by name stays.
    ``gather`` brings rows together by day, before the columns that are computed from others are added.
    """
    key = ENTITIES[FACTS[name]].key
    rows = silver if date is None else on_day(silver, date)
    rows = rows.withColumn("date_key", date_key(F.col("event_ts")))
    carried = [c for c in WAREHOUSE[name].schema.names if c in silver.columns and c not in (key, "event_ts", "_batch_id")]
    newest = latest_per_key(rows, [key, "date_key"], "event_ts", ["_batch_id", *carried])
    return project_fact(name, newest.hint("rebalance", "date_key") if gather else newest, as_of)


def build_dim_customer(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    columns = ("email", "name", "region", "age_group")
    return latest_per_key(silver, ["customer_id"], "event_ts", columns).select(
        "customer_id", *columns, F.col("event_ts").alias("created_at"), _stamp(as_of))


def build_dim_product(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    columns = ("name", "category", "price", "stock_quantity")
    return latest_per_key(silver, ["product_id"], "event_ts", columns).select(
        "product_id", *columns, F.col("event_ts").alias("created_at"), _stamp(as_of))


# gold dimension → (silver table, builder)
DIMENSIONS = {
    "dim_customer": ("customers", build_dim_customer),
    "dim_product": ("products", build_dim_product),
}


def silver_to_gold(spark: SparkSession, silver_root: str, gold_root: str, date: Day,
                   stream_root: str | None = None, seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[str]:
    """All facts of one event day (or of every day) and all dimensions.

    With ``stream_root``, what the streams have written there is read beside the batch tables; an event that
    is in both becomes one row. ``seen`` is put around every frame that is written. All days without streams are
    rebuilt some days at a time, for no row of a fact depends on another day: what lies on disk between the
    stages is bounded, however many days there are.
    """
    def sources(table: str) -> list[DataFrame]:
        if date is None and not stream_root:
            return silver_slices(spark, silver_root, table, SLICE_BYTES * spark.sparkContext.defaultParallelism)
        stored = read_silver(spark, silver_root, table, date)
        return [stored.unionByName(read_streamed(spark, stream_root, table, date)) if stream_root else stored]

    written = []
    for name, table in FACTS.items():
        for rows in sources(table):
            path = write_gold_fact(seen(build_fact(name, rows, date, gather=date is None)), gold_root, name)
        written.append(path)
    return written + [merge_dimension(spark, silver_root, gold_root, name, stream_root, seen) for name in DIMENSIONS]


def dimension_rows(spark: SparkSession, silver_root: str, gold_root: str, name: str,
                   stream_root: str | None = None) -> tuple[DataFrame, dict[str, int]] | None:
    """The dimension after all batches there are now, and these batches; None if the stored version has them all.

    The newest of what is newest is the newest, so the stored version and the batches that came since are
    enough. A silver batch that was written again or removed cannot be taken back out: then every batch is
    read. A streamed batch only ever moves into silver.
    """
    table, build = DIMENSIONS[name]
    found = {f"silver/{b}": stamp for b, stamp in versions.committed_batches(spark, f"{silver_root}/{table}").items()}
    if stream_root:
        found |= {f"stream/{b}": stamp for b, stamp in versions.committed_batches(spark, f"{stream_root}/{table}").items()}
    stored, merged = versions.current(spark, f"{gold_root}/{name}") or (None, {})
    if any(found.get(b) != stamp for b, stamp in merged.items() if b.startswith("silver/")):
        stored, merged = None, {}
    new = sorted(b for b, stamp in found.items() if merged.get(b) != stamp)
    if stored and not new:
        return None
    schema, parts = ENTITIES[table].silver_schema, []
    for layer, root in (("silver", silver_root), ("stream", stream_root)):
        folders = [f"{root}/{table}/_batch_id={b.split('/', 1)[1]}" for b in new if b.startswith(f"{layer}/")]
        if folders:
            parts.append(spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(*folders))
    rows = reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], schema)])
    if stored:
        old = spark.read.parquet(stored).withColumnRenamed("created_at", "event_ts").drop("_loaded_at")
        rows = old.unionByName(rows.select(old.columns))
    return build(rows), {**merged, **found}


def merge_dimension(spark: SparkSession, silver_root: str, gold_root: str, name: str, stream_root: str | None = None,
                    seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> str:
    """Write the next version of a dimension: the stored one and the batches that came since."""
    path, made = f"{gold_root}/{name}", dimension_rows(spark, silver_root, gold_root, name, stream_root)
    if made:
        versions.write_version(seen(made[0]), path, made[1])
    return path


def gold_to_warehouse(spark: SparkSession, gold_root: str, warehouse_root: str, date_key: int,
                      seen: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[str]:
    """One date_key of every fact and all dimensions, loaded by column name."""
    loaded = [
        load_fact(seen(read_gold_partition(spark, gold_root, name, date_key)), warehouse_root, name, date_key)
        for name in FACTS
    ]
    return loaded + [
        load_dim(seen(read_gold_partition(spark, gold_root, name)), warehouse_root, name)
        for name in DIMENSIONS
    ]
