"""Marts and dimensions that only read what came since, against a full rebuild."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.casting import project_to
from tidemark.operators import maintenance, sinks, versions
from tidemark.plans import gold, incremental, marts, staging
from tidemark.schemas import ENTITIES, WAREHOUSE
from tidemark.sources.layers import read_gold_partition, read_silver, read_warehouse


def sale(key, day, customer="c1", product="p1", amount=10):
    return (f"{key}{day}", key, customer, product, 20240100 + day, 1, float(amount), float(amount), "shipped", datetime(2024, 1, day, 9))


def load_sales(spark, root, day, *rows):
    columns = "sale_id string, order_id string, customer_id string, product_id string, date_key int, quantity bigint, " \
              "unit_price double, total_amount double, status string, event_ts timestamp"
    sinks.load_fact(project_to(spark.createDataFrame(list(rows), columns), WAREHOUSE["fact_sales"].schema), root, "fact_sales", 20240100 + day)


def load_dims(spark, root, customers, products=(("p1", "Books"),)):
    sinks.load_dim(spark.createDataFrame(customers, "customer_id string, region string"), root, "dim_customer")
    sinks.load_dim(spark.createDataFrame(products, "product_id string, category string"), root, "dim_product")


def full(spark, root):
    daily = marts.int_daily_revenue(staging.stg_sales(read_warehouse(spark, root, "fact_sales")),
                                    read_warehouse(spark, root, "dim_product"), read_warehouse(spark, root, "dim_customer"))
    return rows(marts.agg_daily_revenue(daily))


def rows(df):
    return sorted(map(tuple, df.drop("_computed_at").select(sorted(set(df.columns) - {"_computed_at"})).collect()), key=repr)


@pytest.fixture
def warehouse(spark, folder):
    load_dims(spark, folder, [("c1", "North"), ("c2", "South")])
    for day in range(1, 6):
        load_sales(spark, folder, day, sale("a", day), sale("b", day, "c2", amount=5), sale("x", day, "c9"))
    return folder


def refreshed(spark, folder):
    days = incremental.refresh_mart(spark, "agg_daily_revenue", folder, f"{folder}/marts")
    assert rows(incremental.read_mart(spark, f"{folder}/marts", "agg_daily_revenue")) == full(spark, folder)
    return [d - 20240100 for d in days]


def test_only_changed_days_are_computed(spark, warehouse):
    assert refreshed(spark, warehouse) == [1, 2, 3, 4, 5]
    assert refreshed(spark, warehouse) == []
    load_sales(spark, warehouse, 2, sale("a", 2), sale("b", 2, "c2", amount=5), sale("x", 2, "c9"))  # the same again
    assert refreshed(spark, warehouse) == []
    load_sales(spark, warehouse, 2, sale("a", 2), sale("late", 2, amount=99))  # redelivered, with another row
    load_sales(spark, warehouse, 9, sale("a", 9))  # a new day
    assert refreshed(spark, warehouse) == [2, 9]
    load_sales(spark, warehouse, 3)  # nothing is left of a day
    assert refreshed(spark, warehouse) == [3]
    sinks.remove_folder(spark, f"{warehouse}/fact_sales/_p=202401/date_key=20240104")  # expired
    assert refreshed(spark, warehouse) == [4]
    assert sinks.partition_folders(spark, f"{warehouse}/marts/agg_daily_revenue", "_day=*")[-1].endswith("20240109")


def test_repeated_rows_change_a_day(spark, warehouse):
    refreshed(spark, warehouse)
    load_sales(spark, warehouse, 1, *[sale("a", 1)] * 3)  # hashes of two of them cancel in the first sum
    load_sales(spark, warehouse, 2, sale("a", 2), *[sale("b", 2, "c2", amount=5)] * 2, sale("x", 2, "c9"))
    assert refreshed(spark, warehouse) == [1, 2]


def test_changed_dimension_rows_change_their_days(spark, warehouse):
    load_sales(spark, warehouse, 4, sale("a", 4))
    refreshed(spark, warehouse)
    load_dims(spark, warehouse, [("c1", "North"), ("c2", "West"), ("c7", "East")])  # c2 moves, c7 has no sales
    assert refreshed(spark, warehouse) == [1, 2, 3, 5]
    load_dims(spark, warehouse, [("c1", "North"), ("c2", "West"), ("c7", "East"), ("c9", "East")])  # known at last
    assert refreshed(spark, warehouse) == [1, 2, 3, 5]
    load_dims(spark, warehouse, [("c1", "North"), ("c2", "West")], [("p1", "Toys")])
    assert refreshed(spark, warehouse) == [1, 2, 3, 4, 5]
    assert refreshed(spark, warehouse) == []
    assert len(glob.glob(f"{warehouse}/marts/agg_daily_revenue/_dimensions-*")) == 1


def test_only_changed_days_are_read(spark, warehouse, plan):
    refreshed(spark, warehouse)
    load_sales(spark, warehouse, 2, sale("late", 2, amount=99))
    seen = []
    incremental.refresh_mart(spark, "agg_daily_revenue", warehouse, f"{warehouse}/marts", lambda df: seen.append(df) or df)
    read = {f.split("/date_key=")[1][:8] for f in seen[0].inputFiles() if "/fact_sales/" in f}
    assert read == {"20240102"}


def test_a_run_that_died_is_done_again(spark, warehouse):
    refreshed(spark, warehouse)
    load_sales(spark, warehouse, 2, sale("late", 2, amount=99))

    def fail(df):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        incremental.refresh_mart(spark, "agg_daily_revenue", warehouse, f"{warehouse}/marts", fail)
    sinks.unmark_day(spark, f"{warehouse}/fact_sales", 20240105)  # a load that died before its mark
    load = glob.glob(f"{warehouse}/fact_sales/_p=202401/date_key=20240105/*.parquet")[0]
    os.remove(load)
    assert refreshed(spark, warehouse) == [2, 5]


def test_optimizing_changes_no_mark(spark, warehouse):
    path = f"{warehouse}/fact_sales"
    refreshed(spark, warehouse)
    before = sinks.day_marks(spark, path)
    for day in list(before)[1:]:
        sinks.unmark_day(spark, path, day)
    assert len(sinks.day_marks(spark, path)) == 1
    maintenance.optimize_table(spark, warehouse, WAREHOUSE["fact_sales"])
    assert incremental.mark_table(spark, warehouse, "fact_sales") == before == sinks.day_marks(spark, path) and len(before) == 5
    load_sales(spark, warehouse, 2, sale("late", 2, amount=99))  # marked in the file of all days and on its own
    assert refreshed(spark, warehouse) == [2]


def test_sensor_and_trade_marts(spark, folder):
    readings = [(f"r{d}{h}{i}", "L1", 20240100 + d, 20.0 + i + (60 if (d, h) == (2, 3) else 0), 1000.0, 50.0, datetime(2024, 1, d, h, i))
                for d in (1, 2, 3) for h in range(6) for i in range(3)]
    fact = spark.createDataFrame(readings, "reading_id string, location_id string, date_key int, temperature float, pressure float, humidity float, event_ts timestamp")
    fact = project_to(fact, WAREHOUSE["fact_sensor_readings"].schema)
    for day in (1, 2):
        sinks.load_fact(fact.where("minute(event_ts) < 2"), folder, "fact_sensor_readings", 20240100 + day)

    def check(days):
        assert incremental.refresh_mart(spark, "agg_hourly_sensor", folder, f"{folder}/marts") == days
        stored = read_warehouse(spark, folder, "fact_sensor_readings")
        want = marts.agg_hourly_sensor(marts.int_sensor_anomalies(staging.stg_sensors(stored)))
        assert rows(incremental.read_mart(spark, f"{folder}/marts", "agg_hourly_sensor")) == rows(want)
    check([20240101, 20240102])
    sinks.load_fact(fact, folder, "fact_sensor_readings", 20240102)
    sinks.load_fact(fact, folder, "fact_sensor_readings", 20240103)
    check([20240102, 20240103])
    check([])


# ---------------------------------------------------------------- dimensions by version


def customers(spark, *found):
    data = [(k, f"{k}@x", name, region, ts) for k, name, region, ts in found]
    made = spark.createDataFrame(data, "customer_id string, email string, name string, region string, event_ts timestamp")
    return project_to(made, ENTITIES["customers"].silver_schema)


def at(day):
    return datetime(2024, 1, day)


def merged(spark, folder):
    """Merge what is new, compare with a full rebuild, tell which batches were read."""
    made = gold.dimension_rows(spark, f"{folder}/silver", f"{folder}/gold", "dim_customer")
    read = sorted({f.split("_batch_id=")[1].split("/")[0] for f in made[0].inputFiles() if "_batch_id=" in f}) if made else None
    gold.merge_dimension(spark, f"{folder}/silver", f"{folder}/gold", "dim_customer")
    want = gold.build_dim_customer(read_silver(spark, f"{folder}/silver", "customers")).drop("_loaded_at")
    got = read_gold_partition(spark, f"{folder}/gold", "dim_customer").drop("_loaded_at")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    return read


def test_dimension_merges_only_new_batches(spark, folder):
    def write(batch, *found):
        sinks.write_silver(customers(spark, *found), f"{folder}/silver", "customers", batch)
    write("d1", ("c1", "Ann", "North", at(1)), ("c2", "Bob", "South", at(1)), ("c3", "Eve", None, at(5)))
    assert merged(spark, folder) == ["d1"]
    write("d2", ("c1", "Ann B", "North", at(2)), ("c4", "Joe", "West", at(2)), ("c3", "Old", "East", at(4)), (None, "x", "y", at(3)))
    assert merged(spark, folder) == ["d2"]
    assert merged(spark, folder) is None
    write("d0", ("c1", "Ann A", "North", at(1)), ("c2", "Bob", "Tie", at(1)))  # arrives late, ties decided by the columns
    assert merged(spark, folder) == ["d0"]
    write("d2", ("c4", "Joseph", "West", at(2)))  # written again: c1 and c3 go back
    assert merged(spark, folder) == ["d0", "d1", "d2"]
    os.makedirs(f"{folder}/silver/customers/_batch_id=d9/_temporary/0")  # being written
    assert merged(spark, folder) is None
    assert len(glob.glob(f"{folder}/gold/dim_customer/_v=*")) == 2


def test_unfinished_version_is_not_read(spark, folder):
    path = f"{folder}/dim"
    one = spark.createDataFrame([(1,)], "x int")
    versions.write_version(one, path, {"silver/a": 1})
    os.makedirs(f"{path}/_v=2")
    sinks.write_text(spark, f"{path}/_made-2", "{}")
    assert versions.current(spark, path) == (versions.current_folder(spark, path), {"silver/a": 1})
    assert versions.current_folder(spark, path).endswith("_v=1")
    versions.write_version(one.union(one), path, {"silver/b": 2})
    assert spark.read.parquet(versions.current_folder(spark, path)).count() == 2
    assert versions.current_folder(spark, f"{folder}/none") == f"{folder}/none"


# ---------------------------------------------------------------- files by range


def ranges(spark, path, key):
    """Smallest and largest key of every file, in order."""
    found = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return sorted((r.low, r.high) for r in found.collect())


def test_key_ranges_of_files_do_not_overlap(spark, folder):
    made = spark.range(60_000).select(F.lit(1).alias("_p"), F.format_string("k%06d", F.pmod(F.xxhash64("id"), F.lit(9000))).alias("k"), "id")
    made = made.unionByName(spark.range(30_000).select(F.lit(1).alias("_p"), F.lit("k004500").alias("k"), (F.col("id") + 100_000).alias("id")))
    path = maintenance.range_cluster(made, f"{folder}/t", ["_p"], ["k"], 12)
    found = ranges(spark, path, "k")
    assert len(found) >= 10
    overlaps = [(a, b) for a, b in zip(found, found[1:]) if b[0] <= a[1] and not (a[1] == b[0] == "k004500")]
    assert not overlaps
    heavy = [f for f in found if f[0] <= "k004500" <= f[1]]
    assert 3 <= len(heavy) <= 6  # a third of all rows in as many files, not in one
    light = [f for f in found if f[0] <= "k001000" <= f[1]]
    assert len(light) == 1  # a filter on one key opens one file
    assert spark.read.parquet(path).count() == 90_000


def test_large_slices_are_cut_by_range(spark, folder):
    table = WAREHOUSE["fact_sales"]
    made = spark.range(4000).select(
        F.col("id").cast("string").alias("order_id"), F.format_string("c%04d", F.pmod(F.xxhash64("id"), F.lit(500))).alias("customer_id"),
        F.lit("p").alias("product_id"), F.when(F.col("id") < 3900, 20240105).otherwise(20240106).cast("int").alias("date_key"),
        F.to_timestamp(F.when(F.col("id") < 3900, F.lit("2024-01-05 10:00:00")).otherwise(F.lit("2024-01-06 10:00:00"))).alias("event_ts"))
    placed = sinks.stored_layout(project_to(made, table.schema), table).repartition(16)
    placed.write.partitionBy(*table.partitions).parquet(f"{folder}/fact_sales")
    before = sorted(map(tuple, read_warehouse(spark, folder, "fact_sales").select("order_id", "customer_id", "date_key").collect()))
    size = sinks.folder_bytes(spark, f"{folder}/fact_sales/_p=202401/date_key=20240105") // 4
    assert len(maintenance.optimize_table(spark, folder, table, size)) == 2
    found = ranges(spark, f"{folder}/fact_sales/_p=202401/date_key=20240105", "customer_id")
    assert 3 <= len(found) <= 8 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert len(ranges(spark, f"{folder}/fact_sales/_p=202401/date_key=20240106", "customer_id")) == 1
    assert maintenance.optimize_table(spark, folder, table, size) == []
    assert sorted(map(tuple, read_warehouse(spark, folder, "fact_sales").select("order_id", "customer_id", "date_key").collect())) == before
    assert maintenance.optimize_table(spark, folder, table, size) == []
