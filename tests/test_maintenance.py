"""Compaction, retention, rewriting and the removal of old raw days."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.operators import maintenance as m
from tidemark.functions.casting import project_to
from tidemark.operators.sinks import move_folder, partition_folders, stored_layout
from tidemark.schemas import WAREHOUSE
from tidemark.sources.layers import read_warehouse

NOON = datetime(2024, 1, 5, 12)


def test_averages_are_weighted_and_flags_survive(spark):
    table = WAREHOUSE["agg_hourly_sensor"]
    rows = spark.createDataFrame(
        [(NOON, "L1", 10.0, 1000.0, None, 1, 0, NOON), (NOON, "L1", 40.0, 1000.0, 50.0, 2, 1, NOON + timedelta(1)),
         (NOON, "L2", 5.0, 1.0, 1.0, 3, 0, NOON)], table.schema)
    out = {r.location_id: r for r in m.compacted(rows, table).collect()}
    assert (out["L1"].avg_temp, out["L1"].avg_humidity, out["L1"].reading_count, out["L1"].anomaly_flag) == (30.0, 50.0, 3, 1)
    assert out["L1"]._computed_at == NOON + timedelta(1)
    assert out["L2"].avg_temp == 5.0
    assert m.compacted(rows, table).schema == rows.schema


def test_keys_that_depend_on_the_sort_key_are_not_summed(spark):
    table = WAREHOUSE["agg_daily_revenue"]
    day = NOON.date()
    rows = spark.createDataFrame(
        [(20240105, day, "N", "B", 1, Decimal("10.00"), Decimal("10.00"), NOON),
         (20240105, day, "N", "B", 3, Decimal("50.00"), Decimal("16.67"), NOON)], table.schema)
    row = m.compacted(rows, table).collect()
    assert [(r.date_key, r.total_orders, r.total_revenue, r.avg_order_value) for r in row] == [
        (20240105, 4, Decimal("60.00"), Decimal("15.00"))]


def test_compacting_twice_changes_nothing(spark):
    table = WAREHOUSE["agg_trading_volume"]
    rows = spark.range(200).select(
        F.lit(20240105).alias("date_key"), F.lit(NOON.date()).alias("full_date"),
        (F.col("id") % 3).cast("string").alias("asset"), F.col("id").cast("double").alias("total_volume"),
        (F.col("id") + 1).alias("trade_count"), (F.col("id") / 7).cast("decimal(18,8)").alias("avg_price"),
        F.lit(NOON).alias("_computed_at"))
    once = m.compacted(rows, table)
    assert sorted(m.compacted(once, table).collect()) == sorted(once.collect())
    exact = sum(Decimal(i + 1) * r.avg_price for i, r in enumerate(rows.orderBy("total_volume").collect()) if i % 3 == 0)
    weight = sum(i + 1 for i in range(0, 200, 3))
    got = once.filter("asset = '0'").first().avg_price
    assert abs(got - exact / weight) <= Decimal("0.000000005")


def test_retention_periods(spark):
    edge = datetime(2022, 1, 5, 12)
    rows = spark.createDataFrame([(edge,), (edge + timedelta(microseconds=1),), (NOON,)], "event_ts timestamp")
    assert m.retained(rows, WAREHOUSE["fact_sales"], NOON).count() == 2
    assert m.retained(rows, WAREHOUSE["fact_social_engagement"], NOON).count() == 3
    recent = rows.withColumnRenamed("event_ts", "created_at")
    assert m.retained(recent, WAREHOUSE["llm_insights"], NOON + timedelta(days=30)).count() == 0
    assert m.retained(recent, WAREHOUSE["llm_insights"], NOON + timedelta(days=29)).count() == 1


def test_old_raw_days_are_removed_whole(spark, folder):
    for day in ("2023-07-08", "2023-07-09", "2024-01-04"):
        year, month, dom = day.split("-")
        spark.range(1).write.parquet(f"{folder}/source=sensors/year={year}/month={month}/day={dom}/hour=00")
    removed = m.expire_bronze(spark, folder, NOON)
    assert [r.rsplit("/", 2)[1:] for r in removed] == [["month=07", "day=08"]]
    left = partition_folders(spark, folder, "source=*/year=*/month=*/day=*")
    assert [f.rsplit("/", 1)[1] for f in left] == ["day=09", "day=04"]


def test_small_files_are_merged(spark, folder):
    rows = spark.range(4000).select((F.col("id") % 2).alias("part"), "id")
    rows.repartition(20).write.partitionBy("part").parquet(f"{folder}/many")
    m.compact_table(spark, f"{folder}/many", f"{folder}/few", ("part",), ("id",))
    few = spark.read.parquet(f"{folder}/few")
    assert len(few.inputFiles()) < len(spark.read.parquet(f"{folder}/many").inputFiles()) / 4
    assert sorted(few.select("part", "id").collect()) == sorted(rows.collect())


def trades(spark, n, day=5):
    return spark.range(n).select(
        F.col("id").cast("string").alias("trade_id"), F.concat(F.lit("a"), F.col("id") % 7).alias("asset"),
        F.lit(20240100 + day).alias("date_key"), F.lit(NOON.replace(day=day)).alias("event_ts"))


def test_clustered_files_hold_sorted_rows_in_the_declared_partitions(spark, folder):
    path = m.store_table(trades(spark, 3000).unionByName(trades(spark, 100, 6)), folder, WAREHOUSE["fact_trades"])
    stored = spark.read.parquet(path)
    assert stored.count() == 3100 and {tuple(r) for r in stored.select("_p", "date_key").distinct().collect()} == {(202401, 20240105), (202401, 20240106)}
    for file in stored.inputFiles():
        assets = [r.asset for r in spark.read.parquet(file).collect()]
        assert assets == sorted(assets)


def test_one_hot_key_is_spread_over_files(spark, folder):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    rows = spark.range(60000).select(
        F.lit("hot").alias("asset"), F.lit(20240105).alias("date_key"), F.lit(NOON).alias("event_ts"), F.sha2(F.col("id").cast("string"), 256).alias("trade_id"))
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
        path = m.store_table(rows, folder, WAREHOUSE["fact_trades"])
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    stored = spark.read.parquet(path)
    assert stored.count() == 60000 and len(stored.inputFiles()) >= 3


def test_the_input_of_a_clustered_write_is_computed_once(spark, folder):
    from pyspark.sql import Observation
    seen = Observation()
    rows = trades(spark, 500).observe(seen, F.count(F.lit(1)).alias("n"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("clustered", "one write")
    m.store_table(rows, folder, WAREHOUSE["fact_trades"])
    spark.sparkContext.setJobGroup("", "")
    assert seen.get["n"] == 500
    stages = {s for j in jobs.getJobIdsForGroup("clustered") for s in jobs.getJobInfo(j).stageIds}
    assert len(stages) <= 3  # the shuffle, the write and the skipped copy of the first


def test_days_past_their_time_are_removed(spark, folder):
    table = WAREHOUSE["fact_trades"]
    m.store_table(trades(spark, 10, 5).unionByName(trades(spark, 10, 6)), folder, table)
    assert m.expire_table(spark, folder, table, datetime(2027, 1, 5, 23)) == []
    removed = m.expire_table(spark, folder, table, datetime(2027, 1, 6, 1))
    assert [f.rsplit("/", 2)[1:] for f in removed] == [["_p=202401", "date_key=20240105"]]
    assert read_warehouse(spark, folder, "fact_trades").select("date_key").distinct().collect()[0][0] == 20240106
    assert m.expire_table(spark, folder, WAREHOUSE["fact_social_engagement"], NOON) == []


def test_small_files_are_rewritten_in_place(spark, folder):
    table = WAREHOUSE["fact_trades"]
    for _ in range(3):
        placed = stored_layout(project_to(trades(spark, 20), table.schema), table)
        placed.repartition(4).write.mode("append").partitionBy(*table.partitions).parquet(f"{folder}/fact_trades")
    stored_layout(project_to(trades(spark, 5, 6), table.schema), table).coalesce(1).write.mode("append").partitionBy(
        *table.partitions).parquet(f"{folder}/fact_trades")
    want = sorted(map(str, read_warehouse(spark, folder, "fact_trades").collect()))
    rewritten = m.optimize_table(spark, folder, table)
    assert [f.rsplit("/", 1)[1] for f in rewritten] == ["date_key=20240105"]
    after = read_warehouse(spark, folder, "fact_trades")
    assert sorted(map(str, after.collect())) == want and len(after.inputFiles()) == 2
    assert m.optimize_table(spark, folder, table) == []


def test_a_swap_that_was_cut_off_is_finished(spark, folder):
    table, path = WAREHOUSE["fact_trades"], f"{folder}/fact_trades"
    m.store_table(trades(spark, 10, 5).unionByName(trades(spark, 10, 6)), folder, table)
    # one run died after moving a day aside, another before removing the old day
    move_folder(spark, f"{path}/_p=202401/date_key=20240105", f"{path}/_p=202401/.old-date_key=20240105")
    spark.range(1).write.parquet(f"{path}/_p=202401/.old-date_key=20240106")
    spark.range(1).write.parquet(f"{path}/.compact-x/_p=202401/date_key=20240106")
    m.finish_swaps(spark, path, table)
    assert read_warehouse(spark, folder, "fact_trades").count() == 20
    assert not partition_folders(spark, path, "_p=*/.old-*") and not partition_folders(spark, path, ".compact-*")


def test_hourly_rows_that_came_twice_are_collapsed_in_place(spark, folder):
    table = WAREHOUSE["agg_hourly_sensor"]
    for temperature, n in ((10.0, 1), (40.0, 2)):
        rows = spark.createDataFrame([(NOON, "L1", temperature, 1000.0, 50.0, n, 0, NOON)], table.schema)
        stored_layout(rows, table).write.mode("append").partitionBy(*table.partitions).parquet(f"{folder}/{table.name}")
    m.optimize_table(spark, folder, table)
    assert [(r.avg_temp, r.reading_count) for r in read_warehouse(spark, folder, table.name).collect()] == [(30.0, 3)]
