"""Latest row per key, whatever the order of arrival."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.dedup import deduplicate, merged_dimension
from tidemark.plans.silver import add_metadata, to_silver
from tidemark.schemas import ENTITIES, WAREHOUSE

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)
DDL = "id string, event_ts timestamp, value int"


def latest(spark, rows):
    out = deduplicate(spark.createDataFrame(rows, DDL), "id")
    return sorted((r.id, r.value) for r in out.collect())


def test_newest_wins(spark):
    assert latest(spark, [("a", EARLY, 9), ("a", LATE, 1), ("b", EARLY, 5)]) == [("a", 1), ("b", 5)]


def test_equal_times_do_not_depend_on_the_order(spark):
    rows = [("a", EARLY, 3), ("a", EARLY, 8), ("a", EARLY, 5)]
    assert latest(spark, rows) == latest(spark, rows[::-1]) == [("a", 8)]


def test_a_row_without_time_loses_and_one_without_key_is_dropped(spark):
    assert latest(spark, [("a", None, 9), ("a", EARLY, 1), (None, LATE, 7)]) == [("a", 1)]


def test_rows_are_cut_per_task_before_the_shuffle(spark, plan):
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.timestamp_seconds("id").alias("event_ts"), F.col("id").cast("int").alias("value"))
    out = deduplicate(hot.repartition(8, "value"), "id")
    assert out.filter("id = 'hot'").first().value == 29997
    assert out.count() == 20001
    text = plan(out)
    assert text.count("WindowGroupLimit") >= 2  # one below, one above the exchange
    below = text[text.index("Exchange hashpartitioning(id"):]
    assert "WindowGroupLimit" in below


def test_rows_without_time_do_not_reach_silver(spark):
    out = add_metadata(spark.createDataFrame([("a", None, 1), ("b", LATE, 2)], DDL), "batch")
    row = out.collect()
    assert [(r.id, r._batch_id, r._year, r._month, r._day) for r in row] == [("b", "batch", 2024, 1, 2)]


def test_transfers_are_not_trades(spark):
    raw = spark.createDataFrame(
        [("t1", "trade_executed", "2024-01-01T00:00:00"), ("", "transfer", "2024-01-01T00:00:00")],
        "trade_id string, event_type string, event_ts string")
    assert [r.trade_id for r in to_silver(raw, ENTITIES["financial"], "b").collect()] == ["t1"]


def test_replacing_merge_uses_the_declared_key_and_version(spark):
    rows = spark.createDataFrame(
        [("c1", "old", EARLY), ("c1", "new", LATE), ("c2", "only", EARLY)],
        "customer_id string, region string, _loaded_at timestamp")
    out = merged_dimension(rows, WAREHOUSE["dim_customer"])
    assert sorted((r.customer_id, r.region) for r in out.collect()) == [("c1", "new"), ("c2", "only")]
