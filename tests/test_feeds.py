"""How registered queries hand their messages to the streams."""

import os
import time

from pyspark.sql import functions as F

from tidemark.catalogue import queries
from tidemark.operators import sinks
from tidemark.plans import gold, silver
from tidemark.schemas import ENTITIES
from tidemark.sources import layers
from tidemark.streaming.landing import to_bronze


def test_feed_files_are_compressed_and_bounded(spark, monkeypatch):
    monkeypatch.setattr(queries, "FEED_ROWS", 30)
    lines = spark.range(0, 100, 1, 2).select(F.concat(F.lit('{"order_id":"same text again and again","n":'), "id", F.lit("}")).alias("value"))
    folder = queries.written_feed(spark, lines, "feed")
    files = [n for n in os.listdir(folder) if n.startswith("part-")]
    assert len(files) == 4 and all(n.endswith(".gz") for n in files)
    queries.deliver(lines, folder)
    assert sorted(r.value for r in spark.read.text(folder).collect()) == sorted([r.value for r in lines.collect()] * 2)


def test_raw_messages_are_parsed_once(spark, plan):
    lines = spark.createDataFrame([('{"reading_id":"a","x":1}',), ("{cut",), (None,)], "value string").repartition(2)
    landed = to_bronze(lines.selectExpr("value", "0L as offset", "0 as partition"), "sensors")
    assert plan(landed).count("from_json") == 1
    assert [(r.reading_id, r._extra) for r in landed.collect()] == [("a", {"x": "1"})]


def shuffle_files(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {line.rsplit("/", 1)[1] for line in found.split("\n") if "/shuffle_" in line}


def left_over(spark, before):
    until = time.time() + 5  # removed in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    return shuffle_files(spark) - before


def test_shuffle_files_go_with_their_write(spark, folder):
    rows = spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).count()
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(cleanup), shuffle_files(spark)
    sinks.replace_folder(rows.hint("rebalance"), f"{folder}/rows")
    queries.deliver(rows.select(F.col("k").cast("string").alias("value")), f"{folder}/lines")
    assert not left_over(spark, before) and spark.conf.get(cleanup) == setting
    assert spark.read.parquet(f"{folder}/rows").count() == spark.read.text(f"{folder}/lines").count() == 7


def test_a_feed_goes_when_the_quarantine_has_worked_it_off(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "new_folder", lambda _, label: f"{folder}/{label}")
    monkeypatch.setattr(queries.d, "BROKEN_FEEDS", {"social": lambda spark, _: spark.createDataFrame(
        [('{"post_id":"a","event_ts":"2024-01-05T10:00:00+00:00"}',), ("{cut",)], "value string")})
    found = queries.stream_quarantine(spark, folder)
    assert sorted(tuple(r) for r in found.collect()) == [("social", "accepted", 1, 1), ("social", "malformed_json", 1, 0)]
    assert [n for n in os.listdir(folder) if n.startswith("feed-")] == []


def test_layers_of_events_leave_no_shuffle_files(spark, folder):
    stamp = F.make_timestamp(F.lit(2024), F.lit(1), (F.col("id") % 3 + 5).cast("int"), F.lit(1), F.lit(2), F.lit(3))
    events = spark.range(0, 90, 1, 4).select(
        F.concat(F.lit("r"), F.col("id") % 30).alias("reading_id"), stamp.cast("string").alias("event_ts"), F.lit("L1").alias("location_id"))
    before = shuffle_files(spark)
    sinks.write_silver(silver.to_silver(events, ENTITIES["sensors"], "b1"), f"{folder}/silver", "sensors", "b1")
    stored = layers.read_silver(spark, f"{folder}/silver", "sensors")
    sinks.write_gold_fact(gold.build_fact("fact_sensor_readings", stored), f"{folder}/gold", "fact_sensor_readings", many_days=True)
    assert not left_over(spark, before)
    assert {(r._day, r._batch_id) for r in stored.collect()} == {(5, "b1"), (6, "b1"), (7, "b1")} and stored.count() == 30
    assert layers.read_gold_partition(spark, f"{folder}/gold", "fact_sensor_readings").count() == 30


def test_feeds_go_when_they_have_landed(spark, folder, monkeypatch):
    at = '"2024-01-05T10:00:00+00:00"'
    messages = {
        "transactions": [f'{{"event_type":"order_created","order_id":"o1","customer_id":"c1","product_id":"p1","quantity":2,"unit_price":10.5,'
                         f'"total_amount":21.0,"status":"shipped","event_ts":{at}}}',
                         f'{{"event_type":"customer_registered","customer_id":"c1","region":"North","created_at":{at}}}',
                         f'{{"event_type":"product_created","product_id":"p1","category":"Books","created_at":{at}}}'],
        "sensors": [f'{{"reading_id":"r1","event_ts":{at}}}'], "social": [f'{{"post_id":"s1","event_ts":{at}}}'],
        "financial": [f'{{"event_type":"trade_executed","trade_id":"t1","event_ts":{at}}}'],
    }
    monkeypatch.setattr(queries, "new_folder", lambda _, label: f"{folder}/{label}")
    monkeypatch.setattr(queries.d, "FEEDS", {
        topic: lambda spark, _, lines=lines: spark.createDataFrame([(line,) for line in lines], "value string") for topic, lines in messages.items()})
    found = queries.medallion_daily_revenue(spark, folder).collect()
    assert [(r.region, r.category, r.total_orders, r.total_revenue, r.total_units) for r in found] == [("North", "Books", 1, 21.0, 2)]
    assert sorted(n for n in os.listdir(folder) if not n.startswith(".")) == ["bronze", "gold", "silver"]
