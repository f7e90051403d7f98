"""Streams equal batch; replays, bad lines, lateness and failures."""

import json
import os
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.casting import cast_to_schema
from tidemark.operators import runlog
from tidemark.plans.medallion import Lake, build_marts, run_day
from tidemark.plans.gold import build_fact
from tidemark.schemas import ENTITIES, topic_schema
from tidemark.sources.events import parse_events, read_events
from tidemark.sources.layers import read_bronze, read_silver, read_streamed
from tidemark.streaming import hours, landing, quarantine, stateful, topics
from tidemark.streaming.settings import drain, writer

START = datetime(2024, 1, 5, 10)


def stamp(minutes=0.0):
    return (START + timedelta(minutes=minutes)).isoformat() + "+00:00"


def order(key, minutes=0, **other):
    return {"event_type": "order_created", "source": "ecommerce", "order_id": key, "customer_id": "c1", "product_id": "p1",
            "quantity": 2, "unit_price": 10.5, "total_amount": 21.0, "status": "shipped", "event_ts": stamp(minutes), **other}


CUSTOMER = {"event_type": "customer_registered", "customer_id": "c1", "region": "North", "created_at": stamp()}
PRODUCT = {"event_type": "product_created", "product_id": "p1", "category": "Books", "price": 10.5, "created_at": stamp()}


def feed(folder, name, *messages):
    """A file of messages; text that is no dict is written as it is."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.txt", "w") as out:
        out.writelines((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages)
    return {"format": "text", "path": folder}


def run_typed(spark, topic, root, options):
    return drain(topics.stream_topic(spark, topic, root, options, available_now=True))


def test_typed_stream_equals_batch_and_resumes(spark, folder):
    src, root = f"{folder}/src", f"{folder}/silver"
    first = {"reading_id": "a", "temperature": 20.5, "is_anomaly": True, "event_ts": stamp(), "sensor_type": "x"}
    options = feed(src, "1", first, {"reading_id": "no time"}, "garbage", "")
    run_typed(spark, "sensors", root, options)
    run_typed(spark, "sensors", root, options)  # nothing new: nothing added
    feed(src, "2", {"reading_id": "b", "temperature": "abc", "event_ts": stamp(24 * 60)})
    run_typed(spark, "sensors", root, options)
    table = read_streamed(spark, root, "sensors")
    assert sorted((r.reading_id, r.temperature, r.is_anomaly, r._day) for r in table.collect()) == [
        ("a", 20.5, True, 5), ("b", None, None, 6)]
    batch = parse_events(spark.read.text(src), ENTITIES["sensors"].schema).filter("event_ts is not null")
    same = [c for c in batch.columns]
    assert sorted(map(str, table.select(same).collect())) == sorted(map(str, batch.select(same).collect()))
    assert dict(table.dtypes) == {f.name: f.dataType.simpleString() for f in ENTITIES["sensors"].silver_schema.fields}
    assert {r._batch_id for r in table.collect()} == {"stream_sensors_000000000", "stream_sensors_000000001"}


def test_mixed_topic_is_routed_and_a_replayed_batch_replaces_itself(spark, folder):
    root = f"{folder}/silver"
    options = feed(f"{folder}/src", "1", order("o1"), CUSTOMER, PRODUCT, {"event_type": "customer_registered"},
                   {"event_type": "order_created", "order_id": "no time"}, {"event_type": "other"})
    drain(topics.stream_transactions(spark, root, options, available_now=True))
    assert [r.order_id for r in read_streamed(spark, root, "transactions").collect()] == ["o1"]
    assert [r.region for r in read_streamed(spark, root, "customers").collect()] == ["North"]
    product = read_streamed(spark, root, "products").collect()
    assert [(r.category, r.event_ts, r._day) for r in product] == [("Books", START, 5)]
    rows = read_streamed(spark, root, "products")
    for _ in range(2):  # the same batch again
        topics.write_batch_part(rows, f"{folder}/again/products", topics.batch_name("transactions", 7))
    assert read_streamed(spark, f"{folder}/again", "products").count() == 1


def test_files_follow_the_data_not_the_days(spark, folder):
    days = 400
    options = feed(f"{folder}/src", "1", *[order(f"o{i}", minutes=i * 24 * 60) for i in range(days)], CUSTOMER, PRODUCT)
    root = f"{folder}/silver"
    drain(topics.stream_transactions(spark, root, options, available_now=True))
    for table, rows in (("transactions", days), ("customers", 1), ("products", 1)):
        stored = read_streamed(spark, root, table)
        assert stored.count() == rows and len(stored.inputFiles()) <= 2
    assert read_streamed(spark, root, "transactions", "2024-01-07").count() == 1


def test_gathered_batches_move_into_silver_once(spark, folder):
    src, streamed, silver = f"{folder}/src", f"{folder}/streamed", f"{folder}/silver"
    for part in range(3):
        options = feed(src, str(part), {"reading_id": f"r{part}", "event_ts": stamp(part * 24 * 60)}, {"reading_id": "twice", "event_ts": stamp()})
        run_typed(spark, "sensors", streamed, options)
    assert read_streamed(spark, streamed, "sensors").count() == 6
    name = topics.gather_streamed(spark, streamed, silver, "sensors")
    assert name.startswith("stream_sensors_000000002_") and name.endswith("_gathered")
    assert read_streamed(spark, streamed, "sensors").isEmpty()
    assert topics.gather_streamed(spark, streamed, silver, "sensors") is None
    stored = read_silver(spark, silver, "sensors")
    assert stored.count() == 6 and read_silver(spark, silver, "sensors", "2024-01-06").count() == 1
    assert build_fact("fact_sensor_readings", stored).count() == 4
    options = feed(src, "9", {"reading_id": "late", "event_ts": stamp()})
    run_typed(spark, "sensors", streamed, options)  # goes on after the gathering
    assert [r.reading_id for r in read_streamed(spark, streamed, "sensors").collect()] == ["late"]


def test_gathering_leaves_what_is_being_written(spark, folder):
    src, streamed, silver = f"{folder}/src", f"{folder}/streamed", f"{folder}/silver"
    options = feed(src, "0", {"reading_id": "a", "event_ts": stamp()})
    run_typed(spark, "sensors", streamed, options)
    path = f"{streamed}/sensors/_batch_id=stream_sensors_"
    os.makedirs(f"{path}000000001/_temporary/0")  # in flight
    shutil.copytree(f"{path}000000000", f"{path}000000002")  # written, its stream has not committed it
    assert topics.gather_streamed(spark, streamed, silver, "sensors")
    assert os.path.isdir(f"{path}000000001/_temporary/0") and os.path.isdir(f"{path}000000002") and not os.path.isdir(f"{path}000000000")
    feed(src, "1", {"reading_id": "b", "event_ts": stamp()})
    feed(src, "2", {"reading_id": "c", "event_ts": stamp(1)})
    run_typed(spark, "sensors", streamed, options)  # writes batch 1 whole
    assert topics.gather_streamed(spark, streamed, silver, "sensors")
    rows = read_silver(spark, silver, "sensors").unionByName(read_streamed(spark, streamed, "sensors"))
    assert sorted({r.reading_id for r in rows.collect()}) == ["a", "b", "c"]


def test_replayed_batch_is_not_gathered_twice(spark, folder):
    src, streamed, silver = f"{folder}/src", f"{folder}/streamed", f"{folder}/silver"
    options = feed(src, "0", {"reading_id": "a", "event_ts": stamp()})
    run_typed(spark, "sensors", streamed, options)
    batch = f"{streamed}/sensors/_batch_id=stream_sensors_000000000"
    shutil.copytree(batch, f"{folder}/copy")
    assert topics.gather_streamed(spark, streamed, silver, "sensors")
    shutil.copytree(f"{folder}/copy", batch)
    assert topics.gather_streamed(spark, streamed, silver, "sensors") is None
    assert not os.path.isdir(batch) and read_silver(spark, silver, "sensors").count() == 1
    # A stream that begins again with an empty checkpoint uses the same numbers for other rows: nothing is lost.
    other = feed(f"{folder}/other", "0", {"reading_id": "b", "event_ts": stamp()})
    drain(topics.append_stream(topics.typed_stream(read_events(spark, "sensors", other), topic_schema("sensors")), ENTITIES["sensors"],
                               streamed, "again", f"{folder}/cp", True))
    assert topics.gather_streamed(spark, streamed, silver, "sensors", f"{folder}/cp")
    assert sorted(r.reading_id for r in read_silver(spark, silver, "sensors").collect()) == ["a", "b"]


def test_nothing_to_gather(spark, folder):
    assert topics.gather_streamed(spark, f"{folder}/none", f"{folder}/silver", "sensors") is None


def test_landing_keeps_every_key_as_text(spark, folder):
    options = feed(f"{folder}/src", "1", order("o1", note="hello", nested={"a": 1}), {**order("o2"), "status": None, "quantity": 3},
                   "garbage", '{"order_id": "cut')
    arrived = F.lit("2024-02-03 04:05:06").cast("timestamp")
    stream = read_events(spark, "transactions", options)
    drain(landing.land_bronze(stream, "transactions", f"{folder}/bronze", f"{folder}/cp", True, arrived))
    rows = {r.order_id: r for r in read_bronze(spark, f"{folder}/bronze", "transactions", "2024-02-03").collect()}
    assert set(rows) == {"o1", "o2"}
    assert (rows["o1"].total_amount, rows["o1"].quantity, rows["o2"].quantity, rows["o2"].status) == ("21.0", "2", "3", None)
    extra = rows["o1"]._extra
    assert (extra["note"], json.loads(extra["nested"]), extra["source"]) == ("hello", {"a": 1}, "ecommerce")
    assert rows["o2"]._extra == {"source": "ecommerce"}
    assert (rows["o1"].hour, rows["o1"].source, rows["o1"].email) == ("04", "transactions", None)
    typed = cast_to_schema(read_bronze(spark, f"{folder}/bronze", "transactions", "2024-02-03"), ENTITIES["transactions"].schema)
    assert {r.order_id: r.event_ts for r in typed.collect()} == {"o1": START, "o2": START}


def test_two_topics_land_side_by_side(spark, folder):
    arrived = F.lit("2024-02-03 04:05:06").cast("timestamp")
    for topic, key in (("sensors", "reading_id"), ("social", "post_id")):
        options = feed(f"{folder}/{topic}", "1", {key: "x", "event_ts": stamp()})
        stream = read_events(spark, topic, options)
        drain(landing.land_bronze(stream, topic, f"{folder}/bronze", f"{folder}/cp/{topic}", True, arrived))
    assert read_bronze(spark, f"{folder}/bronze", "sensors", "2024-02-03").count() == 1
    assert read_bronze(spark, f"{folder}/bronze", "social", "2024-02-03").count() == 1


def test_quarantine_names_the_reason(spark, folder):
    good = {"reading_id": "a", "temperature": 1.0, "event_ts": stamp()}
    lines = [good, "{cut", {**good, "temperature": "abc"}, {"event_ts": stamp()}, {**good, "reading_id": ""},
             {"reading_id": "t"}, {**good, "event_ts": "yesterday"}]
    options = feed(f"{folder}/src", "1", *lines)
    drain(quarantine.quarantine_stream(read_events(spark, "sensors", options), "sensors", f"{folder}/good",
                                       f"{folder}/bad", f"{folder}/cp", True))
    assert [r.reading_id for r in spark.read.parquet(f"{folder}/good").collect()] == ["a"]
    bad = {r.value: r.reason for r in spark.read.parquet(f"{folder}/bad").collect()}
    assert bad == {
        "{cut": "malformed_json", json.dumps(lines[2]): "bad_field", json.dumps(lines[3]): "missing_key",
        json.dumps(lines[4]): "missing_key", json.dumps(lines[5]): "missing_event_time",
        json.dumps(lines[6]): "missing_event_time"}


def test_quarantine_checks_each_event_by_its_type(spark, folder):
    transfer = {"event_type": "transfer", "transfer_id": "t", "event_ts": stamp()}
    cases = {
        "transactions": [(order("o1"), None), (CUSTOMER, None), (PRODUCT, None), ({**CUSTOMER, "customer_id": None}, "missing_key"),
                         ({**PRODUCT, "created_at": None}, "missing_event_time"), ({**PRODUCT, "price": "abc"}, "bad_field"),
                         ({**order("o2"), "event_type": "other"}, "unknown_type"), ({"order_id": "o3", "event_ts": stamp()}, "unknown_type"),
                         ({**order("o4"), "order_id": ""}, "missing_key"), ("[1", "malformed_json")],
        "financial": [(transfer, None), ({**transfer, "transfer_id": None}, "missing_key"),
                      ({"event_type": "trade_executed", "trade_id": "x", "event_ts": stamp()}, None),
                      ({"event_type": "trade_executed", "transfer_id": "x", "event_ts": stamp()}, "missing_key")],
    }
    for topic, lines in cases.items():
        options = feed(f"{folder}/{topic}", "1", *[m for m, _ in lines])
        drain(quarantine.quarantine_stream(read_events(spark, topic, options), topic, f"{folder}/good/{topic}",
                                           f"{folder}/bad/{topic}", f"{folder}/cp/{topic}", True))
        bad = {r.value: r.reason for r in spark.read.parquet(f"{folder}/bad/{topic}").collect()}
        assert bad == {m if isinstance(m, str) else json.dumps(m): reason for m, reason in lines if reason}
        assert spark.read.parquet(f"{folder}/good/{topic}").count() == sum(reason is None for _, reason in lines)


def test_quarantine_holds_no_messages(spark, folder, monkeypatch):
    held, write = [], quarantine.write_batch_part

    def written(rows, *args):
        write(rows, *args)
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())

    monkeypatch.setattr(quarantine, "write_batch_part", written)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    options = feed(f"{folder}/src", "1", order("o1"), {**order("o2"), "order_id": None}, "{cut", "", "null")
    drain(quarantine.quarantine_stream(read_events(spark, "transactions", options), "transactions", f"{folder}/good",
                                       f"{folder}/bad", f"{folder}/cp", True))
    assert held == [before] * 2
    assert [r.order_id for r in spark.read.parquet(f"{folder}/good").collect()] == ["o1"]
    assert sorted((r.reason, r.value[:4]) for r in spark.read.parquet(f"{folder}/bad").collect()) == [
        ("malformed_json", "null"), ("malformed_json", "{cut"), ("missing_key", '{"ev'), ("unknown_type", "")]


def test_landing_reports_bad_messages_beside_the_raw_files(spark, folder):
    options = feed(f"{folder}/src", "1", order("o1"), {**order("o2"), "order_id": None}, "garbage")
    arrived = F.lit("2024-02-03 04:05:06").cast("timestamp")
    drain(landing.land_bronze(read_events(spark, "transactions", options), "transactions", f"{folder}/bronze",
                              f"{folder}/cp", True, arrived, f"{folder}/bad"))
    assert read_bronze(spark, f"{folder}/bronze", "transactions", "2024-02-03").count() == 2
    assert sorted(r.reason for r in spark.read.parquet(f"{folder}/bad/transactions").collect()) == ["malformed_json", "missing_key"]


def test_no_progress_is_lost_beyond_what_spark_remembers(spark, folder):
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    log = runlog.ProgressLog(spark, f"{folder}/progress")
    spark.streams.addListener(log)
    try:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
        for part in range(6):
            options = feed(f"{folder}/src", str(part), {"reading_id": f"r{part}", "event_ts": stamp()})
        query = run_typed(spark, "sensors", f"{folder}/silver", options | {"maxFilesPerTrigger": "1"})
        log.wait(query)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert len(query.recentProgress) <= 2
    progress = runlog.topic_progress(spark, log.path).collect()
    assert sorted(r.batch_id for r in progress) == list(range(6)) and sum(r.num_input_rows for r in progress) == 6
    for _ in range(2):  # a second call adds nothing
        runlog.record_stream_runs(spark, f"{folder}/runs", log.path, "silver")
    runs = spark.read.parquet(f"{folder}/runs").collect()
    assert len(runs) == 6 and {(r.dag_id, r.stage, r.status, r.rows_read) for r in runs} == {("silver_sensors", "silver", "success", 1)}
    assert all(r.finished_at >= r.started_at for r in runs)


def test_duplicates_within_the_lateness_are_dropped_across_batches(spark, folder):
    src, out = f"{folder}/src", f"{folder}/out"

    def run():
        events = parse_events(read_events(spark, "sensors", options), ENTITIES["sensors"].schema)
        drain(writer(stateful.dedup_stream(events, "reading_id", "1 hour"), "d", f"{folder}/cp", True)
              .format("parquet").start(out))

    options = feed(src, "1", {"reading_id": "a", "event_ts": stamp()}, {"reading_id": "a", "event_ts": stamp(1)},
                   {"reading_id": None, "event_ts": stamp()})
    run()
    feed(src, "2", {"reading_id": "a", "event_ts": stamp(5)}, {"reading_id": "b", "event_ts": stamp(180)})
    run()
    feed(src, "3", {"reading_id": "b", "event_ts": stamp(181)}, {"reading_id": "late", "event_ts": stamp(10)})
    run()
    assert sorted(r.reading_id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_a_key_repeated_without_end_is_cut_before_its_own_task(spark, folder):
    copies = [{"reading_id": "hot", "event_ts": stamp()}] * 500
    others = [{"reading_id": f"r{i}", "event_ts": stamp(i)} for i in range(20)]
    src, out = f"{folder}/src", f"{folder}/out"
    for part in range(4):
        options = feed(src, str(part), *copies, *others)
    events = parse_events(read_events(spark, "sensors", options), ENTITIES["sensors"].schema)
    query = drain(writer(stateful.dedup_stream(events, "reading_id", "1 day", lanes=4), "lanes", f"{folder}/cp", True)
                  .format("parquet").start(out))
    rows = spark.read.parquet(out)
    assert rows.count() == rows.select("reading_id").distinct().count() == 21
    assert "_lane" not in rows.columns
    states = query.recentProgress[0]["stateOperators"]
    assert len(states) == 2
    assert min(s["numRowsUpdated"] for s in states) == 21 < max(s["numRowsUpdated"] for s in states) <= 4 * 21


def test_hours_are_emitted_once_and_late_readings_ignored(spark, folder):
    src, out = f"{folder}/src", f"{folder}/out"

    def row(minutes, temperature):
        return {"reading_id": "x", "location_id": "L1", "temperature": temperature, "event_ts": stamp(minutes)}

    def run():
        events = parse_events(read_events(spark, "sensors", options), ENTITIES["sensors"].schema)
        hourly = stateful.hourly_sensor_stream(events, "30 minutes")
        drain(writer(hourly, "h", f"{folder}/cp", True).outputMode("append").format("parquet").start(out))

    options = feed(src, "1", row(0, 10.0), row(59, 20.0), row(60, 50.0))
    run()
    feed(src, "2", row(200, 1.0))
    run()
    feed(src, "3", row(10, 99.0), row(500, 1.0))
    run()
    got = sorted((r.hour_ts.hour, r.avg_temp, r.reading_count) for r in spark.read.parquet(out).collect())
    assert got == [(10, 15.0, 2), (11, 50.0, 1), (13, 1.0, 1)]


def newest_of(spark, folder, options, apart="1 hour"):
    events = parse_events(read_events(spark, "sensors", options), ENTITIES["sensors"].schema)
    newest = stateful.newest_stream(events, "reading_id", apart, "30 minutes")
    return drain(writer(newest, "n", f"{folder}/cp", True).outputMode("append").format("parquet").start(f"{folder}/out"))


def test_newest_copy_is_emitted_once_whatever_the_order(spark, folder):
    def row(key, minutes, temperature):
        return {"reading_id": key, "temperature": temperature, "event_ts": stamp(minutes)}

    src, same = f"{folder}/src", row("tie", 3, 1.0)
    options = feed(src, "1", row("a", 30, 3.0), row("a", 0, 1.0), row(None, 0, 1.0), same, row("tie", 3, 2.0), same,
                   {"reading_id": "no time"}, row("no value", 1, None))
    newest_of(spark, folder, options)
    feed(src, "2", row("a", 15, 2.0), row("b", 300, 1.0))
    newest_of(spark, folder, options)
    feed(src, "3", row("c", 900, 1.0))
    query = newest_of(spark, folder, options)
    rows = [(r.reading_id, r.temperature, r.event_ts.minute) for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(rows, key=str) == [("a", 3.0, 30), ("b", 1.0, 0), ("no value", None, 1), ("tie", 2.0, 3)]
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1  # c: the others have left the state


def test_newest_copy_costs_one_row_a_task(spark, folder):
    src = f"{folder}/src"
    for part in range(4):
        options = feed(src, str(part), *[{"reading_id": "hot", "temperature": float(i), "event_ts": stamp(i / 100)} for i in range(500)])
    query = newest_of(spark, folder, options)
    plan = query._jsq.explainInternal(False)
    assert plan.index("MergingSessions", plan.index("SessionWindowStateStoreRestore")) > 0
    assert "MergingSessions" in plan[plan.index("Exchange"):]  # also below the shuffle
    assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] == 1


def late_run(spark, folder, options):
    events = parse_events(read_events(spark, "sensors", options), ENTITIES["sensors"].schema)
    return drain(hours.hourly_with_late(events, f"{folder}/out", f"{folder}/cp", timedelta(minutes=30), available_now=True))


def hours_of(spark, folder):
    return sorted((r.hour_ts.hour, r.location_id, r.avg_temp, r.reading_count) for r in hours.read_hours(spark, f"{folder}/out").collect())


def reading_at(minutes, temperature, location="L1"):
    return {"reading_id": "x", "location_id": location, "temperature": temperature, "event_ts": stamp(minutes)}


def test_late_readings_are_kept_and_folded_once(spark, folder):
    src, out, schema = f"{folder}/src", f"{folder}/out", ENTITIES["sensors"].schema
    options = feed(src, "1", reading_at(0, 10.0), reading_at(59, 20.0), reading_at(60, None), {"reading_id": "no time"})
    late_run(spark, folder, options)
    assert hours.read_late(spark, out, schema).count() == 0 and hours.fold_late(spark, out, f"{folder}/cp") == []
    feed(src, "2", reading_at(200, 1.0), reading_at(20, 30.0))  # the old one is in time: its hour closes after this batch
    late_run(spark, folder, options)
    assert hours_of(spark, folder) == [(10, "L1", 20.0, 3), (11, "L1", None, 1)]
    feed(src, "3", reading_at(10, 100.0), reading_at(-50, 5.0, "L2"), reading_at(201, 3.0))
    late_run(spark, folder, options)
    assert sorted(r.temperature for r in hours.read_late(spark, out, schema).collect()) == [5.0, 100.0]
    assert hours_of(spark, folder) == [(10, "L1", 20.0, 3), (11, "L1", None, 1)]
    assert hours.fold_late(spark, out, f"{folder}/cp") == [2024010509, 2024010510]
    want = [(9, "L2", 5.0, 1), (10, "L1", 40.0, 4), (11, "L1", None, 1)]
    assert hours_of(spark, folder) == want
    assert hours.fold_late(spark, out, f"{folder}/cp") == []
    shutil.rmtree(f"{out}/_folded")  # a run that died before its marks: done again, nothing counted twice
    hours.fold_late(spark, out, f"{folder}/cp")
    assert hours_of(spark, folder) == want


def test_replayed_batch_of_readings_changes_nothing(spark, folder):
    src = f"{folder}/src"
    options = feed(src, "1", reading_at(0, 10.0), reading_at(300, 1.0))
    late_run(spark, folder, options)
    feed(src, "2", reading_at(5, 50.0), reading_at(310, 2.0), reading_at(500, 1.0))
    late_run(spark, folder, options)
    hours.fold_late(spark, f"{folder}/out", f"{folder}/cp")
    before = hours_of(spark, folder)
    assert before == [(10, "L1", 30.0, 2), (15, "L1", 1.5, 2)]
    last = max(int(n) for n in os.listdir(f"{folder}/cp/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{folder}/cp/commits/{name}"):
            os.remove(f"{folder}/cp/commits/{name}")
    late_run(spark, folder, options)
    hours.fold_late(spark, f"{folder}/out", f"{folder}/cp")
    assert hours_of(spark, folder) == before
    assert hours.read_late(spark, f"{folder}/out", ENTITIES["sensors"].schema).count() == 1


def every_topic(folder):
    return {
        "transactions": feed(f"{folder}/t", "1", order("o1"), order("o1", minutes=5, total_amount=42.0), CUSTOMER, PRODUCT),
        "sensors": feed(f"{folder}/s", "1", {"reading_id": "a", "location_id": "L1", "temperature": 20.0, "pressure": 1000.0,
                                             "humidity": 50.0, "event_ts": stamp()}),
        "financial": feed(f"{folder}/f", "1",
                          {"event_type": "trade_executed", "trade_id": "x", "asset": "btc", "side": "buy", "quantity": 1.5,
                           "price": 10.0, "total_value": 15.0, "event_ts": stamp()},
                          {"event_type": "transfer", "transfer_id": "y", "event_ts": stamp()}),
        "social": feed(f"{folder}/p", "1", {"post_id": "p", "platform": "reddit", "likes": 3, "event_ts": stamp()}),
    }


def test_all_topics_at_once(spark, folder):
    started = topics.run_all(spark, f"{folder}/silver", every_topic(folder), available_now=True)
    assert len(started) == 4 and not any(q.isActive for q in started)
    counts = {t: read_streamed(spark, f"{folder}/silver", t).count() for t in ENTITIES}
    assert counts == {"transactions": 2, "customers": 1, "products": 1, "sensors": 1, "financial": 1, "social": 1}


def test_a_failing_stream_is_raised_and_the_others_stop(spark, folder):
    options = every_topic(folder)
    os.makedirs(f"{folder}/broken")
    open(f"{folder}/broken/sensors", "w").close()  # a file where the table should be
    with pytest.raises(Exception):
        topics.run_all(spark, f"{folder}/broken", options, available_now=True)
    assert not spark.streams.active


def test_whole_day_through_all_layers(spark, folder):
    lake = Lake(f"{folder}/bronze", f"{folder}/silver", f"{folder}/gold")
    arrived = F.lit("2024-01-05 12:00:00").cast("timestamp")
    for topic, options in every_topic(folder).items():
        stream = read_events(spark, topic, options)
        drain(landing.land_bronze(stream, topic, lake.bronze, f"{folder}/cp/{topic}", True, arrived))
    for _ in range(2):
        run_day(spark, lake, "2024-01-05", gold_date="2024-01-05")
    found = build_marts(spark, lake)
    revenue = found["agg_daily_revenue"].collect()
    assert [(r.region, r.category, r.total_orders, float(r.total_revenue)) for r in revenue] == [("North", "Books", 1, 42.0)]
    assert [(r.location_id, r.anomaly_flag) for r in found["agg_hourly_sensor"].collect()] == [("L1", 0)]
    assert [(r.asset, r.trade_count, r.buy_count) for r in found["agg_trading_volume"].collect()] == [("BTC", 1, 1)]
