"""Every sink run twice, late events, empty runs and windows cut inside a partition."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import sinks
from tidemark.operators.maintenance import store_table
from tidemark.plans import gold, refresh, reports
from tidemark.plans.gold import build_fact
from tidemark.plans.silver import bronze_to_silver
from tidemark.schemas import WAREHOUSE
from tidemark.session import new_folder, working_root
from tidemark.sources.layers import discover_layer, read_bronze, read_gold_partition, read_silver, read_warehouse, register_layer

DAY = datetime(2024, 1, 5)


def land(spark, root, day, hour, rows):
    """Raw files as another writer may leave them: only the columns of that flush."""
    names = sorted({k for r in rows for k in r})
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows],
                               ", ".join(f"{n} string" for n in names))
    df.write.parquet(f"{root}/source=sensors/year={day[:4]}/month={day[5:7]}/day={day[8:]}/hour={hour:02d}")


def reading(key, ts, temperature="20.5"):
    return {"reading_id": key, "event_ts": ts, "temperature": temperature, "location_id": "L1"}


def silver_rows(spark, root):
    return sorted((r.reading_id, r.event_ts.isoformat(), r.temperature, r._batch_id)
                  for r in read_silver(spark, root, "sensors").collect())


def test_a_raw_day_run_every_hour_replaces_itself_and_keeps_late_events(spark, folder):
    bronze, silver = f"{folder}/bronze", f"{folder}/silver"
    land(spark, bronze, "2024-01-05", 10, [reading("a", "2024-01-05T10:00:00"), reading("b", "2024-01-05T10:00:00")])
    bronze_to_silver(spark, bronze, silver, "sensors", "2024-01-05")
    # the next raw day brings a late event of the 5th
    land(spark, bronze, "2024-01-06", 0, [reading("late", "2024-01-05T23:59:59"), reading("c", "2024-01-06T00:00:01")])
    bronze_to_silver(spark, bronze, silver, "sensors", "2024-01-06")
    # the 5th is run again after another hour; b moved to another event day
    land(spark, bronze, "2024-01-05", 11, [reading("b", "2024-01-06T11:00:00", "30"), reading("d", "2024-01-05T11:00:00")])
    for _ in range(2):
        bronze_to_silver(spark, bronze, silver, "sensors", "2024-01-05")
    first, second = "sensors_2024-01-05", "sensors_2024-01-06"
    assert silver_rows(spark, silver) == [
        ("a", "2024-01-05T10:00:00", 20.5, first), ("b", "2024-01-06T11:00:00", 30.0, first),
        ("c", "2024-01-06T00:00:01", 20.5, second), ("d", "2024-01-05T11:00:00", 20.5, first),
        ("late", "2024-01-05T23:59:59", 20.5, second)]
    assert sorted(r.reading_id for r in read_silver(spark, silver, "sensors", "2024-01-06").collect()) == ["b", "c"]


def test_raw_files_with_different_columns(spark, folder):
    land(spark, folder, "2024-01-05", 1, [{"reading_id": "a", "event_ts": "2024-01-05T01:00:00"}])
    land(spark, folder, "2024-01-05", 2, [reading("b", "2024-01-05T02:00:00") | {"extra": "x"}])
    fixed = read_bronze(spark, folder, "sensors", "2024-01-05")
    assert {r.reading_id: r.temperature for r in fixed.collect()} == {"a": None, "b": "20.5"}
    merged = read_bronze(spark, folder, "sensors", date(2024, 1, 5), merge_schema=True)
    assert {r.reading_id: r.extra for r in merged.collect()} == {"a": None, "b": "x"}


def trades(spark, *rows):
    return spark.createDataFrame(
        [(i, "BTC", "buy", 1.0, Decimal(p), Decimal(p), k) for i, p, k in rows],
        "trade_id string, asset string, side string, quantity float, price decimal(18,8), "
        "total_value decimal(18,4), date_key int").withColumn("event_ts", F.to_timestamp(F.col("date_key").cast("string"), "yyyyMMdd"))


def keys(df):
    return sorted((r.trade_id, r.date_key) for r in df.collect())


def test_gold_keeps_the_days_it_does_not_write(spark, folder):
    sinks.write_gold_fact(trades(spark, ("a", 1, 20240105), ("b", 1, 20240106)), folder, "fact_trades")
    for _ in range(2):
        sinks.write_gold_fact(trades(spark, ("c", 1, 20240106)), folder, "fact_trades", many_days=True)
    assert keys(read_gold_partition(spark, folder, "fact_trades")) == [("a", 20240105), ("c", 20240106)]
    assert keys(read_gold_partition(spark, folder, "fact_trades", 20240106)) == [("c", 20240106)]


def test_load_replaces_one_day_also_by_nothing(spark, folder):
    sinks.load_fact(trades(spark, ("a", 1, 20240105)), folder, "fact_trades", 20240105)
    for _ in range(2):
        sinks.load_fact(trades(spark, ("b", 1, 20240106), ("x", 1, 20240107)), folder, "fact_trades", 20240106)
    table = read_warehouse(spark, folder, "fact_trades")
    assert keys(table) == [("a", 20240105), ("b", 20240106)]
    sinks.load_fact(trades(spark).limit(0), folder, "fact_trades", 20240106)
    table = read_warehouse(spark, folder, "fact_trades")
    assert keys(table) == [("a", 20240105)]


def test_dimension_load_goes_by_name(spark, folder):
    gold = spark.createDataFrame([("n", "c1", "North", "x@y", "18-25", DAY)],
                                 "name string, customer_id string, region string, email string, age_group string, created_at timestamp")
    for _ in range(2):
        path = sinks.load_dim(gold, folder, "dim_customer")
    row = spark.read.parquet(path).collect()
    assert [(r.customer_id, r.email, r.name, r.region) for r in row] == [("c1", "x@y", "n", "North")]
    assert spark.read.parquet(path).columns == WAREHOUSE["dim_customer"].schema.names


def hours(spark, *rows):
    return spark.createDataFrame([(ts, "L1", 1.0, 1.0, 1.0, n, 0, None) for ts, n in rows],
                                 WAREHOUSE["agg_hourly_sensor"].schema)


def stored_hours(spark, root):
    df = read_warehouse(spark, root, "agg_hourly_sensor")
    return sorted((r.hour_ts, r.reading_count) for r in df.collect())


def test_window_rebuild_in_the_middle_of_a_day(spark, folder):
    table = WAREHOUSE["agg_hourly_sensor"]
    start = DAY - timedelta(days=1)
    sinks.write_window(spark, hours(spark, *[(start + timedelta(hours=h), 1) for h in range(0, 48)]), folder, table, start)
    cutoff = DAY + timedelta(hours=22)
    fresh = hours(spark, (cutoff, 7), (cutoff + timedelta(hours=3), 9), (cutoff - timedelta(hours=1), 99))
    for _ in range(2):
        sinks.write_window(spark, fresh, folder, table, cutoff)
    rows = stored_hours(spark, folder)
    assert len(rows) == 46 + 2
    assert rows[-3:] == [(cutoff - timedelta(hours=1), 1), (cutoff, 7), (cutoff + timedelta(hours=3), 9)]


def test_window_rebuild_removes_days_without_rows(spark, folder):
    table = WAREHOUSE["agg_hourly_sensor"]
    sinks.write_window(spark, hours(spark, (DAY, 1), (DAY + timedelta(days=1), 2), (DAY + timedelta(days=2), 3)),
                       folder, table, DAY)
    sinks.write_window(spark, hours(spark, (DAY + timedelta(days=2), 5)), folder, table, DAY + timedelta(days=1))
    assert stored_hours(spark, folder) == [(DAY, 1), (DAY + timedelta(days=2), 5)]
    sinks.write_window(spark, hours(spark), folder, table, DAY + timedelta(days=1))
    assert stored_hours(spark, folder) == [(DAY, 1)]


def test_a_rebuild_that_fails_halfway_loses_nothing(spark, folder):
    table = WAREHOUSE["agg_hourly_sensor"]
    sinks.write_window(spark, hours(spark, *[(DAY + timedelta(hours=h), 1) for h in range(6)]), folder, table, DAY)
    cutoff = DAY + timedelta(hours=4)
    fresh = hours(spark, (cutoff, 7), (cutoff + timedelta(hours=1), 8))
    broken = fresh.withColumn("reading_count", F.when(F.hour("hour_ts") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("reading_count")))
    with pytest.raises(Exception, match="lost"):
        sinks.write_window(spark, broken, folder, table, cutoff)
    assert stored_hours(spark, folder) == [(DAY + timedelta(hours=h), 1) for h in range(6)]
    sinks.write_window(spark, fresh, folder, table, cutoff)
    assert [n for _, n in stored_hours(spark, folder)] == [1, 1, 1, 1, 7, 8]


def test_a_rolling_read_opens_the_files_of_its_window_only(spark, folder, plan):
    table = WAREHOUSE["fact_sensor_readings"]
    rows = spark.range(30).select(
        F.col("id").cast("string").alias("reading_id"), F.lit("L1").alias("location_id"), F.lit(20.0).alias("temperature"),
        (F.lit(DAY) + F.make_dt_interval(F.col("id").cast("int"))).alias("event_ts"))
    rows = rows.withColumn("date_key", F.date_format("event_ts", "yyyyMMdd").cast("int"))
    store_table(rows, folder, table)
    as_of = DAY + timedelta(days=29, hours=1)
    window = read_warehouse(spark, folder, table.name, refresh.hour_cutoff(as_of))
    assert len(window.inputFiles()) == 2
    assert len(read_warehouse(spark, folder, table.name).inputFiles()) == 30
    for fresh in (refresh.refresh_hourly_sensor(read_warehouse(spark, folder, table.name), as_of),
                  reports.sensor_overview(read_warehouse(spark, folder, table.name), as_of)):
        text = plan(fresh)
        assert "PartitionFilters: [isnotnull(date_key" in text and ">= 202402" in text
    assert refresh.refresh_hourly_sensor(window, as_of).collect() == refresh.refresh_hourly_sensor(read_warehouse(spark, folder, table.name), as_of).collect()


def test_one_day_is_listed_alone(spark, folder):
    land(spark, f"{folder}/bronze", "2024-01-05", 10, [reading(f"r{i}", f"2024-01-{i + 1:02d}T10:00:00") for i in range(9)])
    bronze_to_silver(spark, f"{folder}/bronze", f"{folder}/silver", "sensors", "2024-01-05")
    one = read_silver(spark, f"{folder}/silver", "sensors", "2024-01-03")
    assert len(one.inputFiles()) == 1 and [(r.reading_id, r._batch_id, r._day) for r in one.collect()] == [("r2", "sensors_2024-01-05", 3)]
    assert read_silver(spark, f"{folder}/silver", "sensors", "2024-02-03").isEmpty()
    sinks.write_gold_fact(build_fact("fact_sensor_readings", read_silver(spark, f"{folder}/silver", "sensors")), f"{folder}/gold", "fact_sensor_readings")
    day = read_gold_partition(spark, f"{folder}/gold", "fact_sensor_readings", 20240103)
    assert len(day.inputFiles()) == 1 and day.first().date_key == 20240103
    assert read_gold_partition(spark, f"{folder}/gold", "fact_sensor_readings", 20250103).isEmpty()


@pytest.mark.parametrize("most", [0, 1 << 10, 1 << 30])
def test_a_rebuild_of_all_days_takes_whole_days_in_parts(spark, folder, monkeypatch, most):
    days = ["2023-12-31", "2024-01-05", "2024-01-06", "2024-02-10", "2024-10-02"]
    for batch, temperature in (("2024-11-01", "1.5"), ("2024-11-02", "2.5")):  # a second batch with the same keys and days
        land(spark, f"{folder}/bronze", batch, 10, [reading(f"{day}-{i}", f"{day}T{i:02d}:00:00", temperature) for day in days for i in range(3)])
        bronze_to_silver(spark, f"{folder}/bronze", f"{folder}/silver", "sensors", batch)
    parts, write = [], gold.write_gold_fact

    def written(rows, *args, **more):
        parts.append({r.date_key for r in rows.select("date_key").distinct().collect()})
        return write(rows, *args, **more)

    monkeypatch.setattr(gold, "FACTS", {"fact_sensor_readings": "sensors"})
    monkeypatch.setattr(gold, "DIMENSIONS", {})
    monkeypatch.setattr(gold, "write_gold_fact", written)
    monkeypatch.setattr(gold, "SLICE_BYTES", most // spark.sparkContext.defaultParallelism, raising=False)
    assert gold.silver_to_gold(spark, f"{folder}/silver", f"{folder}/gold", None) == [f"{folder}/gold/fact_sensor_readings"]
    assert len(parts) == (1 if most > 1 << 20 else 5)
    assert sorted(day for part in parts for day in part) == [20231231, 20240105, 20240106, 20240210, 20241002]

    def rows(df):
        return sorted((r.reading_id, r.date_key, r.event_ts, r.temperature) for r in df.collect())

    found = rows(read_gold_partition(spark, f"{folder}/gold", "fact_sensor_readings"))
    assert found == rows(build_fact("fact_sensor_readings", read_silver(spark, f"{folder}/silver", "sensors")))
    assert len(found) == 15 and {r[3] for r in found} == {2.5}


def test_rebuilt_frame_equals_rebuilt_table(spark):
    old, fresh = hours(spark, (DAY, 1), (DAY + timedelta(hours=1), 1)), hours(spark, (DAY + timedelta(hours=1), 4))
    out = sinks.rebuild_window(old, fresh, "hour_ts", DAY + timedelta(hours=1))
    assert sorted(r.reading_count for r in out.collect()) == [1, 4]


def test_tables_and_views(spark, folder):
    spec = WAREHOUSE["agg_trading_volume"]
    for _ in range(2):
        sinks.ensure_table(spark, "ensured_volume", spec.schema, ("full_date",), f"{folder}/ensured")
    assert set(spark.table("ensured_volume").columns) == set(spec.schema.names)
    numbers = spark.range(5)
    assert sinks.materialize(numbers, "numbers_view", "view").count() == 5
    for _ in range(2):
        assert sinks.materialize(numbers, "numbers_table", "table", f"{folder}/numbers").count() == 5
    with pytest.raises(ValueError):
        sinks.materialize(numbers, "x", "other")


def test_layer_discovery(spark, folder):
    land(spark, folder, "2024-01-05", 1, [{"reading_id": "a"}])
    found = {r.name: (r.type, r.is_partition) for r in discover_layer(spark, folder).collect()}
    assert found["reading_id"] == ("string", False)
    assert found["source"] == ("string", True) and found["hour"][1]


def test_registered_partitions_follow_the_folders(spark, folder):
    schema, name = "id int, _year int, _day int", "found_" + folder.rsplit("-", 1)[1]
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2024, 2)], schema)

    def found():
        return sorted(map(tuple, register_layer(spark, name, folder, rows.schema, ("_year", "_day")).collect()))
    assert found() == []
    rows.write.mode("append").partitionBy("_year", "_day").parquet(folder)
    assert spark.table(name).count() == 0  # not registered yet
    assert found() == [("2024", "1"), ("2024", "2")] and spark.table(name).where("_day = 2").count() == 2
    sinks.remove_folder(spark, f"{folder}/_year=2024/_day=1")
    assert found() == [("2024", "2")] and spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_log_rows_are_added(spark, folder):
    row = spark.createDataFrame([("i1", "q", DAY)], "insight_id string, user_query string, created_at timestamp")
    for _ in range(2):
        sinks.append_log(row, f"{folder}/log", WAREHOUSE["llm_insights"])
    log = spark.read.parquet(f"{folder}/log")
    assert log.count() == 2 and log.columns == [*WAREHOUSE["llm_insights"].schema.names, "_p", "_s"]


class FakeSession:
    """A session with the given settings and master."""

    def __init__(self, master, **settings):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: settings.get(key, default))})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{id(self)}"})


def test_working_folder_is_the_one_the_cluster_names():
    cluster = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert working_root(cluster) == "/shared/folder"
    assert new_folder(cluster, "x") != new_folder(cluster, "x")


def test_a_local_folder_only_for_a_local_session():
    local = FakeSession("local[2]")
    assert working_root(local) == working_root(local)
    assert working_root(local).startswith("/tmp/run-")
    with pytest.raises(RuntimeError):
        working_root(FakeSession("spark://host:7077"))
