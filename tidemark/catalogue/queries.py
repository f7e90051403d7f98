"""Every registered query with the SQL that checks it.

A query takes the session and the folder of the given tables and returns a lazy
DataFrame. Jobs that must write (sinks, streams, maintenance) write below the shared
working folder of the cluster and return what a reader of the written table sees.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.catalogue import domain as d
from tidemark.catalogue import oracle as o
from tidemark.functions import text
from tidemark.functions.casting import cast_to_schema
from tidemark.functions.dates import date_key
from tidemark.operators import maintenance, quality, runlog, sinks
from tidemark.operators.dedup import latest_version
from tidemark.operators.joins import on_days_of, unpartitioned, with_day_stats
from tidemark.plans import checks, gold, incremental, marts, medallion, refresh, reports, silver, staging
from tidemark.schemas import ENTITIES, TOPICS, WAREHOUSE, required_fields
from tidemark.session import configure, new_folder
from tidemark.sources import layers, seeds
from tidemark.sources.events import parse_events, read_events
from tidemark.streaming import hours, landing, quarantine, stateful, topics
from tidemark.streaming.settings import drain, writer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Audit columns differ from run to run by design.
AUDIT = ("_loaded_at", "_computed_at", "_processed_at", "_ingested_at", "_batch_id")


def comparable(df: DataFrame, digits: dict[str, int] | None = None) -> DataFrame:
    """Plain types for a comparison across engines: no audit columns, doubles, times without zone."""
    digits = digits or {}
    columns = []
    for field in df.schema.fields:
        if field.name in AUDIT:
            continue
        value = F.col(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            value = value.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            value = value.cast("timestamp_ntz")
        if field.name in digits:
            value = F.round(value, digits[field.name])
        columns.append(value.alias(field.name))
    return df.select(columns)


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        key = name or build.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run
    return register


def text_stream(folder: str) -> dict[str, str]:
    return {"format": "text", "path": folder}


#: Messages of a feed file: a compressed file is read by one task.
FEED_ROWS = 100_000


def deliver(feed: DataFrame, folder: str) -> None:
    """Add messages to a folder as compressed JSON-lines files, by as many tasks as they have partitions."""
    with sinks.shuffles_freed(feed.sparkSession):
        feed.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FEED_ROWS).text(folder)


def written_feed(spark: SparkSession, feed: DataFrame, label: str) -> str:
    """Messages as JSON-lines files for a stream to pick up."""
    folder = new_folder(spark, f"feed-{label}")
    deliver(feed, folder)
    return folder


# ---------------------------------------------------------------- facts and dimensions


def fact_sales_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_fact("fact_sales", d.as_silver(d.orders(spark, sf_dir), "transactions"))


def repeated_sales_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as their events bring them, repeats included: something for the data tests to find."""
    return gold.project_fact("fact_sales", d.as_silver(d.orders(spark, sf_dir), "transactions"))


def fact_sensors_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_fact("fact_sensor_readings", d.as_silver(d.readings(spark, sf_dir), "sensors"))


def fact_trades_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_fact("fact_trades", d.as_silver(d.trades(spark, sf_dir), "financial"))


def fact_social_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build_fact("fact_social_engagement", d.as_silver(d.posts(spark, sf_dir), "social"))


def dim_customer_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpartitioned(gold.build_dim_customer(d.as_silver(d.customer_events(spark, sf_dir), "customers")))


def dim_product_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unpartitioned(gold.build_dim_product(d.as_silver(d.product_events(spark, sf_dir), "products")))


FACT_SALES_COLUMNS = ("sale_id, order_id, customer_id, product_id, date_key, quantity, "
                      "cast(unit_price as double) as unit_price, cast(total_amount as double) as total_amount, "
                      "status, event_ts")
SENSOR_COLUMNS = ("reading_id, location_id, date_key, cast(temperature as double) as temperature, "
                  "cast(pressure as double) as pressure, cast(humidity as double) as humidity, "
                  "cast(lat as double) as lat, cast(lon as double) as lon, event_ts")
TRADE_COLUMNS = ("trade_id, asset, side, cast(quantity as double) as quantity, cast(price as double) as price, "
                 "cast(total_value as double) as total_value, date_key, event_ts")
SOCIAL_COLUMNS = "post_id, user_id, platform, content_type, likes, shares, comments, date_key, event_ts"


@query(o.sql(o.SALES, f"select {FACT_SALES_COLUMNS} from fact_sales"))
def fact_sales(spark, sf_dir):
    return comparable(fact_sales_of(spark, sf_dir))


@query(o.sql(o.SENSORS, f"select {SENSOR_COLUMNS} from fact_sensors"))
def fact_sensor_readings(spark, sf_dir):
    return comparable(fact_sensors_of(spark, sf_dir))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def fact_trades(spark, sf_dir):
    return comparable(fact_trades_of(spark, sf_dir))


@query(o.sql(o.SOCIAL, f"select {SOCIAL_COLUMNS} from fact_social"))
def fact_social_engagement(spark, sf_dir):
    return comparable(fact_social_of(spark, sf_dir))


@query(o.sql(o.SENSORS, f"select {SENSOR_COLUMNS} from fact_sensors where date_key = 20240114"))
def fact_of_one_day(spark, sf_dir):
    rows = d.as_silver(d.readings(spark, sf_dir), "sensors")
    return comparable(gold.build_fact("fact_sensor_readings", rows, "2024-01-14"))


@query(o.sql(o.DIMS, "select customer_id, email, name, region, age_group, created_at from dim_customer"))
def dim_customer(spark, sf_dir):
    return comparable(dim_customer_of(spark, sf_dir))


@query(o.sql(o.DIMS, "select product_id, name, category, cast(price as double) as price, stock_quantity, "
                     "created_at from dim_product"))
def dim_product(spark, sf_dir):
    return comparable(dim_product_of(spark, sf_dir))


@query(o.sql(o.SENSORS, """
, days as (select cast(d as date) as full_date from generate_series(date '2024-01-01', date '2027-12-31', interval 1 day) s(d))
select cast(strftime(full_date, '%Y%m%d') as int) as date_key, full_date, cast(year(full_date) as int) as year,
  cast(quarter(full_date) as int) as quarter, cast(month(full_date) as int) as month, cast(week(full_date) as int) as week,
  cast(isodow(full_date) as int) as day_of_week, cast(isodow(full_date) in (6, 7) as int) as is_weekend, count(f.date_key) as readings
from days left join fact_sensors f on f.date_key = cast(strftime(full_date, '%Y%m%d') as int) group by all"""))
def readings_per_calendar_day(spark, sf_dir):
    """The calendar with the number of readings of every day, also of days without any."""
    per_day = fact_sensors_of(spark, sf_dir).groupBy("date_key").agg(F.count(F.lit(1)).alias("readings"))
    return (seeds.date_dimension(spark).join(per_day, "date_key", "left")
            .withColumn("readings", F.coalesce("readings", F.lit(0))))


@query(o.sql(o.SENSORS, """
, sites as (select * from (values ('LOC-001', 'Warehouse A', 3.1390, 101.6869), ('LOC-002', 'Factory B', 1.3521, 103.8198),
  ('LOC-003', 'Office C', 13.7563, 100.5018), ('LOC-004', 'Depot D', 22.3193, 114.1694),
  ('LOC-005', 'Plant E', 37.5665, 126.9780)) t(location_id, site_name, latitude, longitude))
select location_id, site_name, cast(latitude as double) as latitude, cast(longitude as double) as longitude,
  'multi' as sensor_type, count(reading_id) as readings from sites left join fact_sensors using (location_id) group by all"""))
def readings_per_location(spark, sf_dir):
    per_site = fact_sensors_of(spark, sf_dir).groupBy("location_id").agg(F.count(F.lit(1)).alias("readings"))
    return (seeds.seed_sensor_locations(spark).join(per_site, "location_id", "left")
            .withColumn("readings", F.coalesce("readings", F.lit(0))))


@query(o.sql(o.TRADING, """
select date_key, cast(isodow(event_ts) as int) as day_of_week, upper(trim(asset)) as asset, count(*) as trades,
  cast(sum(total_value) as double) as total_value
from fact_trades where isodow(event_ts) in (6, 7) group by 1, 2, 3"""))
def weekend_trading(spark, sf_dir):
    """Stored trades of the days that the stored calendar calls weekend: other day folders are not opened."""
    root = new_folder(spark, "warehouse")
    maintenance.store_table(fact_trades_of(spark, sf_dir), root, WAREHOUSE["fact_trades"])
    sinks.load_dim(seeds.date_dimension(spark).coalesce(1), root, "dim_date")
    trades, calendar = layers.read_warehouse(spark, root, "fact_trades"), layers.read_warehouse(spark, root, "dim_date")
    days = on_days_of(trades, calendar, F.col("is_weekend") == 1, "day_of_week")
    return comparable(days.groupBy("date_key", "day_of_week", F.upper(F.trim("asset")).alias("asset")).agg(
        F.count(F.lit(1)).alias("trades"), F.sum("total_value").alias("total_value")))


@query(o.sql(o.TRADING, """
select cast(day(event_ts) as varchar) as _day, case when day(event_ts) <= 15 then 'first' else 'second' end as _batch_id,
  count(*) as rows from trade_ev where event_type = 'trade_executed' group by 1, 2"""))
def discovered_partitions(spark, sf_dir):
    """A silver table found by its folders: partitions are registered, again after a second batch, and counted."""
    root, entity = new_folder(spark, "silver"), ENTITIES["financial"]
    name, raw = "silver_" + root.rsplit("-", 1)[1], d.trades(spark, sf_dir)
    for batch, rows in (("first", F.dayofmonth("event_ts") <= 15), ("second", F.dayofmonth("event_ts") > 15)):
        sinks.write_silver(silver.to_silver(raw.filter(rows), entity, batch), root, "financial", batch)
        found = layers.register_layer(spark, name, f"{root}/financial", entity.silver_schema, entity.partitions)
    counts = spark.table(name).groupBy(*[F.col(c).cast("string").alias(c) for c in entity.partitions]).agg(
        F.count(F.lit(1)).alias("rows"))
    return found.join(counts, list(entity.partitions), "left").select("_day", "_batch_id", "rows")


@query(o.sql(o.TRADING, f"""select {TRADE_COLUMNS.replace('side,', "case when date_key % 2 = 0 then 'sell' else side end as side,")}
from fact_trades"""))
def fact_after_redelivery(spark, sf_dir):
    """The same trades on two raw days, those of even days corrected the second time: one row per key."""
    root, entity = new_folder(spark, "silver"), ENTITIES["financial"]
    raw = d.trades(spark, sf_dir)
    corrected = raw.withColumn("side", F.when(F.dayofmonth("event_ts") % 2 == 0, "sell").otherwise(F.col("side")))
    for day, rows in (("2024-02-01", raw), ("2024-02-02", corrected)):
        batch = silver.batch_name("financial", day)
        sinks.write_silver(silver.to_silver(rows, entity, batch), root, "financial", batch)
    return comparable(gold.build_fact("fact_trades", layers.read_silver(spark, root, "financial")))


# ---------------------------------------------------------------- typing and de-duplication

TYPED_READING = ("reading_id, location_id, site_name, cast(temperature as double) as temperature, "
                 "cast(pressure as double) as pressure, cast(humidity as double) as humidity, "
                 "{vibration} as vibration, cast(lat as double) as lat, cast(lon as double) as lon, is_anomaly, "
                 "case when battery_pct <> 0 then cast(battery_pct as double) end as battery_pct, event_ts")
TYPED_READING_TEXT = TYPED_READING.format(vibration="cast(null as double)")
DAYS = ("cast(year(event_ts) as int) as _year, cast(month(event_ts) as int) as _month, "
        "cast(day(event_ts) as int) as _day")
LATEST_READING = """
, latest as (select * exclude (rn) from (
  select *, row_number() over (partition by reading_id order by event_ts desc nulls last,
    temperature desc nulls last, humidity desc) as rn from raw_readings where reading_id is not null)
  where rn = 1 and event_ts is not null)"""
RAW_READINGS = (o.EV, o.REPEATED_READINGS)


@query(o.sql(RAW_READINGS, f"select {TYPED_READING_TEXT} from raw_readings"))
def bronze_typed(spark, sf_dir):
    return comparable(cast_to_schema(d.sensor_text(spark, sf_dir), ENTITIES["sensors"].schema))


@query(o.sql(RAW_READINGS, f"{LATEST_READING} select {TYPED_READING_TEXT}, {DAYS} from latest"))
def silver_dedup(spark, sf_dir):
    return comparable(silver.to_silver(d.sensor_text(spark, sf_dir), ENTITIES["sensors"], d.BATCH))


LATEST_ORDER = """
, latest as (select * exclude (rn) from (
  select *, row_number() over (partition by order_id order by event_ts desc, customer_id desc, product_id desc,
    quantity desc, unit_price desc, total_amount desc, status desc, payment_method desc) as rn from orders_ev) where rn = 1)"""


@query(o.sql((o.ORDERS,), f"""{LATEST_ORDER}
select order_id, customer_id, product_id, quantity, cast(unit_price as double) as unit_price,
  cast(total_amount as double) as total_amount, status, payment_method, event_type, event_ts, {DAYS} from latest"""))
def silver_transactions(spark, sf_dir):
    return comparable(silver.to_silver(d.orders(spark, sf_dir), ENTITIES["transactions"], d.BATCH))


@query(o.sql(o.TRADING, f"""select trade_id, asset, side, cast(quantity as double) as quantity,
  cast(price as double) as price, cast(total_value as double) as total_value, exchange, event_type, event_ts, {DAYS}
from trade_ev where event_type = 'trade_executed'"""))
def silver_trades(spark, sf_dir):
    """Transfers share the topic and must not become trades without a key."""
    return comparable(silver.to_silver(d.trades(spark, sf_dir), ENTITIES["financial"], d.BATCH))


@query(o.sql(o.DIMS, """
select 'customers' as entity, customer_id as id, name, region as attribute, created_at as event_ts from dim_customer
union all select 'products', product_id, name, category, created_at from dim_product"""))
def silver_dims(spark, sf_dir):
    """Customers and products out of the mixed raw topic."""
    found = silver.extract_dim_events(d.transaction_text(spark, sf_dir), d.BATCH)
    customers = found["customers"].select(
        F.lit("customers").alias("entity"), F.col("customer_id").alias("id"), "name",
        F.col("region").alias("attribute"), "event_ts")
    products = found["products"].select(
        F.lit("products").alias("entity"), F.col("product_id").alias("id"), "name",
        F.col("category").alias("attribute"), "event_ts")
    return comparable(customers.unionByName(products))


# ---------------------------------------------------------------- staging


@query(o.sql(o.SALES, f"select {FACT_SALES_COLUMNS} from stg_sales"))
def stg_sales(spark, sf_dir):
    staged = comparable(staging.stg_sales(fact_sales_of(spark, sf_dir)))
    return staged.withColumn("quantity", F.col("quantity").cast("int"))


@query(o.sql((*o.SENSORS, o.STG_SENSORS), f"select {SENSOR_COLUMNS}, temp_in_range, pressure_in_range, "
                                         "humidity_in_range from stg_sensors"))
def stg_sensors(spark, sf_dir):
    return comparable(staging.stg_sensors(fact_sensors_of(spark, sf_dir)))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from stg_trades"))
def stg_trades(spark, sf_dir):
    return comparable(staging.stg_trades(fact_trades_of(spark, sf_dir)))


@query(o.sql(o.SOCIAL, f"select {SOCIAL_COLUMNS}, weighted_engagement from stg_social"))
def stg_social(spark, sf_dir):
    return comparable(staging.stg_social(fact_social_of(spark, sf_dir)))


# ---------------------------------------------------------------- marts and refreshes


def daily_revenue_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.int_daily_revenue(staging.stg_sales(fact_sales_of(spark, sf_dir)),
                                    dim_product_of(spark, sf_dir), dim_customer_of(spark, sf_dir))
    return marts.agg_daily_revenue(daily)


def anomalies_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.int_sensor_anomalies(staging.stg_sensors(fact_sensors_of(spark, sf_dir)))


def hourly_sensor_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.agg_hourly_sensor(anomalies_of(spark, sf_dir))


def trading_volume_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.agg_trading_volume(staging.stg_trades(fact_trades_of(spark, sf_dir)))


@query(o.sql(o.ANOMALIES, """
select location_id, hour_ts, reading_count, cast(date_trunc('day', hour_ts) as timestamp) as day_ts,
  round(avg_temp_day, 4) as avg_temp_day, round(std_temp_day, 4) as std_temp_day,
  round(avg_pressure_day, 4) as avg_pressure_day, round(std_pressure_day, 4) as std_pressure_day from annotated"""))
def hours_with_day_stats(spark, sf_dir):
    """Hours joined with the statistics of their location and day."""
    readings = marts.plausible(staging.stg_sensors(fact_sensors_of(spark, sf_dir)))
    hours = marts.hourly_moments(readings).select("location_id", "hour_ts", "reading_count")
    digits = dict.fromkeys(("avg_temp_day", "std_temp_day", "avg_pressure_day", "std_pressure_day"), 4)
    return comparable(with_day_stats(hours, marts.day_stats(readings)), digits)


@query(o.sql(o.REVENUE, "select * from daily_revenue"))
def daily_revenue(spark, sf_dir):
    return comparable(daily_revenue_of(spark, sf_dir))


HOURLY_DIGITS = {"avg_temp": 4, "avg_pressure": 4, "avg_humidity": 4}
HOURLY_ROUNDED = ("round(avg_temp, 4) as avg_temp, round(avg_pressure, 4) as avg_pressure, "
                  "round(avg_humidity, 4) as avg_humidity")


@query(o.sql(o.ANOMALIES, f"""select location_id, hour_ts, {HOURLY_ROUNDED}, reading_count,
  round(avg_temp_day, 4) as avg_temp_day, round(std_temp_day, 4) as std_temp_day,
  round(avg_pressure_day, 4) as avg_pressure_day, round(std_pressure_day, 4) as std_pressure_day, temp_anomaly
from annotated"""))
def sensor_anomalies(spark, sf_dir):
    digits = dict.fromkeys(("avg_temp_day", "std_temp_day", "avg_pressure_day", "std_pressure_day"), 4)
    return comparable(anomalies_of(spark, sf_dir), HOURLY_DIGITS | digits)


@query(o.sql(o.ANOMALIES, f"select location_id, hour_ts, {HOURLY_ROUNDED}, reading_count, anomaly_flag "
                          "from agg_hourly_sensor"))
def hourly_sensor_anomalies(spark, sf_dir):
    return comparable(hourly_sensor_of(spark, sf_dir), HOURLY_DIGITS)


@query(o.sql(o.TRADING, "select * from trading_volume"))
def trading_volume(spark, sf_dir):
    return comparable(trading_volume_of(spark, sf_dir))


REFRESHED_REVENUE = f"""
select date_key, cast(event_ts as date) as full_date, region, category, count(*) as total_orders,
  cast(sum(total_amount) as double) as total_revenue, {o.average('total_amount', 2, 6, 2)} as avg_order_value
from fact_sales s join dim_customer c on s.customer_id = c.customer_id join dim_product p on s.product_id = p.product_id
where event_ts >= date '2001-07-29' group by 1, 2, 3, 4"""


def refreshed_revenue_of(spark, sf_dir):
    return refresh.refresh_daily_revenue(fact_sales_of(spark, sf_dir), dim_customer_of(spark, sf_dir),
                                         dim_product_of(spark, sf_dir), d.SALES_AS_OF)


@query(o.sql((*o.SALES, *o.DIMS), REFRESHED_REVENUE))
def refresh_daily_revenue(spark, sf_dir):
    return comparable(refreshed_revenue_of(spark, sf_dir))


REFRESHED_HOURS = """
select date_trunc('hour', event_ts) as hour_ts, location_id, round(cast(cast(avg(temperature) as float) as double), 4) as avg_temp,
  round(cast(cast(avg(pressure) as float) as double), 4) as avg_pressure,
  round(cast(cast(avg(humidity) as float) as double), 4) as avg_humidity, count(*) as reading_count,
  cast(avg(temperature) > 35 or avg(temperature) < 10 as int) as anomaly_flag
from fact_sensors where event_ts >= timestamp '2024-01-30 18:00:00' group by 1, 2"""


@query(o.sql(o.SENSORS, REFRESHED_HOURS))
def refresh_hourly_sensor(spark, sf_dir):
    fresh = refresh.refresh_hourly_sensor(fact_sensors_of(spark, sf_dir), d.EVENTS_AS_OF)
    return comparable(fresh, HOURLY_DIGITS)


REFRESHED_TRADING = f"""
select date_key, cast(event_ts as date) as full_date, asset, cast(sum(quantity) as double) as total_volume,
  count(*) as trade_count, {o.average('price', 8, 12, 8)} as avg_price
from fact_trades where event_ts >= date '2024-01-28' group by 1, 2, 3"""


@query(o.sql(o.TRADING, REFRESHED_TRADING))
def refresh_trading_volume(spark, sf_dir):
    return comparable(refresh.refresh_trading_volume(fact_trades_of(spark, sf_dir), d.EVENTS_AS_OF))


@query(o.sql(o.SENSORS, REFRESHED_HOURS))
def refresh_stored_hours(spark, sf_dir):
    """The hourly refresh from a stored fact: only the folders of its window are listed and read."""
    root = new_folder(spark, "warehouse")
    maintenance.store_table(fact_sensors_of(spark, sf_dir), root, WAREHOUSE["fact_sensor_readings"])
    recent = layers.read_warehouse(spark, root, "fact_sensor_readings", refresh.hour_cutoff(d.EVENTS_AS_OF))
    return comparable(refresh.refresh_hourly_sensor(recent, d.EVENTS_AS_OF), HOURLY_DIGITS)


# ---------------------------------------------------------------- maintenance


@query(o.sql(o.DIMS, "select customer_id, email, name, region, created_at from dim_customer"))
def latest_version_of_customers(spark, sf_dir):
    loaded = d.customer_events(spark, sf_dir).withColumn("_loaded_at", F.col("created_at"))
    merged = latest_version(loaded, ["customer_id"], "_loaded_at", ("email", "name", "region", "age_group"))
    return comparable(merged.select("customer_id", "email", "name", "region", "created_at"))


@query(o.sql(o.REVENUE, f"""
select date_key, cast(event_ts as date) as full_date, coalesce(region, 'unknown') as region,
  coalesce(category, 'unknown') as category, count(*) as total_orders, cast(sum(total_amount) as double) as total_revenue,
  {o.average('total_amount', 2, 2)} as avg_order_value
from stg_sales s left join dim_product p on s.product_id = p.product_id
  left join dim_customer c on s.customer_id = c.customer_id
where status <> 'cancelled' group by 1, 2, 3, 4"""))
def compacted_daily_revenue(spark, sf_dir):
    """Revenue computed for three parts of the orders, then collapsed in two steps: exact to the cent."""
    table, sales = WAREHOUSE["agg_daily_revenue"], staging.stg_sales(fact_sales_of(spark, sf_dir))
    product, customer = dim_product_of(spark, sf_dir), dim_customer_of(spark, sf_dir)
    parts = []
    for part in range(3):
        own = sales.filter(F.crc32("order_id") % 3 == part)
        daily = marts.agg_daily_revenue(marts.int_daily_revenue(own, product, customer))
        parts.append(sinks.project_to(daily, table.schema))
    once = maintenance.compacted(parts[0].unionByName(parts[1]), table)
    return comparable(maintenance.compacted(once.unionByName(parts[2]), table))


@query(o.sql((o.EV, o.TRADES), """
, parts as (
  select date_key, cast(event_ts as date) as full_date, asset, side, sum(cast(quantity as double)) as volume, count(*) as n,
    (2 * sum(cast(round(cast(price as decimal(38,8)) * 100000000) as hugeint)) * 10000 + count(*)) // (2 * count(*)) as p12
  from stg_trades group by 1, 2, 3, 4),
rounded as (select *, (p12 + 5000) // 10000 as p8 from parts)
select date_key, full_date, asset, sum(volume) as total_volume, cast(sum(n) as bigint) as trade_count,
  cast((2 * sum(cast(p8 * n as hugeint)) + sum(n)) // (2 * sum(n)) as double) / 100000000.0 as avg_price
from rounded group by 1, 2, 3"""))
def summing_compaction(spark, sf_dir):
    """Volumes stored separately for buys and sells, collapsed to one row per day and asset."""
    staged = staging.stg_trades(fact_trades_of(spark, sf_dir))
    partial = (staged.groupBy("date_key", F.to_date("event_ts").alias("full_date"), "asset", "side")
               .agg(F.sum("quantity").alias("total_volume"), F.count(F.lit(1)).alias("trade_count"),
                    F.avg("price").alias("avg_price")))
    target = WAREHOUSE["agg_trading_volume"]
    return comparable(maintenance.compacted(sinks.project_to(partial, target.schema), target))


@query(o.sql((*o.SALES, o.EV, o.READINGS, o.FACT_SENSORS, o.TRADES, o.POSTS), """
select 'fact_sales' as table_name, count(*) as kept, min(event_ts) as oldest from fact_sales where event_ts > timestamp '1999-07-31 12:00:00'
union all select 'fact_sensor_readings', count(*), min(event_ts) from fact_sensors where event_ts > timestamp '2024-01-15 06:00:00'
union all select 'fact_trades', count(*), min(event_ts) from fact_trades where event_ts > timestamp '2024-01-15 06:00:00'
union all select 'fact_social_engagement', count(*), min(event_ts) from fact_social"""))
def retention(spark, sf_dir):
    """Every fact cut to its time to live; posts are kept for ever."""
    facts = {
        "fact_sales": (fact_sales_of, d.SALES_AS_OF),
        "fact_sensor_readings": (fact_sensors_of, datetime(2025, 1, 15, 6)),
        "fact_trades": (fact_trades_of, datetime(2027, 1, 15, 6)),
        "fact_social_engagement": (fact_social_of, d.EVENTS_AS_OF),
    }
    parts = [
        maintenance.retained(build(spark, sf_dir), WAREHOUSE[name], as_of)
        .agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("kept"), F.min("event_ts").alias("oldest"))
        for name, (build, as_of) in facts.items()
    ]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return comparable(first)


REBUILT_HOURS = f"""
select hour_ts, location_id, round(cast(cast(avg_temp as float) as double), 4) as avg_temp,
  round(cast(cast(avg_pressure as float) as double), 4) as avg_pressure,
  round(cast(cast(avg_humidity as float) as double), 4) as avg_humidity, reading_count, anomaly_flag
from agg_hourly_sensor where hour_ts < timestamp '2024-01-30 18:00:00'
union all {REFRESHED_HOURS}"""


def warehouse_hours(spark, sf_dir):
    return sinks.project_to(hourly_sensor_of(spark, sf_dir), WAREHOUSE["agg_hourly_sensor"].schema)


@query(o.sql(o.ANOMALIES, REBUILT_HOURS))
def rebuild_window(spark, sf_dir):
    """The hourly aggregate with its newest hours computed afresh."""
    fresh = refresh.refresh_hourly_sensor(fact_sensors_of(spark, sf_dir), d.EVENTS_AS_OF)
    rebuilt = sinks.rebuild_window(warehouse_hours(spark, sf_dir), fresh, "hour_ts",
                                   refresh.hour_cutoff(d.EVENTS_AS_OF))
    return comparable(rebuilt, HOURLY_DIGITS)


@query(o.sql(o.ANOMALIES, REBUILT_HOURS))
def rebuild_window_stored(spark, sf_dir):
    """The same on a stored table: only the day of the cut-off and later days are rewritten, twice."""
    table, root = WAREHOUSE["agg_hourly_sensor"], new_folder(spark, "warehouse")
    maintenance.store_table(warehouse_hours(spark, sf_dir), root, table)
    cutoff = refresh.hour_cutoff(d.EVENTS_AS_OF)
    for _ in range(2):
        fresh = refresh.refresh_hourly_sensor(fact_sensors_of(spark, sf_dir), d.EVENTS_AS_OF)
        path = sinks.write_window(spark, fresh, root, table, cutoff)
    return comparable(layers.read_warehouse(spark, root, table.name), HOURLY_DIGITS)


# ---------------------------------------------------------------- sinks


@query(o.sql(RAW_READINGS, f"{LATEST_READING} select {TYPED_READING_TEXT}, {DAYS} from latest"))
def silver_written_twice(spark, sf_dir):
    """A batch that is run again replaces itself."""
    root = new_folder(spark, "silver")
    for _ in range(2):
        rows = silver.to_silver(d.sensor_text(spark, sf_dir), ENTITIES["sensors"], d.BATCH)
        sinks.write_silver(rows, root, "sensors", d.BATCH)
    return comparable(layers.read_silver(spark, root, "sensors"))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def gold_written_twice(spark, sf_dir):
    root = new_folder(spark, "gold")
    for _ in range(2):
        path = sinks.write_gold_fact(fact_trades_of(spark, sf_dir), root, "fact_trades")
    return comparable(spark.read.parquet(path))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def load_fact_idempotent(spark, sf_dir):
    """The whole fact in the warehouse, then one day loaded again from gold: nothing doubles."""
    gold_root, root = new_folder(spark, "gold"), new_folder(spark, "warehouse")
    sinks.write_gold_fact(fact_trades_of(spark, sf_dir), gold_root, "fact_trades")
    maintenance.store_table(layers.read_gold_partition(spark, gold_root, "fact_trades"), root, WAREHOUSE["fact_trades"])
    for day in (20240107, 20240107):
        sinks.load_fact(layers.read_gold_partition(spark, gold_root, "fact_trades", day), root, "fact_trades", day)
    return comparable(layers.read_warehouse(spark, root, "fact_trades"))


@query(o.sql(o.TRADING, f"""select {TRADE_COLUMNS}, date_key // 100 as _p from fact_trades
where date_key in (20240105, 20240106, 20240129)"""))
def clustered_load(spark, sf_dir):
    """Three days loaded one by one: the month partition, the day folder and the declared order."""
    root, rows = new_folder(spark, "warehouse"), fact_trades_of(spark, sf_dir)
    for day in (20240105, 20240106, 20240129):
        path = sinks.load_fact(rows, root, "fact_trades", day)
    return comparable(spark.read.parquet(path))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def optimized_fact(spark, sf_dir):
    """A fact that came in four parts, rewritten in place to a file for each day."""
    root, table = new_folder(spark, "warehouse"), WAREHOUSE["fact_trades"]
    for part in range(4):
        rows = fact_trades_of(spark, sf_dir).filter(F.crc32("trade_id") % 4 == part)
        placed = sinks.stored_layout(sinks.project_to(rows, table.schema), table)
        placed.coalesce(1).write.mode("append").partitionBy(*table.partitions).parquet(f"{root}/{table.name}")
    maintenance.optimize_table(spark, root, table)
    return comparable(layers.read_warehouse(spark, root, "fact_trades"))


@query(o.sql((*o.SALES, o.EV, o.READINGS, o.FACT_SENSORS, o.TRADES), """
select 'fact_sensor_readings' as table_name, count(*) as kept, min(event_ts) as oldest from fact_sensors where event_ts >= date '2024-01-16'
union all select 'fact_trades', count(*), min(event_ts) from fact_trades where event_ts >= date '2024-01-11'"""))
def expired_facts(spark, sf_dir):
    """Stored facts after the nightly removal of days whose time to live has passed."""
    root, parts = new_folder(spark, "warehouse"), []
    for name, build, as_of in (("fact_sensor_readings", fact_sensors_of, datetime(2025, 1, 16, 6)),
                               ("fact_trades", fact_trades_of, datetime(2027, 1, 11, 23))):
        maintenance.store_table(build(spark, sf_dir), root, WAREHOUSE[name])
        maintenance.expire_table(spark, root, WAREHOUSE[name], as_of)
        parts.append(layers.read_warehouse(spark, root, name).agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("kept"), F.min("event_ts").alias("oldest")))
    return comparable(parts[0].unionByName(parts[1]))


@query(o.sql(o.DIMS, "select product_id, name, category, cast(price as double) as price from dim_product"))
def load_dim_by_name(spark, sf_dir):
    root = new_folder(spark, "warehouse")
    return comparable(spark.read.parquet(sinks.load_dim(dim_product_of(spark, sf_dir), root, "dim_product")))


@query(o.sql(o.SALES, f"select {FACT_SALES_COLUMNS}, cast(strftime(event_ts, '%Y%m') as int) as _p from fact_sales"))
def clustered_fact(spark, sf_dir):
    rows = fact_sales_of(spark, sf_dir)
    path = maintenance.store_table(rows, new_folder(spark, "warehouse"), WAREHOUSE["fact_sales"])
    return comparable(spark.read.parquet(path))


@query(o.sql(o.SALES, """
, buyers as (select strftime(event_ts, '%Y') as y, customer_id, count(*) as n from fact_sales group by 1, 2)
select cast(y as int) as _p, cast(sum(n) as bigint) as rows, count(*) as customers, 0 as overlaps from buyers group by 1"""))
def clustered_ranges(spark, sf_dir):
    """Sales by year in files whose ranges of customers do not overlap; a customer too heavy for a file has its own."""
    root, source = new_folder(spark, "clustered"), new_folder(spark, "sales")
    sales = fact_sales_of(spark, sf_dir).select("customer_id", "product_id", "total_amount", "event_ts", F.year("event_ts").alias("_p"))
    sales.write.parquet(source)
    stored = spark.read.parquet(source)
    path = maintenance.range_cluster(stored, root, ("_p",), ("customer_id", "product_id"), 40)
    rows = spark.read.parquet(path)
    files = rows.groupBy("_p", F.input_file_name().alias("file")).agg(
        F.min("customer_id").alias("low"), F.max("customer_id").alias("high"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("_p").orderBy("low", "high")
    # Files that meet in a key are those of one heavy key.
    crossed = F.coalesce(F.col("low") < F.lag("high").over(before), F.lit(False))
    overlaps = files.withColumn("crossed", crossed).groupBy("_p").agg(F.sum("n").alias("rows"), F.count_if("crossed").cast("int").alias("overlaps"))
    customers = rows.groupBy("_p").agg(F.count_distinct("customer_id").alias("customers"))
    return overlaps.join(customers, "_p").select("_p", "rows", "customers", "overlaps")


@query(o.sql(o.TRADING, "select * from trading_volume"))
def marts_of_changed_days(spark, sf_dir):
    """The trading mart after a redelivery of old days: their folders alone are read and replaced.

    At first, four days lack the buying side and one is missing; a mart is made of that, then the days are loaded again.
    """
    root, table, late = new_folder(spark, "warehouse"), WAREHOUSE["fact_trades"], (20240103, 20240104, 20240105, 20240117, 20240122)
    rows = fact_trades_of(spark, sf_dir)
    early = rows.filter(~F.col("date_key").isin(*late) | (F.col("side") == "sell") & (F.col("date_key") != late[-1]))
    maintenance.store_table(early, root, table)
    incremental.refresh_mart(spark, "agg_trading_volume", root, f"{root}/marts")
    whole = spark.read.parquet(sinks.write_gold_fact(rows, root, "gold_trades", many_days=True))
    for day in late:
        sinks.load_fact(whole.filter(F.col("date_key") == day), root, "fact_trades", day)
    done = incremental.refresh_mart(spark, "agg_trading_volume", root, f"{root}/marts")
    assert set(done) <= set(late)
    return comparable(incremental.read_mart(spark, f"{root}/marts", "agg_trading_volume"))


@query(o.sql(o.SOCIAL, f"select {SOCIAL_COLUMNS} from fact_social"))
def compacted_files(spark, sf_dir):
    root = new_folder(spark, "gold")
    source = sinks.write_gold_fact(fact_social_of(spark, sf_dir), root, "fact_social_engagement")
    target = maintenance.compact_table(spark, source, f"{root}/compacted", ("date_key",), ("platform",))
    return comparable(spark.read.parquet(target))


@query(o.sql(o.TRADING, "select * from trading_volume"))
def materialized_models(spark, sf_dir):
    """Staging as a view, the mart as a table on top of it."""
    suffix = new_folder(spark, "mart")
    name = suffix.rsplit("-", 1)[1]
    view = sinks.materialize(staging.stg_trades(fact_trades_of(spark, sf_dir)), f"stg_trades_{name}", "view")
    return comparable(sinks.materialize(marts.agg_trading_volume(view), f"agg_trading_volume_{name}",
                                        "table", suffix))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def ensured_table(spark, sf_dir):
    """Create a partitioned table if it is missing, twice, and fill it."""
    folder = new_folder(spark, "table")
    name, spec = "trades_" + folder.rsplit("-", 1)[1], WAREHOUSE["fact_trades"]
    for _ in range(2):
        sinks.ensure_table(spark, name, spec.schema, ("date_key",), folder)
    rows = sinks.project_to(fact_trades_of(spark, sf_dir), spec.schema)
    rows.select(*spark.table(name).columns).write.insertInto(name)
    return comparable(spark.table(name))


# ---------------------------------------------------------------- streams


@query(o.sql(RAW_READINGS, f"""select {TYPED_READING.format(vibration='cast(vibration as double)').replace(
    "case when battery_pct <> 0 then cast(battery_pct as double) end", "cast(battery_pct as double)")}
from raw_readings"""))
def stream_landing(spark, sf_dir):
    """JSON messages to raw text columns by arrival hour, read back for one day and typed."""
    folder = written_feed(spark, d.sensor_feed(spark, sf_dir), "sensors")
    root = new_folder(spark, "bronze")
    arrived = F.lit("2024-02-01 07:30:00").cast("timestamp")
    drain(landing.land_bronze(read_events(spark, "sensors", text_stream(folder)), "sensors", root,
                              f"{root}/_checkpoint", available_now=True, arrived=arrived))
    raw = layers.read_bronze(spark, root, "sensors", "2024-02-01")
    return comparable(cast_to_schema(raw, ENTITIES["sensors"].schema))


STREAMED_READING = (TYPED_READING.format(vibration="cast(vibration as double)").replace(
    "case when battery_pct <> 0 then cast(battery_pct as double) end", "cast(battery_pct as double)"))


@query(o.sql(RAW_READINGS, f"select {STREAMED_READING}, {DAYS} from raw_readings where event_ts is not null"))
def stream_topic(spark, sf_dir):
    folder = written_feed(spark, d.sensor_feed(spark, sf_dir), "sensors")
    root = new_folder(spark, "silver")
    drain(topics.stream_topic(spark, "sensors", root, text_stream(folder), available_now=True))
    return comparable(layers.read_streamed(spark, root, "sensors"))


TRANSACTIONS = (o.ORDERS, o.CUSTOMERS, o.PRODUCTS)


@query(o.sql(TRANSACTIONS, """
select 'transactions' as entity, order_id as id, customer_id, product_id, cast(total_amount as double) as amount,
  status as attribute, event_ts from orders_ev
union all select 'customers', customer_id, customer_id, null, null, region, created_at from customer_ev
union all select 'products', product_id, null, product_id, cast(price as double), category, created_at from product_ev"""))
def stream_routed(spark, sf_dir):
    """One pass over the mixed topic into three tables."""
    folder = written_feed(spark, d.transaction_feed(spark, sf_dir), "transactions")
    root = new_folder(spark, "silver")
    drain(topics.stream_transactions(spark, root, text_stream(folder), available_now=True))

    def part(entity, key, **columns):
        rows = layers.read_streamed(spark, root, entity)
        wanted = {"customer_id": "string", "product_id": "string", "amount": "double", "attribute": "string"}
        return rows.select(
            F.lit(entity).alias("entity"), F.col(key).alias("id"),
            *[(F.col(columns[c]) if c in columns else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()],
            "event_ts")

    return comparable(
        part("transactions", "order_id", customer_id="customer_id", product_id="product_id",
             amount="total_amount", attribute="status")
        .unionByName(part("customers", "customer_id", customer_id="customer_id", attribute="region"))
        .unionByName(part("products", "product_id", product_id="product_id", amount="price",
                          attribute="category")))


@query(o.sql((o.EV, o.READINGS), f"select {STREAMED_READING} from readings "
                                 "where reading_id is not null and event_ts is not null"))
def stream_dedup(spark, sf_dir):
    """Every message is delivered twice, the second time corrected: the stream keeps the first copy."""
    once = d.sensor_messages(spark, sf_dir)
    corrected = once.select(F.regexp_replace("value", '"temperature":[-0-9.E]+', '"temperature":-1').alias("value"))
    folder, out = new_folder(spark, "feed-sensors"), new_folder(spark, "silver")
    for part in (once, corrected):
        deliver(part, folder)
        events = parse_events(read_events(spark, "sensors", text_stream(folder)), ENTITIES["sensors"].schema)
        drain(writer(stateful.dedup_stream(events, "reading_id", d.LATENESS, lanes=4), "dedup", f"{out}/_checkpoint", True)
              .format("parquet").start(out))
    return comparable(spark.read.parquet(out))


@query(o.sql(RAW_READINGS, f"""select hour_ts, location_id, {HOURLY_ROUNDED}, reading_count from (
  select date_trunc('hour', event_ts) as hour_ts, location_id, avg(temperature) as avg_temp, avg(pressure) as avg_pressure,
    avg(humidity) as avg_humidity, count(*) as reading_count from raw_readings where event_ts is not null group by 1, 2)"""))
def stream_hourly(spark, sf_dir):
    """Hourly averages as a stream; a last message far ahead closes all hours."""
    folder = written_feed(spark, d.sensor_feed(spark, sf_dir), "sensors")
    # Written later, so its file is read last even when the feed takes many micro-batches.
    d.closing_message(spark, sf_dir).write.mode("append").text(folder)
    events = parse_events(read_events(spark, "sensors", text_stream(folder)), ENTITIES["sensors"].schema)
    timed = events.filter(F.col("event_ts").isNotNull())
    out = new_folder(spark, "silver")
    drain(writer(stateful.hourly_sensor_stream(timed, d.LATENESS), "hourly", f"{out}/_checkpoint", True)
          .outputMode("append").format("parquet").start(out))
    return comparable(spark.read.parquet(out), HOURLY_DIGITS)


@query(o.sql(RAW_READINGS, f"{LATEST_READING} select {STREAMED_READING} from latest"))
def stream_dedup_newest(spark, sf_dir):
    """Readings and their corrections, the newer half first: the stream emits the newest copy, as the batch rule does."""
    messages = d.sensor_feed(spark, sf_dir)
    newer_first = F.minute(F.get_json_object("value", "$.event_ts").cast("timestamp")) % 2 == 1
    folder, out = new_folder(spark, "feed-sensors"), new_folder(spark, "silver")
    # The stream goes on from its checkpoint with the second delivery, so the order holds without a file of all messages.
    for parts in ((messages.filter(newer_first),), (messages.filter(F.coalesce(~newer_first, F.lit(True))), d.closing_message(spark, sf_dir))):
        for part in parts:
            deliver(part, folder)
        events = parse_events(read_events(spark, "sensors", text_stream(folder)), ENTITIES["sensors"].schema)
        drain(writer(stateful.newest_stream(events, "reading_id", "6 hours", d.LATENESS), "newest", f"{out}/_checkpoint", True)
              .outputMode("append").format("parquet").start(out))
    return comparable(spark.read.parquet(out))


@query(o.sql(RAW_READINGS, f"""select hour_ts, location_id, {HOURLY_ROUNDED}, reading_count, late_count from (
  select date_trunc('hour', event_ts) as hour_ts, location_id, avg(temperature) as avg_temp, avg(pressure) as avg_pressure,
    avg(humidity) as avg_humidity, count(*) as reading_count,
    count(*) filter (day(event_ts) <= 20 and (minute(event_ts) < 20 or hour(event_ts) = 3)) as late_count
  from raw_readings where event_ts is not null group by 1, 2)"""))
def stream_hourly_late(spark, sf_dir):
    """Hourly averages with a lateness of hours and files out of order; late readings are kept and folded in."""
    folder, root = new_folder(spark, "feed-late"), new_folder(spark, "hours")
    for part in (*d.late_sensor_feed(spark, sf_dir), d.closing_message(spark, sf_dir)):
        part.coalesce(1).write.mode("append").text(folder)
    schema, checkpoint = ENTITIES["sensors"].schema, f"{root}/_checkpoint"
    events = parse_events(read_events(spark, "sensors", text_stream(folder) | {"maxFilesPerTrigger": "1"}), schema)
    drain(hours.hourly_with_late(events, root, checkpoint, timedelta(hours=6), available_now=True))
    hours.fold_late(spark, root, checkpoint)
    late = (hours.read_late(spark, root, schema).groupBy(F.date_trunc("hour", "event_ts").alias("hour_ts"), "location_id")
            .agg(F.count(F.lit(1)).alias("late_count")))
    found = hours.read_hours(spark, root).join(late, ["hour_ts", "location_id"], "left")
    return comparable(found.fillna(0, ["late_count"]), HOURLY_DIGITS)


@query(o.sql((*TRANSACTIONS, o.EV, o.REPEATED_READINGS, o.TRADES, o.POSTS), """
, checked as (
  select 'sensors' as topic, reading_id as id, case when humidity < 0 and temperature is not null then 'malformed_json'
    when reading_id is null then 'missing_key' when event_ts is null then 'missing_event_time'
    when temperature is null then 'bad_field' end as reason from raw_readings
  union all select 'transactions', order_id, case when quantity = 1 then 'unknown_type' end from orders_ev
  union all select 'transactions', customer_id, case when age_group = '18-25' then 'missing_key' end from customer_ev
  union all select 'transactions', product_id, case stock_quantity when 1 then 'missing_event_time' when 2 then 'malformed_json'
    when 3 then 'bad_field' end from product_ev
  union all select 'financial', coalesce(trade_id, 'TF-1'),
    case when event_type = 'transfer' and exchange <> 'LSE' then 'missing_key' end from trade_ev
  union all select 'social', post_id, null from post_ev)
select topic, coalesce(reason, 'accepted') as outcome, count(*) as messages, count(case when reason is null then id end) as keys
from checked group by 1, 2"""))
def stream_quarantine(spark, sf_dir):
    """All topics: what is wrong with a message of its own type goes to a table of its own with the reason."""
    root, parts = new_folder(spark, "silver"), []
    for topic, feed in d.BROKEN_FEEDS.items():
        folder = written_feed(spark, feed(spark, sf_dir), topic)
        drain(quarantine.quarantine_stream(
            read_events(spark, topic, text_stream(folder)), topic, f"{root}/good/{topic}", f"{root}/bad/{topic}",
            f"{root}/_checkpoints/{topic}", available_now=True))
        sinks.remove_folder(spark, folder)  # worked off
        good = spark.read.parquet(f"{root}/good/{topic}")
        keys = [F.when(F.lit(True) if t is None else F.col("event_type") == t, F.col(key))
                for t, (key, _) in required_fields(topic).items()]
        parts += [good.select(F.lit(topic).alias("topic"), F.lit("accepted").alias("outcome"), F.coalesce(*keys).alias("id")),
                  spark.read.parquet(f"{root}/bad/{topic}").select(
                      F.lit(topic).alias("topic"), F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("id"))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("topic", "outcome").agg(F.count(F.lit(1)).alias("messages"), F.count("id").alias("keys"))


MESSAGES = """
select 'silver_transactions' as name, (select count(*) from orders_ev) + (select count(*) from customer_ev)
  + (select count(*) from product_ev) as messages
union all select 'silver_sensors', count(*) from raw_readings
union all select 'silver_financial', count(*) from trade_ev
union all select 'silver_social', count(*) from post_ev"""
ALL_EVENTS = (*TRANSACTIONS, o.EV, o.REPEATED_READINGS, o.TRADES, o.POSTS)


def all_streamed(spark: SparkSession, sf_dir: str) -> str:
    """Every topic streamed to its typed tables; returns their folder."""
    root = new_folder(spark, "silver")
    feeds = {t: text_stream(written_feed(spark, feed(spark, sf_dir), t)) for t, feed in d.FEEDS.items()}
    topics.run_all(spark, root, feeds, available_now=True)
    return root


@query(o.sql(ALL_EVENTS, MESSAGES))
def topic_progress(spark, sf_dir):
    """What all streams report about themselves, written down batch by batch while they run."""
    log = runlog.ProgressLog(spark, new_folder(spark, "progress"))
    spark.streams.addListener(log)
    try:
        root = new_folder(spark, "silver")
        for topic, feed in d.FEEDS.items():
            folder = written_feed(spark, feed(spark, sf_dir), topic)
            log.wait(drain(topics.stream_topic(spark, topic, root, text_stream(folder), available_now=True)))
    finally:
        spark.streams.removeListener(log)
    return runlog.topic_progress(spark, log.path).groupBy("name").agg(F.sum("num_input_rows").alias("messages"))


@query(o.sql(ALL_EVENTS, f"""
, messages as ({MESSAGES})
select name, messages, messages as logged_rows, true as one_run_each from messages"""))
def folded_progress(spark, sf_dir):
    """Messages by stream as the folded progress and the run log tell them; both are settled after every stream."""
    log, runs = runlog.ProgressLog(spark, new_folder(spark, "progress")), new_folder(spark, "runs")
    spark.streams.addListener(log)
    try:
        root = new_folder(spark, "silver")
        for topic, feed in d.FEEDS.items():
            folder = written_feed(spark, feed(spark, sf_dir), topic)
            log.wait(drain(topics.stream_topic(spark, topic, root, text_stream(folder), available_now=True)))
            runlog.settle_streams(spark, runs, log.path, "silver")
    finally:
        spark.streams.removeListener(log)
    runlog.settle_streams(spark, runs, log.path, "silver")
    told = runlog.topic_progress(spark, log.path).groupBy("name").agg(F.sum("num_input_rows").alias("messages"))
    logged = spark.read.schema(runlog.RUNS.schema).parquet(runs).groupBy(F.col("dag_id").alias("name")).agg(
        F.sum("rows_read").alias("logged_rows"), (F.count("run_id") == F.countDistinct("run_id")).alias("one_run_each"))
    return told.join(logged, "name")


@query(o.sql(ALL_EVENTS, """
select 'transactions' as table_name, count(*) as rows, count(distinct order_id) as keys from orders_ev
union all select 'customers', count(*), count(distinct customer_id) from customer_ev
union all select 'products', count(*), count(distinct product_id) from product_ev
union all select 'sensors', count(*), count(distinct reading_id) from raw_readings where event_ts is not null
union all select 'financial', count(*), count(distinct trade_id) from trade_ev where event_type = 'trade_executed'
union all select 'social', count(*), count(distinct post_id) from post_ev"""))
def stream_all_topics(spark, sf_dir):
    """All streams at once: rows and keys of every table."""
    root, parts = all_streamed(spark, sf_dir), []
    for entity in ENTITIES.values():
        parts.append(layers.read_streamed(spark, root, entity.name).agg(
            F.lit(entity.name).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.count_distinct(entity.key).alias("keys")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def gold_from_stream(spark, sf_dir):
    """Messages → stream → silver → fact: half of the trades gathered into silver, the other half still where
    the stream put them, and some messages delivered in both."""
    streamed, stored = new_folder(spark, "stream"), new_folder(spark, "silver")
    feed = d.trade_feed(spark, sf_dir)
    kind = F.crc32("value") % 4
    folder = written_feed(spark, feed.filter(kind < 3), "financial")
    drain(topics.stream_topic(spark, "financial", streamed, text_stream(folder), available_now=True))
    topics.gather_streamed(spark, streamed, stored, "financial")
    deliver(feed.filter(kind > 1), folder)
    drain(topics.stream_topic(spark, "financial", streamed, text_stream(folder), available_now=True))
    rows = layers.read_silver(spark, stored, "financial").unionByName(layers.read_streamed(spark, streamed, "financial"))
    return comparable(gold.build_fact("fact_trades", rows))


@query(o.sql(o.TRADING, f"select {TRADE_COLUMNS} from fact_trades"))
def gathered_while_streaming(spark, sf_dir):
    """Trades gathered between the steps of a stream, with a batch in flight each time: every trade is there once."""
    streamed, stored = new_folder(spark, "stream"), new_folder(spark, "silver")
    feed, part = d.trade_feed(spark, sf_dir), F.crc32("value") % 3
    folder = new_folder(spark, "feed-financial")
    for step in range(3):
        deliver(feed.filter(part == step), folder)
        drain(topics.stream_topic(spark, "financial", streamed, text_stream(folder), available_now=True))
        last = topics.last_committed(spark, f"{streamed}/_checkpoints/financial")
        # What a batch leaves that is being written: no commit mark.
        flying = f"{streamed}/financial/_batch_id={topics.batch_name('financial', last + 1)}"
        sinks.write_text(spark, f"{flying}/_temporary/0/part", "half")
        topics.gather_streamed(spark, streamed, stored, "financial")
        assert sinks.path_exists(spark, flying)
    return comparable(gold.build_fact("fact_trades", layers.read_silver(spark, stored, "financial")))


DAILY_BATCHES = 5


@query(o.sql(o.DIMS, "select customer_id, email, name, region, age_group, created_at from dim_customer"))
def dimension_merged_daily(spark, sf_dir):
    """Registrations that arrive in five batches, out of order: each day's version is the last one and the new batch."""
    silver_root, gold_root = new_folder(spark, "silver"), new_folder(spark, "gold")
    rows = d.as_silver(d.customer_events(spark, sf_dir), "customers")
    for day in range(DAILY_BATCHES):
        batch = rows.filter(F.crc32(F.concat("customer_id", F.col("event_ts").cast("string"))) % DAILY_BATCHES == day)
        sinks.write_silver(batch, silver_root, "customers", f"customers_{day}")
        gold.merge_dimension(spark, silver_root, gold_root, "dim_customer")
    return comparable(layers.read_gold_partition(spark, gold_root, "dim_customer"))


@query(o.sql(TRANSACTIONS, f"""{LATEST_ORDER},
revenue as (
  select cast(strftime(event_ts, '%Y%m%d') as int) as date_key, cast(event_ts as date) as full_date,
    coalesce(region, 'unknown') as region, coalesce(category, 'unknown') as category, count(*) as total_orders,
    cast(sum(total_amount) as double) as total_revenue, {o.average('total_amount', 2, 6)} as avg_order_value,
    cast(sum(quantity) as bigint) as total_units
  from latest s left join dim_product p on s.product_id = p.product_id
    left join dim_customer c on s.customer_id = c.customer_id
  where lower(trim(status)) <> 'cancelled' and total_amount > 0 group by 1, 2, 3, 4)
select * from revenue"""))
def medallion_daily_revenue(spark, sf_dir):
    """Messages → raw files → silver → gold → mart, through every layer on disk."""
    lake = medallion.Lake(*[new_folder(spark, layer) for layer in ("bronze", "silver", "gold")])
    arrived = F.lit("2024-02-01 07:30:00").cast("timestamp")
    for topic, feed in d.FEEDS.items():
        folder = written_feed(spark, feed(spark, sf_dir), topic)
        drain(landing.land_bronze(read_events(spark, topic, text_stream(folder)), topic, lake.bronze,
                                  f"{lake.bronze}/_checkpoints/{topic}", True, arrived))
        sinks.remove_folder(spark, folder)  # worked off
    medallion.run_day(spark, lake, "2024-02-01")
    return comparable(medallion.build_marts(spark, lake)["agg_daily_revenue"])


# ---------------------------------------------------------------- checks, text, logs


def _check_sql(table: str, key: str, cte: tuple[str, ...], *nulls: str) -> str:
    rows = [f"select '{table}' as table_name, '{key}' as column_name, 'unique' as test, "
            f"(select count(*) from (select {key} from {cte[-1]} where {key} is not null "
            f"group by 1 having count(*) > 1)) as failures"]
    rows += [f"select '{table}', '{c}', 'not_null', (select count(*) from {cte[-1]} where {c} is null)"
             for c in (key, *nulls)]
    return " union all ".join(rows)


@query(o.sql((o.ORDERS, o.REPEATED_SALES, o.EV, o.REPEATED_READINGS, o.TRADES, o.POSTS), " union all ".join([
    _check_sql("fact_sales", "sale_id", ("sales_rows",), "total_amount"),
    _check_sql("fact_sensor_readings", "reading_id", ("raw_readings",)),
    _check_sql("fact_trades", "trade_id", ("trade_ev",)),
    _check_sql("fact_social_engagement", "post_id", ("post_ev",)),
])))
def dq_report(spark, sf_dir):
    """All declared tests on facts that were neither de-duplicated nor filtered."""
    def keyed(df):
        return df.withColumn("date_key", date_key(F.col("event_ts")))

    return quality.run_checks({
        "fact_sales": repeated_sales_of(spark, sf_dir),
        "fact_sensor_readings": keyed(d.readings(spark, sf_dir, repeats=True)),
        "fact_trades": keyed(d.trades(spark, sf_dir)),
        "fact_social_engagement": fact_social_of(spark, sf_dir),
    })


@query(o.sql((o.EV, o.REPEATED_READINGS, o.TRADES, "timed as (select * from raw_readings where event_ts is not null)",
              "traded as (select * from trade_ev where event_ts is not null)"), " union all ".join([
    _check_sql("fact_sensor_readings", "reading_id", ("timed",)), _check_sql("fact_trades", "trade_id", ("traded",))])))
def dq_incremental(spark, sf_dir):
    """Declared tests on stored facts, run twice: after days were loaded and redelivered only these are read."""
    root, late = new_folder(spark, "warehouse"), (20240104, 20240111, 20240118)
    facts = {"fact_sensor_readings": d.readings(spark, sf_dir, repeats=True), "fact_trades": d.trades(spark, sf_dir)}
    spec = {name: quality.CHECKS[name] for name in facts}
    for name, rows in facts.items():
        timed = rows.filter(F.col("event_ts").isNotNull()).withColumn("date_key", date_key(F.col("event_ts")))
        table = WAREHOUSE[name]
        early = timed.filter(~F.col("date_key").isin(*late) | (F.col("date_key") != late[0]) & (F.hour("event_ts") < 12))
        maintenance.store_table(early, root, table)
        whole = spark.read.parquet(sinks.write_gold_fact(sinks.project_to(timed, table.schema), root, f"gold_{name}", many_days=True))
        checks.run_checks_by_day(spark, root, f"{root}/index", {name: spec[name]})
        for day in late:
            sinks.load_fact(whole.filter(F.col("date_key") == day), root, name, day)
    return checks.run_checks_by_day(spark, root, f"{root}/index", spec)


@query(o.sql((o.ORDERS, o.REPEATED_SALES), "select sale_id, count(*) as rows from sales_rows group by 1 having count(*) > 1"))
def dq_unique(spark, sf_dir):
    return quality.check_unique(repeated_sales_of(spark, sf_dir), "sale_id")


@query(o.sql((o.EV, o.TRADES), "select asset, side, event_type, event_ts from trade_ev where trade_id is null"))
def dq_not_null(spark, sf_dir):
    failed = quality.check_not_null(d.trades(spark, sf_dir), "trade_id")
    return comparable(failed.select("asset", "side", "event_type", "event_ts"))


RULE_VALUES = ", ".join(
    f"({i}, '{r.name}', '{r.response}', {'null' if r.report is None else repr(r.report)})"
    for i, r in enumerate((*text.RULES, text.NO_MATCH), start=1))


@query(o.sql((o.QUESTIONS_CTE, o.ROUTED_CTE), f"""
, rules as (select * from (values {RULE_VALUES}) t(n, rule, response, report))
select conv_id, turn, question, rule, response, report from routed join rules using (n)"""))
def route_questions(spark, sf_dir):
    return text.route_questions(d.questions(spark, sf_dir), "question")


@query(o.sql((o.STATEMENTS_CTE,), f"select conv_id, turn, {o.CLEAN_SQL} as clean_sql from statements"))
def clean_sql(spark, sf_dir):
    return text.clean_sql_column(d.statements(spark, sf_dir), "answer").select("conv_id", "turn", "clean_sql")


_WORDS = "|".join(text.FORBIDDEN_WORDS)


@query(o.sql((o.STATEMENTS_CTE,), f"""
, cleaned as (select conv_id, turn, upper({o.CLEAN_SQL}) as c from statements)
select conv_id, turn, starts_with({o.stripped('c')}, 'SELECT') and not {o.word_match('c', _WORDS)} as is_safe,
  starts_with({o.stripped('c')}, 'SELECT') and not regexp_matches(c, '{_WORDS}') as is_safe_strict from cleaned"""))
def select_only(spark, sf_dir):
    cleaned = text.clean_sql_column(d.statements(spark, sf_dir), "answer")
    flagged = text.select_only_flag(cleaned, "clean_sql")
    flagged = text.select_only_flag(flagged, "clean_sql", "is_safe_strict", whole_words=False)
    return flagged.select("conv_id", "turn", "is_safe", "is_safe_strict")


@query(o.sql(o.SALES, """
select 'facts' as dag_id, 'gold' as stage, 'success' as status, (select count(*) from orders_ev) as rows_read,
  (select count(*) from fact_sales where lower(trim(status)) <> 'cancelled') as rows_written"""))
def run_log(spark, sf_dir):
    """A logged job: rows read and written are counted while it runs."""
    root = new_folder(spark, "runs")
    rows = d.as_silver(d.orders(spark, sf_dir), "transactions")
    runlog.record_run(
        spark, f"{root}/log", "facts", "gold", rows,
        lambda df: gold.build_fact("fact_sales", df).filter(F.lower(F.trim("status")) != marts.CANCELLED),
        lambda df: sinks.replace_folder(df, f"{root}/fact_sales"))
    return spark.read.parquet(f"{root}/log").select("dag_id", "stage", "status", "rows_read", "rows_written")


def _landed(spark, sf_dir):
    root = new_folder(spark, "bronze")
    arrived = F.lit("2024-02-01 07:30:00").cast("timestamp")
    for topic, feed in d.FEEDS.items():
        folder = written_feed(spark, feed(spark, sf_dir), topic)
        drain(landing.land_bronze(read_events(spark, topic, text_stream(folder)), topic, root,
                                  f"{root}/_checkpoints/{topic}", True, arrived))
    return root


@query(o.sql(ALL_EVENTS, f"""
, messages as ({MESSAGES})
select replace(name, 'silver_', '') as source, messages as rows, true as has_files, true as has_bytes from messages"""))
def layer_stats(spark, sf_dir):
    """Files, bytes and rows of every source of the raw layer."""
    root, parts = _landed(spark, sf_dir), []
    for topic in TOPICS:
        parts.append(layers.read_bronze(spark, root, topic, "2024-02-01").agg(
            F.lit(topic).alias("source"), F.count(F.lit(1)).alias("rows")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    stats = runlog.layer_stats(spark, root)
    return rows.join(stats, "source").select("source", "rows", (F.col("files") > 0).alias("has_files"),
                                             (F.col("size_bytes") > 0).alias("has_bytes"))


# ---------------------------------------------------------------- insight log

INSIGHTS_SQL = """
, insights as (
  select concat_ws('-', 'IN', conv_id, turn) as insight_id, case when turn = 0 then 'text2sql' else 'insight' end as query_type,
    question as user_query, response, 'rules' as model_used, turn + 1 as latency_ms,
    timestamp '2023-12-31 00:00:00' + to_minutes(cast(conv_id * 10 + turn as int)) as created_at
  from routed join (values {values}) t(n, rule, response, report) using (n))""".replace("{values}", RULE_VALUES)
INSIGHT_PARTS = (o.QUESTIONS_CTE, o.ROUTED_CTE)
INSIGHT_COLUMNS = "insight_id, query_type, user_query, response, model_used, latency_ms, created_at"


def insights_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.route_questions(d.insights(spark, sf_dir), "user_query")


@query(o.sql(INSIGHT_PARTS, f"{INSIGHTS_SQL} select {INSIGHT_COLUMNS} from insights"))
def insight_log(spark, sf_dir):
    """Answered questions appended to the log, by two writers."""
    path = f"{new_folder(spark, 'log')}/llm_insights"
    for kind in ("text2sql", "insight"):
        rows = insights_of(spark, sf_dir).filter(F.col("query_type") == kind)
        sinks.append_log(rows, path, WAREHOUSE["llm_insights"])
    stored = layers.read_warehouse(spark, path.rsplit("/", 1)[0], "llm_insights")
    return comparable(stored.drop("generated_sql"))


# ---------------------------------------------------------------- reports


def report_tables(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    return {
        "fact_sales": lambda: fact_sales_of(spark, sf_dir),
        "fact_sensor_readings": lambda: fact_sensors_of(spark, sf_dir),
        "fact_social_engagement": lambda: fact_social_of(spark, sf_dir),
        "agg_daily_revenue": lambda: daily_revenue_of(spark, sf_dir),
        "agg_hourly_sensor": lambda: hourly_sensor_of(spark, sf_dir),
        "agg_trading_volume": lambda: trading_volume_of(spark, sf_dir),
        "mart_trading_volume": lambda: trading_volume_of(spark, sf_dir),
        "stg_sensors": lambda: staging.stg_sensors(fact_sensors_of(spark, sf_dir)),
        "stg_social": lambda: staging.stg_social(fact_social_of(spark, sf_dir)),
        "silver_social": lambda: d.as_silver(d.posts(spark, sf_dir), "social"),
        "llm_insights": lambda: insights_of(spark, sf_dir),
    }


def report(name: str, sql: str, as_of: datetime = d.EVENTS_AS_OF, digits: dict[str, int] | None = None) -> None:
    @query(sql, name=f"report_{name}")
    def build(spark, sf_dir):
        return comparable(reports.run_report(name, report_tables(spark, sf_dir), as_of), digits)


report("revenue_by_day", o.sql(o.SALES, """
select cast(event_ts as date) as date, cast(sum(total_amount) as double) as revenue from fact_sales
where event_ts >= timestamp '2001-07-01 12:00:00' group by 1"""), d.SALES_AS_OF)
for _limit, _name in ((10, "top_products"), (5, "top_5_products")):
    report(_name, o.sql(o.SALES, f"""
select product_id, cast(sum(total_amount) as double) as revenue, cast(sum(quantity) as bigint) as units
from fact_sales group by 1 order by sum(total_amount) desc, product_id limit {_limit}"""))
report("latest_anomalies", o.sql(o.ANOMALIES, """
select location_id, hour_ts, round(avg_temp, 4) as avg_temp, anomaly_flag from agg_hourly_sensor
where anomaly_flag = 1 order by hour_ts desc, location_id limit 50"""), digits={"avg_temp": 4})
report("trading_volume", o.sql(o.TRADING, """
select asset, sum(total_volume) as volume, round(avg(avg_price), 9) as avg_price from trading_volume
where full_date >= date '2024-01-23' group by 1"""), digits={"avg_price": 9})
report("platform_engagement", o.sql(o.SOCIAL, """
select platform, cast(sum(likes) as bigint) as likes, cast(sum(shares) as bigint) as shares,
  cast(sum(comments) as bigint) as comments from fact_social group by 1"""))
report("sensor_overview", o.sql(o.SENSORS, """
select location_id, round(avg(temperature), 4) as avg_temp, round(avg(humidity), 4) as avg_humidity, count(*) as readings
from fact_sensors where event_ts >= timestamp '2024-01-30 19:30:00' group by 1"""),
       digits={"avg_temp": 4, "avg_humidity": 4})
report("revenue_by_region", o.sql(o.REVENUE, """
select region, round(sum(total_revenue), 2) as total_revenue from daily_revenue
where full_date >= date '2001-07-24' group by 1 order by 2 desc, 1 limit 50"""), d.SALES_AS_OF,
       digits={"total_revenue": 2})
report("sales_count", o.sql(o.SALES, "select count(*) as rows from fact_sales"))
report("reading_count", o.sql(o.SENSORS, "select count(*) as rows from fact_sensors"))
report("insight_count", o.sql(INSIGHT_PARTS, f"""{INSIGHTS_SQL}
select count(*) as rows from insights where created_at >= timestamp '2023-12-31 12:00:00'"""), d.INSIGHTS_AS_OF)
report("recent_anomaly_count", o.sql(o.ANOMALIES, """
select count(*) as rows from agg_hourly_sensor where anomaly_flag = 1 and hour_ts >= timestamp '2024-01-28 12:30:00'"""),
       datetime(2024, 1, 28, 13, 30))
report("revenue_over_time", o.sql(o.REVENUE, """
select full_date as time, round(sum(total_revenue), 2) as revenue from daily_revenue group by 1"""),
       digits={"revenue": 2})
report("temperature_series", o.sql(o.ANOMALIES, """
select hour_ts as time, location_id, round(avg_temp, 4) as avg_temp from agg_hourly_sensor
where hour_ts >= timestamp '2024-01-30 14:30:00'"""), digits={"avg_temp": 4})
report("top_assets", o.sql(o.TRADING, """
select asset, sum(total_volume) as volume from trading_volume where full_date >= date '2024-01-23'
group by 1 order by 2 desc, 1 limit 10"""))
report("insight_history", o.sql(INSIGHT_PARTS, f"""{INSIGHTS_SQL}
select {INSIGHT_COLUMNS} from insights order by created_at desc, insight_id limit 20"""), d.INSIGHTS_AS_OF)
report("regions_vs_average", o.sql(o.REVENUE, """
, regions as (select full_date, region, round(sum(total_revenue), 2) as revenue from daily_revenue group by 1, 2),
compared as (select *, avg(revenue) over (partition by full_date) as avg_revenue from regions)
select full_date, region, revenue, round(avg_revenue, 6) as avg_revenue,
  case when revenue > avg_revenue then 'above' when revenue < avg_revenue then 'below' else 'equal' end as position
from compared"""), digits={"revenue": 2, "avg_revenue": 6})
report("top_assets_vs_previous_day", o.sql(o.TRADING, """
, daily as (select full_date, asset, sum(total_volume) as volume from trading_volume group by 1, 2),
ranked as (select t.full_date, t.asset, t.volume, y.volume as previous_volume,
  cast(row_number() over (partition by t.full_date order by t.volume desc, t.asset) as int) as position
  from daily t left join daily y on y.asset = t.asset and y.full_date = t.full_date - 1)
select * from ranked where position <= 3"""))
report("engagement_growth", o.sql(o.SOCIAL, """
, weekly as (select platform, cast(date_trunc('week', event_ts) as date) as week,
  cast(sum(weighted_engagement) as bigint) as engagement from stg_social group by 1, 2)
select w.platform, w.week, w.engagement, b.engagement as previous_engagement,
  round(cast(w.engagement - b.engagement as double) / b.engagement, 6) as growth
from weekly w left join weekly b on b.platform = w.platform and b.week = w.week - 7"""), digits={"growth": 6})
report("unusual_locations", o.sql(o.ANOMALIES, """
select location_id, hour_ts, reading_count, round(avg_temp, 4) as avg_temp, round(avg_pressure, 4) as avg_pressure,
  cast(date_trunc('day', hour_ts) as timestamp) as day_ts,
  round(avg_temp_day, 4) as avg_temp_day, round(std_temp_day, 4) as std_temp_day,
  round(avg_pressure_day, 4) as avg_pressure_day, round(std_pressure_day, 4) as std_pressure_day, temp_anomaly,
  abs(avg_pressure - avg_pressure_day) > 3 * std_pressure_day as pressure_anomaly
from annotated where hour_ts >= timestamp '2024-01-21 06:00:00'
  and (temp_anomaly or abs(avg_pressure - avg_pressure_day) > 3 * std_pressure_day)"""), datetime(2024, 1, 21, 12),
       digits=dict.fromkeys(("avg_temp", "avg_pressure", "avg_temp_day", "std_temp_day", "avg_pressure_day",
                             "std_pressure_day"), 4))
report("status_breakdown", o.sql(o.SALES, """
select status, count(*) as orders, cast(sum(total_amount) as double) as revenue from fact_sales group by 1"""))
report("anomaly_heatmap", o.sql(o.ANOMALIES, "select location_id, " + ", ".join(
    f"count(*) filter (where hour(hour_ts) = {h} and anomaly_flag = 1) as h{h:02d}" for h in range(24))
    + " from agg_hourly_sensor group by 1"))
report("buy_sell_ratio", o.sql(o.TRADING, """
select asset, cast(sum(buy_count) as bigint) as buys, cast(sum(sell_count) as bigint) as sells,
  round(cast(sum(buy_count) as double) / nullif(sum(sell_count), 0), 6) as ratio from trading_volume group by 1"""),
       digits={"ratio": 6})
report("price_trend", o.sql(o.TRADING, "select asset, full_date, avg_price from trading_volume"))
report("sentiment_breakdown", o.sql(o.SOCIAL, """
select platform, sentiment, count(*) as posts from post_ev group by 1, 2"""))
