"""The given tables, seen as orders, customers, products, readings, trades, posts and questions.

Only projections, so every query below reads its whole tables. Dirt is part of the
mapping: blanks, wrong spelling, missing keys, repeated events and one guest account
that owns a fifth of all sales.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ENTITIES
from tidemark.sources.seeds import SENSOR_LOCATIONS

# The data ends on these days; reports look back from here.
SALES_AS_OF = datetime(2001, 7, 31, 12)
EVENTS_AS_OF = datetime(2024, 1, 30, 20, 30)
LATENESS = "31 days"  # the events span a month: none is late
INSIGHTS_AS_OF = datetime(2024, 1, 1, 12)

# Names used in events.
ASSETS = ("BTC", "ETH", "AAPL", "GOOGL", "TSLA", "MSFT", "AMZN", "SPY", "QQQ", "GLD")
PLATFORMS = ("twitter", "instagram", "facebook", "tiktok", "linkedin", "reddit")
CONTENT_TYPES = ("post", "reel", "story", "comment", "share", "review")
POST_TOPICS = ("tech", "food", "travel", "fashion", "sports", "politics", "entertainment", "finance")
SENTIMENTS = ("positive", "neutral", "negative")

BATCH = "carrier"

# Questions in front of the conversation texts; the last one matches no rule.
QUESTIONS = (
    "What is the TOTAL of all revenue?", "Show the best selling product", "Any unusual spike today?",
    "crypto trade please", "Which platform do people like?", "humidity and temperature now",
    "Is the pipeline status fine?", "Sum up\nthe sales", "Good morning",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string"))


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


# ---------------------------------------------------------------- orders


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events: one per line item; (order, line) repeats, so there is something to de-duplicate."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    quantity = F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    total = (F.when(F.col("l_quantity") == 1, -price)
             .when(F.col("l_discount") == 0, F.lit(0))
             .otherwise(price * quantity))
    status = (F.when(F.col("l_returnflag") == "R", " Cancelled ")
              .when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "shipped").otherwise("pending"))
    return lines.select(
        F.concat_ws("-", F.lit("ORD"), "l_orderkey", "l_linenumber").alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "CUST-GUEST")
        .otherwise(_text("CUST-", "o_custkey")).alias("customer_id"),
        F.when(F.col("l_linenumber") == 7, "PROD-GIFT")
        .otherwise(_text("PROD-", "l_partkey")).alias("product_id"),
        quantity.alias("quantity"), price.alias("unit_price"),
        total.cast("decimal(12,2)").alias("total_amount"), status.alias("status"),
        F.when(F.col("l_linestatus") == "O", "credit_card").otherwise("paypal").alias("payment_method"),
        F.col("o_orderdate").alias("event_ts"), F.lit("order_created").alias("event_type"),
    )


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations; two segments register again later, one again at the same moment."""
    people = (table(spark, sf_dir, "customer")
              .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
              .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    segment = F.col("c_mktsegment")
    later, tied = segment.isin("BUILDING", "MACHINERY"), segment == "HOUSEHOLD"
    versions = people.withColumn(
        "_v", F.explode(F.when(later | tied, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    second = F.col("_v") == 2
    days = F.col("c_nationkey") + F.when(second & later, 100).otherwise(0)
    region = (F.when(second & later, "International").when(second, "Central")
              .when((segment == "FURNITURE") & (F.col("c_acctbal") < 0), F.lit(None))
              .otherwise(F.col("r_name")))
    return versions.select(
        _text("CUST-", "c_custkey").alias("customer_id"),
        F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"), region.alias("region"),
        F.when(F.col("c_acctbal") < 0, "18-25").otherwise("26-35").alias("age_group"),
        F.date_add(F.lit("1994-01-01").cast("date"), days).cast("timestamp_ntz").alias("created_at"),
        F.lit("customer_registered").alias("event_type"),
    )


def product_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products; one brand is listed again later in another category."""
    again = F.col("p_brand") == "Brand#1"
    versions = table(spark, sf_dir, "part").withColumn(
        "_v", F.explode(F.when(again, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    second = F.col("_v") == 2
    days = F.col("p_size") + F.when(second, 100).otherwise(0)
    return versions.select(
        _text("PROD-", "p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.when(second, "CLEARANCE").otherwise(F.col("p_type")).alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("p_size").alias("stock_quantity"),
        F.date_add(F.lit("1994-01-01").cast("date"), days).cast("timestamp_ntz").alias("created_at"),
        F.lit("product_created").alias("event_type"),
    )


# ---------------------------------------------------------------- events


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn(
        "k", F.regexp_extract("props", "([0-9]+)", 1).cast("int"))


def readings(spark: SparkSession, sf_dir: str, repeats: bool = False) -> DataFrame:
    """Sensor readings. ``repeats`` adds corrected readings, some later, some at the same time."""
    events = _events(spark, sf_dir)
    kind, value, k = F.col("event_type"), F.col("value"), F.col("k")
    copy = F.lit(0)
    if repeats:
        once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
        copies = F.when(kind.isin("click", "purchase"), twice).otherwise(once)
        events, copy = events.withColumn("_copy", F.explode(copies)), F.col("_copy")
    site = F.when(kind == "signup", 0).otherwise(F.col("user_id") % 5).cast("int")
    hot_hour = ((F.hour("ts") == 13) & (site == 2) & (F.dayofmonth("ts") % 7 == 0))
    spike = F.when(hot_hour, 40).when((kind == "error") & (value >= 150), 60).otherwise(0)
    later = F.when((copy == 1) & (kind == "click"), 1).otherwise(0)
    temperature = F.when(~((kind == "view") & (value < 1)), 22 + value % 8 + spike + later)
    pressure = (F.when(k == 99, 800).when(k == 0, 870).when(k == 1, 1085).otherwise(k + 963))
    humidity = F.when(k == 98, -1).when(value > 480, 100.5).otherwise(k + copy / 2)
    stamp = (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), later))
    return events.select(
        F.when(~((kind == "error") & (value < 0.5)), _text("RD-", "event_id")).alias("reading_id"),
        _pick(tuple(s[0] for s in SENSOR_LOCATIONS), site).alias("location_id"),
        _pick(tuple(s[1] for s in SENSOR_LOCATIONS), site).alias("site_name"),
        temperature.cast("float").alias("temperature"),
        pressure.cast("float").alias("pressure"),
        humidity.cast("float").alias("humidity"),
        (value / 1000).cast("float").alias("vibration"),
        F.get(F.array(*[F.lit(s[2]) for s in SENSOR_LOCATIONS]), site).cast("float").alias("lat"),
        F.get(F.array(*[F.lit(s[3]) for s in SENSOR_LOCATIONS]), site).cast("float").alias("lon"),
        (kind == "error").alias("is_anomaly"),
        k.cast("float").alias("battery_pct"),
        F.when(~((kind == "purchase") & (value < 0.5)), stamp).alias("event_ts"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades in mixed spelling; a fifth of the events are transfers without a trade id."""
    k = F.col("k")
    asset = _pick(ASSETS, F.col("user_id") % 10)
    transfer = F.col("event_type") == "signup"
    price = F.when(k == 7, F.lit(0)).otherwise(F.col("value").cast("decimal(10,2)") * 4)
    side = _pick(("buy", " BUY ", "sell", "Sell", "hold"), k % 5)
    return _events(spark, sf_dir).select(
        F.when(~transfer, _text("TR-", "event_id")).alias("trade_id"),
        F.when(k % 3 == 0, F.concat(F.lit(" "), F.lower(asset), F.lit(" "))).otherwise(asset).alias("asset"),
        side.alias("side"),
        (k / 4).cast("float").alias("quantity"),
        price.cast("decimal(18,8)").alias("price"),
        (F.col("value").cast("decimal(10,2)") * k).cast("decimal(18,4)").alias("total_value"),
        F.when(k % 2 == 0, "NYSE").otherwise("LSE").alias("exchange"),
        F.col("ts").alias("event_ts"),
        F.when(transfer, "transfer").otherwise("trade_executed").alias("event_type"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    platform = _pick(PLATFORMS, F.col("user_id") % 6)
    return _events(spark, sf_dir).select(
        _text("PO-", "event_id").alias("post_id"), _text("U-", "user_id").alias("user_id"),
        F.when(k % 4 == 0, F.concat(F.lit(" "), F.upper(platform)))
        .when(k != 13, platform).alias("platform"),
        F.initcap(_pick(CONTENT_TYPES, F.col("event_id") % 6)).alias("content_type"),
        _pick(POST_TOPICS, k % 8).alias("topic"),
        F.floor("value").cast("int").alias("likes"), (k % 10).alias("shares"), k.alias("comments"),
        _pick(SENTIMENTS, F.col("event_id") % 3).alias("sentiment"),
        (F.col("value") / 100).cast("float").alias("engagement_score"),
        (F.col("event_type") == "purchase").alias("is_sponsored"),
        F.col("ts").alias("event_ts"),
    )


# ---------------------------------------------------------------- raw forms


def _json(df: DataFrame, time_column: str = "event_ts") -> Column:
    fields = [iso(F.col(c)).alias(c) if c == time_column else F.col(c) for c in df.columns]
    return F.to_json(F.struct(*fields))


def sensor_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as an untyped file holds them: text, blanks, one column missing, one foreign,
    one in other letter case."""
    typed = readings(spark, sf_dir, repeats=True)
    text = typed.select([F.col(c).cast("string").alias(c) for c in typed.columns if c != "event_ts"]
                        + [iso(F.col("event_ts")).alias("event_ts")])
    return text.select(
        F.coalesce("reading_id", F.lit("")).alias("reading_id"),
        F.col("location_id").alias("Location_ID"), "site_name",
        F.coalesce("temperature", F.lit("abc")).alias("temperature"),
        "pressure", "humidity", "lat", "lon",
        F.initcap("is_anomaly").alias("is_anomaly"),
        F.when(F.col("battery_pct") == "0.0", "None").otherwise(F.col("battery_pct")).alias("battery_pct"),
        F.coalesce("event_ts", F.lit("None")).alias("event_ts"),
        F.lit("multi").alias("sensor_type"),
    )


def transaction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, customers and products as one raw layer of text columns."""
    mixed = orders(spark, sf_dir)
    for other in (customer_events(spark, sf_dir), product_events(spark, sf_dir)):
        mixed = mixed.unionByName(other, allowMissingColumns=True)
    return mixed.select([F.col(c).cast("string").alias(c) for c in mixed.columns])


def sensor_feed(spark: SparkSession, sf_dir: str, broken: bool = False) -> DataFrame:
    """JSON messages of readings; ``broken`` adds wrong types and cut-off lines."""
    typed = readings(spark, sf_dir, repeats=True)
    line = _json(typed)
    if broken:
        line = (F.when(F.col("temperature").isNull(), F.concat(F.lit('{"temperature":"abc",'), F.substr(line, F.lit(2))))
                .when(F.col("humidity") < 0, F.left(line, F.lit(40))).otherwise(line))
    return typed.select(line.alias("value"))


def late_sensor_feed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The messages of readings in three parts: what came in time, a later week, and what came after both."""
    typed = readings(spark, sf_dir, repeats=True)
    early = F.dayofmonth("event_ts") <= 20
    late = early & ((F.minute("event_ts") < 20) | (F.hour("event_ts") == 3))
    return [typed.filter(part).select(_json(typed).alias("value")) for part in (early & ~late, ~early, late)]


def sensor_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages, one per reading."""
    typed = readings(spark, sf_dir)
    return typed.select(_json(typed).alias("value"))


def closing_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading far behind the last event: it moves the watermark past every real hour."""
    last = table(spark, sf_dir, "events").agg(F.max("ts").alias("last"))
    after = F.col("last") + F.make_dt_interval(F.lit(40))
    return last.select(F.to_json(F.struct(F.lit("CLOSE").alias("reading_id"), iso(after).alias("event_ts"))).alias("value"))


def trade_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = trades(spark, sf_dir)
    return typed.select(_json(typed).alias("value"))


def post_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = posts(spark, sf_dir)
    return typed.select(_json(typed).alias("value"))


def transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed topic: orders, customers and products in one stream of messages."""
    return _mixed(spark, sf_dir, orders(spark, sf_dir))


def _mixed(spark: SparkSession, sf_dir: str, order_events: DataFrame) -> DataFrame:
    return _messages((order_events, "event_ts"), (customer_events(spark, sf_dir), "created_at"),
                     (product_events(spark, sf_dir), "created_at"))


def _messages(*parts: tuple[DataFrame, str]) -> DataFrame:
    lines = [df.withColumn("source", F.lit("ecommerce")) for df, _ in parts]
    first, *rest = [df.select(_json(df, ts).alias("value")) for df, (_, ts) in zip(lines, parts, strict=True)]
    for other in rest:
        first = first.unionByName(other)
    return first


FEEDS = {"transactions": transaction_feed, "sensors": sensor_feed, "financial": trade_feed, "social": post_feed}


def broken_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed topic with unknown types, missing keys and times, a wrong type and cut-off lines."""
    lost = orders(spark, sf_dir).withColumn("event_type", F.when(F.col("quantity") == 1, "order_lost").otherwise(F.col("event_type")))
    nobody = customer_events(spark, sf_dir).withColumn(
        "customer_id", F.when(F.col("age_group") != "18-25", F.col("customer_id")))
    products = product_events(spark, sf_dir)
    undated = products.withColumn("created_at", F.when(F.col("stock_quantity") != 1, F.col("created_at")))
    feed = _messages((lost, "event_ts"), (nobody, "created_at"))
    line = _json(undated, "created_at")
    line = (F.when(F.col("stock_quantity") == 2, F.left(line, F.lit(40)))
            .when(F.col("stock_quantity") == 3, F.regexp_replace(line, '"price":[0-9.]+', '"price":"abc"')).otherwise(line))
    return feed.unionByName(undated.select(line.alias("value")))


def trades_with_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades and transfers, each with its own key; every transfer to a NYSE account lacks it."""
    typed = trades(spark, sf_dir)
    transfer = (F.col("event_type") == "transfer") & (F.col("exchange") == "LSE")
    keyed = typed.withColumn("transfer_id", F.when(transfer, "TF-1"))
    return keyed.select(_json(keyed).alias("value"))


BROKEN_FEEDS = {
    "transactions": broken_transactions,
    "sensors": lambda spark, sf_dir: sensor_feed(spark, sf_dir, broken=True),
    "financial": trades_with_transfers,
    "social": post_feed,
}


# ---------------------------------------------------------------- silver and text


def as_silver(df: DataFrame, entity: str) -> DataFrame:
    """Typed events as they leave the silver layer: own event type only, key and time present."""
    spec = ENTITIES[entity]
    if spec.event_type:
        df = df.filter(F.col("event_type") == spec.event_type)
    df = df.withColumnRenamed(spec.time_column, "event_ts").withColumn("_batch_id", F.lit(BATCH))
    return df.filter(F.col(spec.key).isNotNull() & F.col("event_ts").isNotNull())


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question in front of every conversation text."""
    lead = _pick(QUESTIONS, F.col("conv_id") % len(QUESTIONS))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.concat_ws(" ", lead, "text").alias("question"))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model answers that hold SQL around every conversation text, with and without fences."""
    text = F.replace(F.col("text"), F.lit("'"), F.lit("''"))
    case = F.col("conv_id") % 6
    raw = (F.when(case == 0, F.concat(F.lit("```sql\nselect '"), text, F.lit("' as t;\n```")))
           .when(case == 1, F.concat(F.lit("  SELECT created_at, '"), text, F.lit("'; DROP TABLE x;")))
           .when(case == 2, F.concat(F.lit("```\nDROP TABLE t -- "), text, F.lit("\n```")))
           .when(case == 3, F.concat(F.lit("select 1 /* "), text, F.lit(" */ union delete from t")))
           .when(case == 4, F.concat(F.lit("```SQL select updated_at from t where a = '"), text, F.lit("' ```")))
           .otherwise(F.col("text")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", raw.alias("answer"))


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows of answered questions, ten minutes apart per conversation."""
    base = F.lit("2023-12-31 00:00:00").cast("timestamp_ntz")
    minutes = (F.col("conv_id") * 10 + F.col("turn")).cast("int")
    return questions(spark, sf_dir).select(
        F.concat_ws("-", F.lit("IN"), "conv_id", "turn").alias("insight_id"),
        F.when(F.col("turn") == 0, "text2sql").otherwise("insight").alias("query_type"),
        F.col("question").alias("user_query"), F.lit("rules").alias("model_used"),
        (F.col("turn") + 1).alias("latency_ms"),
        (base + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("created_at"),
    )
