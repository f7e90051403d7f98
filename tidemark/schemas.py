"""One registry of every schema: batch jobs, streams and the warehouse read it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

DAY_COLUMNS = ("_year", "_month", "_day")
DAY_DDL = "_year int, _month int, _day int"


def parse_ddl(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@dataclass(frozen=True)
class Entity:
    """A kind of event: where it comes from, its key and its typed columns."""

    name: str
    topic: str
    key: str
    ddl: str
    event_type: str | None = None
    time_column: str = "event_ts"
    dimension: bool = False

    @property
    def schema(self) -> T.StructType:
        return parse_ddl(self.ddl)

    @property
    def silver_ddl(self) -> str:
        """Typed columns plus lineage; the time column is always called event_ts."""
        columns = self.ddl.replace(f"{self.time_column} timestamp", "event_ts timestamp")
        return f"{columns}, _processed_at timestamp, _batch_id string, {DAY_DDL}"

    @property
    def silver_schema(self) -> T.StructType:
        return parse_ddl(self.silver_ddl)

    @property
    def partitions(self) -> tuple[str, ...]:
        """Folders of the silver table: events by day and batch; dimensions, which are read whole, by batch."""
        return ("_batch_id",) if self.dimension else (*DAY_COLUMNS, "_batch_id")


# Entity columns, types, keys, topics and event type names.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "transactions", topic="transactions", key="order_id", event_type="order_created",
            ddl="order_id string, customer_id string, product_id string, quantity int, "
                "unit_price decimal(10,2), total_amount decimal(12,2), status string, "
                "payment_method string, event_ts timestamp, event_type string",
        ),
        Entity(
            "customers", topic="transactions", key="customer_id", event_type="customer_registered",
            time_column="created_at", dimension=True,
            ddl="customer_id string, email string, name string, region string, "
                "age_group string, created_at timestamp, event_type string",
        ),
        Entity(
            "products", topic="transactions", key="product_id", event_type="product_created",
            time_column="created_at", dimension=True,
            ddl="product_id string, name string, category string, price decimal(10,2), "
                "stock_quantity int, created_at timestamp, event_type string",
        ),
        Entity(
            "sensors", topic="sensors", key="reading_id",
            ddl="reading_id string, location_id string, site_name string, temperature float, "
                "pressure float, humidity float, vibration float, lat float, lon float, "
                "is_anomaly boolean, battery_pct float, event_ts timestamp",
        ),
        Entity(
            "financial", topic="financial", key="trade_id", event_type="trade_executed",
            ddl="trade_id string, asset string, side string, quantity float, "
                "price decimal(18,8), total_value decimal(18,4), exchange string, "
                "event_ts timestamp, event_type string",
        ),
        Entity(
            "social", topic="social", key="post_id",
            ddl="post_id string, user_id string, platform string, content_type string, "
                "topic string, likes int, shares int, comments int, sentiment string, "
                "engagement_score float, is_sponsored boolean, event_ts timestamp",
        ),
    )
}

# Events of mixed topics that no table is made of: topic, type, key and time.
OTHER_EVENTS = {"financial": {"transfer": ("transfer_id", "event_ts")}}

TOPICS = ("transactions", "sensors", "financial", "social")


def topic_entities(topic: str) -> list[Entity]:
    found = [e for e in ENTITIES.values() if e.topic == topic]
    if not found:
        raise ValueError(f"unknown topic {topic!r}; known: {', '.join(TOPICS)}")
    return found


def topic_schema(topic: str) -> T.StructType:
    """All columns an event of this topic may carry, plus event_type and source."""
    columns: dict[str, T.StructField] = {}
    for entity in topic_entities(topic):
        for column in entity.schema.fields:
            columns.setdefault(column.name, column)
    for name in ("event_type", "source"):
        columns.setdefault(name, T.StructField(name, T.StringType()))
    return T.StructType(list(columns.values()))


def required_fields(topic: str) -> dict[str | None, tuple[str, str]]:
    """Key and time of every type of event in a topic; a topic of one kind has the type None."""
    found = {e.event_type: (e.key, e.time_column) for e in topic_entities(topic)}
    return found | OTHER_EVENTS.get(topic, {})


def bronze_columns(topic: str) -> list[str]:
    return [c for c in topic_schema(topic).names if c != "source"]


@dataclass(frozen=True)
class Table:
    """A warehouse table: columns, storage partition, order inside it, how long rows stay."""

    name: str
    ddl: str
    order_by: tuple[str, ...]
    time_column: str | None = None
    partition_format: str | None = None
    slice_format: str | None = None
    keep: dict[str, int] = field(default_factory=dict)
    version_column: str | None = None
    additive: tuple[str, ...] = ()
    weighted: dict[str, str] = field(default_factory=dict)
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)
    flags: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return parse_ddl(self.ddl)

    @property
    def slice_column(self) -> str:
        """The innermost folder, what a run replaces: the stored day key, or a slice of time."""
        return "date_key" if self.slice_format is None else "_s"

    @property
    def partitions(self) -> tuple[str, str]:
        """``_p`` is the declared month or day; inside it a folder for each slice."""
        return "_p", self.slice_column

    @property
    def stored_schema(self) -> T.StructType:
        names = [n for n in self.partitions if n not in self.schema.names]
        return parse_ddl(", ".join([self.ddl, *(f"{n} int" for n in names)]))


# Warehouse columns, sort keys, partitions and retention.
WAREHOUSE: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "dim_date", order_by=("date_key",),
            ddl="date_key int, full_date date, year int, quarter int, month int, week int, "
                "day_of_week int, is_weekend int",
        ),
        Table(
            "dim_customer", order_by=("customer_id",), version_column="_loaded_at",
            ddl="customer_id string, email string, name string, region string, "
                "created_at timestamp, _loaded_at timestamp",
        ),
        Table(
            "dim_product", order_by=("product_id",), version_column="_loaded_at",
            ddl="product_id string, name string, category string, price decimal(10,2), "
                "_loaded_at timestamp",
        ),
        Table(
            "dim_sensor_location", order_by=("location_id",), version_column="_loaded_at",
            ddl="location_id string, site_name string, latitude double, longitude double, "
                "sensor_type string, _loaded_at timestamp",
        ),
        Table(
            "fact_sales", order_by=("date_key", "customer_id", "product_id"),
            time_column="event_ts", partition_format="yyyyMM", keep={"years": 2},
            ddl="sale_id string, order_id string, customer_id string, product_id string, "
                "date_key int, quantity bigint, unit_price decimal(10,2), "
                "total_amount decimal(12,2), status string, event_ts timestamp, "
                "_batch_id string, _loaded_at timestamp",
        ),
        Table(
            "fact_sensor_readings", order_by=("location_id", "event_ts"),
            time_column="event_ts", partition_format="yyyyMMdd", keep={"years": 1},
            ddl="reading_id string, location_id string, date_key int, temperature float, "
                "pressure float, humidity float, lat double, lon double, event_ts timestamp, "
                "_loaded_at timestamp",
        ),
        Table(
            "fact_trades", order_by=("date_key", "asset"),
            time_column="event_ts", partition_format="yyyyMM", keep={"years": 3},
            ddl="trade_id string, asset string, side string, quantity double, "
                "price decimal(18,8), total_value decimal(18,4), date_key int, "
                "event_ts timestamp, _loaded_at timestamp",
        ),
        Table(
            "fact_social_engagement", order_by=("date_key", "platform"),
            time_column="event_ts", partition_format="yyyyMM",
            ddl="post_id string, user_id string, platform string, content_type string, "
                "likes bigint, shares bigint, comments bigint, date_key int, "
                "event_ts timestamp, _loaded_at timestamp",
        ),
        Table(
            "agg_daily_revenue", order_by=("full_date", "region", "category"),
            time_column="full_date", partition_format="yyyyMM", slice_format="yyyyMMdd",
            additive=("total_orders", "total_revenue"),
            ratios={"avg_order_value": ("total_revenue", "total_orders")},
            ddl="date_key int, full_date date, region string, category string, "
                "total_orders bigint, total_revenue decimal(18,2), "
                "avg_order_value decimal(10,2), _computed_at timestamp",
        ),
        Table(
            "agg_hourly_sensor", order_by=("hour_ts", "location_id"),
            time_column="hour_ts", partition_format="yyyyMMdd", slice_format="yyyyMMddHH",
            additive=("reading_count",),
            weighted={"avg_temp": "reading_count", "avg_pressure": "reading_count",
                      "avg_humidity": "reading_count"},
            flags=("anomaly_flag",),
            ddl="hour_ts timestamp, location_id string, avg_temp float, avg_pressure float, "
                "avg_humidity float, reading_count bigint, anomaly_flag int, "
                "_computed_at timestamp",
        ),
        Table(
            "agg_trading_volume", order_by=("full_date", "asset"),
            time_column="full_date", partition_format="yyyyMM", slice_format="yyyyMMdd",
            additive=("total_volume", "trade_count"), weighted={"avg_price": "trade_count"},
            ddl="date_key int, full_date date, asset string, total_volume double, "
                "trade_count bigint, avg_price decimal(18,8), _computed_at timestamp",
        ),
        Table(
            "pipeline_runs", order_by=("started_at", "dag_id"),
            time_column="_loaded_at", partition_format="yyyyMM", slice_format="yyyyMMdd",
            ddl="run_id string, dag_id string, stage string, status string, rows_read bigint, "
                "rows_written bigint, started_at timestamp, finished_at timestamp, "
                "error_msg string, _loaded_at timestamp",
        ),
        Table(
            "llm_insights", order_by=("created_at",), time_column="created_at",
            partition_format="yyyyMM", slice_format="yyyyMMdd", keep={"days": 30},
            ddl="insight_id string, query_type string, user_query string, "
                "generated_sql string, response string, model_used string, "
                "latency_ms bigint, created_at timestamp",
        ),
    )
}

# Which events feed a fact.
FACT_SOURCES = {
    "fact_sales": "transactions",
    "fact_sensor_readings": "sensors",
    "fact_trades": "financial",
    "fact_social_engagement": "social",
}

# Fixed value: raw files are kept this many days.
BRONZE_KEEP_DAYS = 180
