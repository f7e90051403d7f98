"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import re

import pytest

import __spark_entry__ as contract
from tidemark.catalogue.queries import QUERIES
from verify import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, small, name):
    same, note = compare(spark, con, small, name)
    assert same, note


def test_flagship(spark):
    rows = contract.entry(spark)
    assert rows.count() > 0
    assert rows.columns == ["date_key", "full_date", "region", "category", "total_orders", "total_revenue",
                            "avg_order_value", "total_units"]


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_names():
    assert not [n for n in QUERIES if re.match(r"op\d+_|.*pipeline", n)]


def test_scans_read_only_needed_columns(spark, small, plan):
    text = plan(contract.queries()["report_sentiment_breakdown"](spark, small))
    assert "user_id" in text and "value:double" not in text.split("ReadSchema")[1]


def test_time_filters_reach_the_files(spark, small, plan):
    """Filters on a stored fact; facts that are built on the fly keep the newest row per key first."""
    from tidemark.catalogue.queries import fact_trades_of
    from tidemark.operators.maintenance import store_table
    from tidemark.plans.refresh import refresh_trading_volume
    from tidemark.catalogue.domain import EVENTS_AS_OF
    from tidemark.schemas import WAREHOUSE
    from tidemark.session import new_folder
    from tidemark.sources.layers import read_warehouse

    root = new_folder(spark, "warehouse")
    store_table(fact_trades_of(spark, small), root, WAREHOUSE["fact_trades"])
    text = plan(refresh_trading_volume(read_warehouse(spark, root, "fact_trades"), EVENTS_AS_OF))
    assert "GreaterThanOrEqual(event_ts," in text and "date_key" in text.split("PartitionFilters")[1].split("]")[0]


def scans(node):
    """Metrics of all scans of an executed plan."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        yield from scans(node.plan())
    if kind == "FileSourceScanExec":
        yield node.metrics()
    for i in range(node.children().size()):
        yield from scans(node.children().apply(i))


def test_calendar_prunes_the_days_of_a_stored_fact(spark, small, plan):
    """Weekends are chosen while the query runs: the folders read are those of their days."""
    result = contract.queries()["weekend_trading"](spark, small)
    days = {r.date_key for r in result.collect()}
    read = [m.apply("numPartitions").value() for m in scans(result._jdf.queryExecution().executedPlan()) if m.contains("numPartitions")]
    assert "dynamicpruning" in plan(result) and read == [len(days)] and len(days) < 12
