"""Declared tests and the run log."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality, runlog
from tidemark.operators.sinks import replace_folder

SPEC = {"t": {"id": ("unique", "not_null"), "code": ("unique",), "amount": ("not_null",)}}


def report(spark, rows):
    df = spark.createDataFrame(rows, "id string, code string, amount int")
    return {(r.column_name, r.test): r.failures for r in quality.run_checks({"t": df}, SPEC).collect()}


def test_failures_are_counted_per_test(spark):
    rows = [("a", "x", 1), ("a", "y", None), ("b", "x", 2), (None, "z", None), (None, None, 3)]
    assert report(spark, rows) == {("id", "unique"): 1, ("id", "not_null"): 2, ("code", "unique"): 1,
                                   ("amount", "not_null"): 2}


def test_an_empty_table_passes(spark):
    assert set(report(spark, []).values()) == {0}


def test_a_failed_test_fails_the_run(spark):
    df = spark.createDataFrame([("a", "x", None)], "id string, code string, amount int")
    checks = quality.run_checks({"t": df}, SPEC)
    with pytest.raises(quality.QualityError, match="t.amount not_null: 1"):
        quality.require_passed(checks)
    quality.require_passed(checks.filter("column_name = 'id'"))


def test_failing_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "id string")
    assert [tuple(r) for r in quality.check_unique(df, "id").collect()] == [("a", 2)]
    assert quality.check_not_null(df, "id").count() == 2


def test_one_scan_per_table(spark, plan, small):
    facts = spark.read.parquet(f"{small}/events.parquet")
    spec = {"events": {"event_id": ("unique", "not_null"), "value": ("not_null",)}}
    assert plan(quality.run_checks({"events": facts}, spec)).count("FileScan parquet") == 1


def test_run_log_counts_rows_read_and_written(spark, folder):
    row = runlog.record_run(spark, f"{folder}/log", "job", "silver", spark.range(100),
                            lambda df: df.filter("id % 4 = 0"), lambda df: replace_folder(df, f"{folder}/out"))
    assert (row["rows_read"], row["rows_written"], row["status"]) == (100, 25, "success")
    logged = spark.read.parquet(f"{folder}/log").first()
    assert (logged.rows_read, logged.rows_written, logged.error_msg) == (100, 25, None)
    assert logged.started_at <= logged.finished_at


def test_run_log_records_a_failure_and_raises_it(spark, folder):
    def broken(df):
        return df.select(F.raise_error(F.lit("broken rule")).alias("x"))

    with pytest.raises(Exception, match="broken rule"):
        runlog.record_run(spark, f"{folder}/log", "job", "gold", spark.range(1), broken,
                          lambda df: replace_folder(df, f"{folder}/out"))
    logged = spark.read.parquet(f"{folder}/log").first()
    assert logged.status == "failed" and "broken rule" in logged.error_msg
    assert logged.finished_at is not None and isinstance(logged.started_at, datetime)


def test_layer_statistics(spark, folder):
    spark.range(10).coalesce(1).write.parquet(f"{folder}/source=a/day=1")
    spark.range(10).repartition(2).write.parquet(f"{folder}/source=b/day=1")
    spark.range(10).coalesce(1).write.parquet(f"{folder}/misc")
    stats = {r.source: r for r in runlog.layer_stats(spark, folder).collect()}
    assert {k: v.files for k, v in stats.items()} == {"a": 1, "b": 2, "other": 1}
    assert all(v.size_bytes > 0 for v in stats.values())
    assert runlog.layer_total(runlog.layer_stats(spark, folder)).first().total_files == 4
