"""Declared data tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The tests declared for the warehouse facts.
CHECKS: dict[str, dict[str, tuple[str, ...]]] = {
    "fact_sales": {"sale_id": ("unique", "not_null"), "total_amount": ("not_null",)},
    "fact_sensor_readings": {"reading_id": ("unique", "not_null")},
    "fact_trades": {"trade_id": ("unique", "not_null")},
    "fact_social_engagement": {"post_id": ("unique", "not_null")},
}


class QualityError(Exception):
    """At least one declared test found failing rows."""


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(col).isNull())


def _table_checks(name: str, df: DataFrame, tests: Mapping[str, Sequence[str]]) -> DataFrame:
    """All tests of one table in one scan: counts per unique key first, then their totals."""
    unique = [c for c, kinds in tests.items() if "unique" in kinds]
    nullable = [c for c, kinds in tests.items() if "not_null" in kinds]
    if len(unique) > 1:  # one key per pass
        first = {c: tuple(k for k in kinds if k != "unique" or c == unique[0])
                 for c, kinds in tests.items()}
        others = [_table_checks(name, df, {c: ("unique",)}) for c in unique[1:]]
        return reduce(DataFrame.unionByName, others, _table_checks(name, df, first))

    nulls = {c: f"_null_{c}" for c in nullable}
    missing = [F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls.items()]
    found: list[tuple[str, str, str]] = [(c, "not_null", n) for c, n in nulls.items()]
    if unique:
        key = unique[0]
        per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), *missing)
        totals = [F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1)).alias("_repeated")]
        totals += [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in nulls.values()]
        counted = per_key.agg(*totals)
        found.insert(0, (key, "unique", "_repeated"))
    else:
        counted = df.agg(*missing)
    rows = F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(t).alias("test"), F.col(n).cast("bigint").alias("failures"))
        for c, t, n in found])
    return counted.select(F.inline(rows))


def run_checks(tables: Mapping[str, DataFrame], spec: Mapping[str, Mapping[str, Sequence[str]]] = CHECKS,
               ) -> DataFrame:
    """One row per declared test: table, column, test, number of failures."""
    results = [_table_checks(name, tables[name], tests) for name, tests in spec.items()]
    return reduce(DataFrame.unionByName, results)


def require_passed(report: DataFrame) -> None:
    """Fail the run when a test failed. The report has one row per test."""
    failed = report.filter(F.col("failures") > 0).collect()
    if failed:
        raise QualityError("; ".join(
            f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed))
