"""From a question or a generated statement to rows, with a log entry."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean_sql, is_select_only, route_questions
from tidemark.operators.sinks import append_log
from tidemark.plans.reports import run_report
from tidemark.schemas import WAREHOUSE

LOG = WAREHOUSE["llm_insights"]


class UnsafeStatement(Exception):
    """The statement is not a plain SELECT."""


def answer_question(spark: SparkSession, question: str, log_path: str, as_of: datetime,
                    tables: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame | None:
    """The report that answers a question, or None when no report does; either way logged."""
    start = time.monotonic()
    asked = spark.createDataFrame([(question,)], "user_query string")
    routed = route_questions(asked, "user_query").first()
    found = run_report(routed.report, tables, as_of) if routed.report else None
    _log(spark, log_path, start, query_type="insight", user_query=question, response=routed.response, model_used="rules")
    return found


def _log(spark: SparkSession, log_path: str, start: float, **columns: str | None) -> None:
    row = {"insight_id": str(uuid.uuid4()), "generated_sql": None, "created_at": datetime.now(timezone.utc),
           "latency_ms": int((time.monotonic() - start) * 1000), **columns}
    append_log(spark.createDataFrame([row], LOG.schema), log_path, LOG)


def run_statement(spark: SparkSession, generated: str, log_path: str | None = None, question: str | None = None,
                  model: str | None = None) -> DataFrame:
    """Run generated SQL: the first statement, without fences, and only if it reads.

    With ``log_path`` the question, the statement and the outcome are logged, refused statements too.
    """
    start = time.monotonic()
    text = spark.createDataFrame([(generated,)], "generated string")
    row = text.select(clean_sql(F.col("generated")).alias("sql")).withColumn(
        "safe", is_select_only(F.col("sql"))).first()
    outcome, found, error = "refused", None, UnsafeStatement(row.sql)
    if row.safe:
        try:
            found, outcome = spark.sql(row.sql.removesuffix(";")), "ok"
        except Exception as failure:
            outcome, error = f"failed: {failure}", failure
    if log_path is not None:
        _log(spark, log_path, start, query_type="text2sql", user_query=question, generated_sql=row.sql, response=outcome, model_used=model)
    if found is None:
        raise error
    return found
