"""Rules and SQL guard against Python's own regular expressions."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import text

WORDS = ["total", "Sum", "revenue", "sales", "best", "product", "anomal", "spike", "trade", "stock", "like",
         "platform", "iot", "status", "lag", "totals", "unlike", "élike", "stock_x", "\n", " ", ".", "-", "é", "3"]

SQL_PARTS = ["```", "```sql", "```SQL", "select 1", "SELECT created_at", "DROP TABLE x", "drops", "updated_at",
             "delete from t", ";", "\n", " ", "\t", " ", "é", "'", "```sqlselect", "INSERT"]


def python_route(question):
    for rule in text.RULES:
        if re.search(rule.pattern, question, re.I):
            return rule.name
    return text.NO_MATCH.name


def python_clean(raw):
    raw = raw.strip()
    raw = re.sub(r"^```(?:sql)?\s*", "", raw, flags=re.I)
    raw = re.sub(r"\s*```$", "", raw)
    return raw.split(";")[0].strip() + ";"


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in build(df).orderBy("i").collect()]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=7).map("".join), min_size=60, max_size=80))
def test_rules_match_like_python(spark, questions):
    got = column(spark, questions, lambda df: text.route_questions(df, "v").withColumnRenamed("rule", "out"))
    assert got == [python_route(q) for q in questions]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SQL_PARTS), max_size=8).map("".join), min_size=60, max_size=80))
def test_cleaning_like_python(spark, answers):
    got = column(spark, answers, lambda df: text.clean_sql_column(df, "v", "out"))
    assert got == [python_clean(a) for a in answers]


def test_first_rule_wins_and_names_its_report(spark):
    df = spark.createDataFrame([("total sales of the top product",), ("hello",), ("pipeline HEALTH?",), (None,)], "q string")
    rows = text.route_questions(df, "q").collect()
    assert [(r.rule, r.report) for r in rows] == [
        ("revenue", "revenue_by_day"), ("none", None), ("health", None), ("none", None)]


def test_every_rule_names_a_known_report():
    from tidemark.plans.reports import REPORTS
    assert {r.report for r in text.RULES if r.report} <= set(REPORTS)


def test_only_plain_selects_pass(spark):
    cases = {
        "SELECT created_at, updated_at FROM t;": (True, False),
        " select a from t;": (True, True),
        "SELECT 1; DROP TABLE t": (False, False),
        "insert into t values (1)": (False, False),
        "WITH x AS (SELECT 1) SELECT * FROM x": (False, False),
        "SELECT * FROM system.tables": (False, False),
        "SELECT dropped FROM t": (True, False),
    }
    for number, whole in ((0, True), (1, False)):
        got = column(spark, list(cases), lambda df, whole=whole: text.select_only_flag(df, "v", "out", whole))
        assert got == [flags[number] for flags in cases.values()]
