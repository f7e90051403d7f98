"""Questions to reports, and the guard on generated SQL; all as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    report: str | None
    response: str


# The keyword patterns and their order; the first match wins.
RULES: tuple[Rule, ...] = (
    Rule("revenue", r"\b(total|sum).*(revenue|sales|amount)\b", "revenue_by_day",
         "Revenue per day over the last 30 days."),
    Rule("products", r"\b(top|best|highest).*(product|item|sku)\b", "top_products",
         "Products with the highest revenue."),
    Rule("anomalies", r"\b(anomal|spike|outlier|unusual)\b", "latest_anomalies",
         "Latest hours with a sensor anomaly."),
    Rule("trading", r"\b(trade|volume|asset|crypto|stock)\b", "trading_volume",
         "Trading volume per asset over the last 7 days."),
    Rule("social", r"\b(social|engagement|like|share|platform)\b", "platform_engagement",
         "Likes, shares and comments per platform."),
    Rule("sensors", r"\b(sensor|temperature|humidity|pressure|iot)\b", "sensor_overview",
         "Sensor averages per location over the last hour."),
    Rule("health", r"\b(pipeline|status|health|lag|kafka)\b", None,
         "Job and stream health: see the run log and the stream progress table."),
)

NO_MATCH = Rule("none", "", None,
                "No known question matched. Ask about revenue, top products, sensor anomalies, "
                "trading volume, social engagement or job health.")

# The words that make a statement more than a read.
FORBIDDEN_WORDS = ("DROP", "TRUNCATE", "DELETE", "INSERT", "UPDATE", "ALTER", "CREATE", "SYSTEM")

# Letters, digits and case in any script; only a line feed ends a line.
UNICODE_FLAGS = "(?iudU)"

_SPACE = r"[\s\x1c-\x1f]"


def strip(column: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(column, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", "")


def route_questions(df: DataFrame, text_col: str) -> DataFrame:
    """Add the first matching rule, its answer text and the report that answers it."""
    chain = None
    for number, rule in enumerate(RULES):
        matches = F.col(text_col).rlike(UNICODE_FLAGS + rule.pattern)
        chain = F.when(matches, number) if chain is None else chain.when(matches, number)
    routed = df.withColumn("_rule", chain.otherwise(len(RULES)))
    every_rule = (*RULES, NO_MATCH)

    def pick(values: list[str | None]) -> Column:
        return F.get(F.array(*[F.lit(v).cast("string") for v in values]), F.col("_rule"))

    return routed.withColumns({
        "rule": pick([r.name for r in every_rule]),
        "response": pick([r.response for r in every_rule]),
        "report": pick([r.report for r in every_rule]),
    }).drop("_rule")


def clean_sql(column: Column) -> Column:
    """Drop code fences and keep the first statement, ended by one semicolon."""
    text = strip(column)
    text = F.regexp_replace(text, rf"(?iU)\A```(?:sql)?{_SPACE}*", "")
    text = F.regexp_replace(text, rf"(?U){_SPACE}*```\n?\z", "")
    return F.concat(strip(F.split_part(text, F.lit(";"), F.lit(1))), F.lit(";"))


def clean_sql_column(df: DataFrame, sql_col: str, output: str = "clean_sql") -> DataFrame:
    return df.withColumn(output, clean_sql(F.col(sql_col)))


def is_select_only(column: Column, whole_words: bool = True) -> Column:
    """True for a SELECT without a forbidden word.

    ``whole_words=False`` also rejects the words inside longer ones (``created_at``).
    """
    text = strip(F.upper(column))
    words = "|".join(FORBIDDEN_WORDS)
    pattern = rf"(?U)\b({words})\b" if whole_words else words
    return text.startswith("SELECT") & ~text.rlike(pattern)


def select_only_flag(df: DataFrame, sql_col: str, output: str = "is_safe", whole_words: bool = True) -> DataFrame:
    return df.withColumn(output, is_select_only(F.col(sql_col), whole_words))
