"""Raw text to types: blanks, wrong text, letter case, missing and foreign columns."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.casting import cast_to_schema, normalise_event_time, project_to
from tidemark.schemas import ENTITIES, parse_ddl


def typed(spark, ddl, **values):
    text = spark.createDataFrame([tuple(values.values())], ", ".join(f"`{k}` string" for k in values))
    return cast_to_schema(text, parse_ddl(ddl)).first()


def test_blank_none_and_wrong_text_become_null(spark):
    for bad in ("", " ", "None", "abc"):
        row = typed(spark, "i int, l bigint, f float, d decimal(10,2), b boolean, t timestamp",
                    i=bad, l=bad, f=bad, d=bad, b=bad, t=bad)
        assert list(row) == [None] * 6


def test_blank_text_is_null_but_other_text_is_kept_as_written(spark):
    assert typed(spark, "s string", s="None").s is None
    assert typed(spark, "s string", s="").s is None
    assert typed(spark, "s string", s=" Cancelled ").s == " Cancelled "


def test_values(spark):
    row = typed(spark, "i int, j int, k int, d decimal(10,2), b boolean, c boolean, t timestamp, u timestamp",
                i="5", j="5.0", k="-7.9", d="12.345", b="True", c="False",
                t="2024-11-01T10:20:30.123456+00:00", u="2024-11-01T10:20:30+02:00")
    assert (row.i, row.j, row.k) == (5, 5, -7)
    assert row.d == Decimal("12.35")
    assert (row.b, row.c) == (True, False)
    assert row.t == datetime(2024, 11, 1, 10, 20, 30, 123456)
    assert row.u == datetime(2024, 11, 1, 8, 20, 30)


def test_numbers_outside_their_type_become_null(spark):
    row = typed(spark, "i int, d decimal(4,2)", i="99999999999", d="12345.67")
    assert list(row) == [None, None]


def test_letter_case_missing_and_extra_columns(spark):
    row = typed(spark, "order_id string, quantity int, status string", Order_ID="A", QUANTITY="3", extra="x")
    assert row.asDict() == {"order_id": "A", "quantity": 3, "status": None}


def test_already_typed_columns_are_kept(spark):
    df = spark.createDataFrame([(1.5, datetime(2024, 1, 1))], "f double, t timestamp")
    row = cast_to_schema(df, parse_ddl("f float, t timestamp, n int")).first()
    assert (row.f, row.t, row.n) == (1.5, datetime(2024, 1, 1), None)


def test_event_time_is_the_first_candidate_with_a_value(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), None), (2, None, datetime(2024, 1, 2)), (3, None, None)],
        "id int, event_ts timestamp, created_at timestamp")
    out = {r.id: r.event_ts for r in normalise_event_time(df).collect()}
    assert out == {1: datetime(2024, 1, 1), 2: datetime(2024, 1, 2), 3: None}


def test_projection_goes_by_name(spark):
    df = spark.createDataFrame([("n", "c1", 9)], "name string, id string, other int")
    out = project_to(df, parse_ddl("id string, name string, loaded int"), {"loaded": F.lit(4)})
    assert out.columns == ["id", "name", "loaded"]
    assert list(out.first()) == ["c1", "n", 4]


def test_every_schema_parses(spark):
    for entity in ENTITIES.values():
        assert entity.key in entity.schema.names
        assert entity.time_column in entity.schema.names
        assert "event_ts" in entity.silver_schema.names
