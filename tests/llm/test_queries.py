"""Queries that SQL can express, against that SQL; the others are tested against brute force beside their operator."""

import pytest

from tidemark.llm.queries import ORACLES, QUERIES
from verify import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    same, note = compare(spark, connect("/root/testdata/sf0.01"), "/root/testdata/sf0.01", name)
    assert same, note


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
