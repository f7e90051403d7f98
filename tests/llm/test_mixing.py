import random
from collections import defaultdict
from fractions import Fraction
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.common import stored, table
from tidemark.llm.queries import QUERIES


def test_targets_by_hand():
    got = mixing.targets({"b": 100, "a": 10, None: 50, "c": 1000})
    # 1740 words; a (weight 5) stops at 20, b (2) at 200, null (5) at 100; c takes the rest.
    assert got == {"a": 20, "b": 200, None: 100, "c": 1420}
    assert mixing.targets({}) == {} and mixing.targets({"x": 0}) == {"x": 0}


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(max_size=2)), st.integers(0, 1000), max_size=7))
def test_targets_share_everything(sizes):
    got = mixing.targets(sizes)
    assert set(got) == set(sizes) and sum(got.values()) == Fraction(3, 2) * sum(sizes.values())
    assert all(got[s] <= 2 * sizes[s] for s in sizes)


def cheapest(words, members, quotas, most):
    """Best (flow, -cost) over all ways to give whole words."""
    best = (0, 0)
    ways = [[c for c in product(*(range(quotas[s] + 1) for s in m)) if sum(c) <= most * w] for w, m in zip(words, members)]
    for way in product(*ways):
        given = defaultdict(int)
        for m, c in zip(members, way):
            for s, n in zip(m, c):
                given[s] += n
        if all(given[s] <= q for s, q in enumerate(quotas)):
            cost = sum(sum(min(w, max(0, sum(c) - k * w)) * (k + 1) for k in range(most)) for w, c in zip(words, way))
            best = max(best, (sum(map(sum, way)), -cost))
    return best


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_the_cheapest_maximum(seed):
    rng = random.Random(seed)
    words = [rng.randint(0, 2) for _ in range(3)]
    members = [sorted(rng.sample(range(3), rng.randint(1, 2))) for _ in range(3)]
    quotas = [rng.randint(0, 3) for _ in range(3)]
    flow = mixing.route(words, members, quotas, 2)
    assert all(set(f) <= set(m) for f, m in zip(flow, members)) and all(sum(f.values()) <= 2 * w for f, w in zip(flow, words))
    assert all(sum(f.get(s, 0) for f in flow) <= q for s, q in enumerate(quotas))
    cost = sum(sum(min(w, max(0, sum(f.values()) - k * w)) * (k + 1) for k in range(2)) for w, f in zip(words, flow))
    assert (sum(sum(f.values()) for f in flow), -cost) == cheapest(words, members, quotas, 2)


def test_query_meets_targets(spark, small):
    docs = table(spark, small, "documents").select("doc_id", "text", "source").collect()
    got = {r.doc_id: r for r in QUERIES["op2_source_mix"](spark, small).collect()}
    sizes = {r.doc_id: len((r.text or "").encode().split()) for r in docs}
    by_source = defaultdict(int)
    for r in docs:
        by_source[r.source] += sizes[r.doc_id]
    wanted, took, longest = mixing.targets(by_source), defaultdict(int), defaultdict(int)
    assert set(got) == set(sizes)
    for r in docs:
        g = got[r.doc_id]
        assert (g.size, g.source_size, g.target) == (sizes[r.doc_id], by_source[r.source], float(wanted[r.source]))
        assert g.taken in (0, g.size, 2 * g.size)
        took[r.source] += g.taken
        longest[r.source] = max(longest[r.source], g.size)
    assert all(abs(took[s] - wanted[s]) <= longest[s] / 2 + 1 for s in took)
    again = {r.doc_id: r.taken for r in QUERIES["op2_source_mix"](spark, small).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_overlapping_sources(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(1, 9)), rng.choice([["a"], ["b"], ["a", "b"], ["b", "a", "a"], [], None, [None, "b"]])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    mixed = mixing.mix(docs, weights=(1, 1, 1), share=1.0, keep=stored)
    out = mixing.taken(docs, mixed).withColumn("size", mixing.n_words(F.col("text")))
    assert out.count() == len(rows) and set(mixed.sizes) == {"a", "b", None}
    total = out.agg(F.sum(F.col("size") * F.col("times"))).first()[0]
    assert abs(total - sum(mixed.targets.values())) < 60
    assert out.agg(F.max("times")).first()[0] <= 2


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (3, "x " * 50_000, None), (3, "x " * 50_000, None), (4, "z", "b"), (5, " \t", "c")]
    docs = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, source string, times int, _pattern string")
    out = mixing.taken(docs, mixing.mix(docs))
    assert out.columns == ["doc_id", "text", "source", "_pattern", "times"] and out.count() == len(rows)
    assert all(r["times"] in (0, 1, 2) for r in out.collect())
    empty = docs.limit(0)
    assert mixing.taken(empty, mixing.mix(empty)).count() == 0
