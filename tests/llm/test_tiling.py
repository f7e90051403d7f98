import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import numpy as np

from tidemark.llm import tiling
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES


def split(text):
    return (text or "").encode().lower().split()


def greedy(doc, item, seed):
    """Textbook greedy tiling: search all pairs for the longest free match, mark it, start again."""
    used_d, used_i, found = set(), set(), []
    while True:
        best = None
        for a in range(len(item)):
            for b in range(len(doc)):
                n = 0
                while (a + n < len(item) and b + n < len(doc) and item[a + n] == doc[b + n]
                       and a + n not in used_i and b + n not in used_d):
                    n += 1
                if n >= seed and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return found
        found.append(best)
        used_i.update(range(best[0], best[0] + best[2]))
        used_d.update(range(best[1], best[1] + best[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=24), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=14),
       st.integers(1, 4))
def test_tiles_equal_textbook(doc, item, seed):
    pairs = [(b, a) for a in range(len(item) - seed + 1) for b in range(len(doc) - seed + 1) if item[a:a + seed] == doc[b:b + seed]]
    if pairs:
        at_doc, at_item = (np.array(x) for x in zip(*pairs))
        assert tiling.tiles(doc, item, at_doc, at_item, seed) == greedy(doc, item, seed)


def by_hand(docs, items, seed=5, share=0.5):
    out = set()
    for d, text in docs:
        words = split(text)
        windows = {tuple(words[k:k + seed]) for k in range(len(words) - seed + 1)}
        for i, item_text in items:
            item = split(item_text)
            if not any(tuple(item[k:k + seed]) in windows for k in range(len(item) - seed + 1)):
                continue
            laid = greedy(words, item, seed)
            covered = sum(n for *_, n in laid)
            if covered >= share * len(item):
                out.add((d, i, len(item), covered, covered / len(item), len(laid), max(n for *_, n in laid)))
    return out


def test_query_equals_brute_force(spark, small):
    docs, items = ([tuple(r) for r in table(spark, small, t).select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    got = QUERIES["op10_benchmark_decontamination"](spark, small)
    assert got.columns[:2] == ["doc_id", "item_id"]
    want = by_hand(docs, items)
    assert {tuple(r) for r in got.collect()} == want and want


@pytest.fixture
def case(spark):
    rng = random.Random(3)
    item = [f"w{k}" for k in range(30)]
    pieces = [item[20:], item[:10], item[10:20]]
    rows = [(1, " ".join(item)), (2, "X ".join(" ".join(p) + " " for p in pieces)), (3, " ".join(rng.sample(item, 30))),
            (4, None), (5, ""), (6, " ".join(item[:14])), (7, " ".join(item[:15]).upper()), (None, " ".join(item)),
            (1, " ".join(item)), (8, "filler " * 30_000 + " ".join(item))]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, item_id string, id int")
    items = spark.createDataFrame([(10, " ".join(item), 0), (11, None, 0), (12, "w0 w1", 0), (13, "", 0), (10, " ".join(item), 0)],
                                  "item_id long, text string, doc_id int")
    return docs, items


@pytest.mark.parametrize("block_words", [1 << 20, 10])
def test_edge_rows(case, block_words):
    docs, items = case
    got = sorted((r.id or 0, r.item_id, r.covered_words, r.n_tiles) for r in tiling.contaminated(docs, items, block_words=block_words).collect())
    once = [(0, 10, 30, 1), (1, 10, 30, 1), (1, 10, 30, 1), (2, 10, 30, 3), (7, 10, 15, 1), (8, 10, 30, 1)]
    assert got == sorted(once * 2)
    kept = tiling.without_contaminated(docs, items, block_words=block_words)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6]


def test_empty_tables(case):
    docs, items = case
    assert tiling.contaminated(docs, items.limit(0)).count() == 0
    assert tiling.contaminated(docs.limit(0), items).count() == 0
    assert tiling.without_contaminated(docs, items.limit(0)).count() == docs.count()
