import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.common import table
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES


def by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def expected(rows):
    fps = {d: by_hand(t) for d, t in rows}
    ids = sorted(fps)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 3]
    return {d: (f"{fps[d]:016x}", r) for d, r in roots(pairs, ids).items()}


def test_query_equals_brute_force(spark, small):
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_near_dedup"](spark, small).collect()}
    assert got == expected(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b c d e"), (7, "A B  C\nd e"),
            (8, "w " * 50_000), (9, "café  x")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, text string, fp string, n string, v int")
    got = {r.id: (f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in simhash.near_duplicates(df).collect()}
    assert got == expected(rows)
    assert got[1][1] == got[2][1] == got[3][1] == 1 and got[5][1] == 4 and got[7][1] == 6


def test_null_ids_repeats_and_empty_table(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (2, "a b c")], schema)
    assert sorted((r.id or 0, r.component or 0) for r in simhash.near_duplicates(df).collect()) == [(0, 0), (2, 2), (3, 2), (3, 2)]
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("entry_size", [4, 4096])
def test_links_lose_no_component(spark, entry_size):
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 1 << 62, 6):
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 5), replace=False)
            fps.add(int(centre) ^ sum(1 << int(b) for b in flips))
    fps = [f - (1 << 64) if f >> 63 else f for f in fps]
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = [tuple(r) for r in simhash.links(df, entry_size).collect()]
    assert {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in near}
    assert roots(found, fps) == roots(near, fps)


def test_components_of_paths_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "x long, y long")).collect()}
    assert got == roots(pairs, {n for p in pairs for n in p})
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


@pytest.mark.parametrize("broadcast_ids", [0, 1 << 20])
def test_one_row_of_each_component_stays(spark, plan, broadcast_ids):
    rows = [(5, "a b c d", "x"), (2, "a b c d", "y"), (None, "a b c d", "z"), (9, "quite other words here", "x"), (2, "a b c d", "y"), (7, None, "x"),
            (9, "a b c d", "w"), (None, "no copy of it has an id", "u"), (None, "no copy of it has an id", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string")
    kept = simhash.without_near_duplicates(df, broadcast_ids=broadcast_ids)
    assert kept.dtypes == df.dtypes
    assert sorted((r.doc_id or 0, r.component) for r in kept.collect()) == [(0, "u"), (2, "y"), (7, "x"), (9, "x")]
