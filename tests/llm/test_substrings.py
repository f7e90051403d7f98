import hashlib

import pytest

from tidemark.llm import substrings
from tidemark.llm.rolling import window_hashes
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES


def by_hand(rows, size=13):
    """``{id: (words, removed words, kept words)}`` for rows with different ids."""
    split = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(split):
        for k in range(len(split[i]) - size + 1):
            first.setdefault(tuple(split[i][k:k + size]), i)
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out[i] = (len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode())
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 1 << 16])
def test_equals_brute_force(spark, small, block_bytes):
    docs = table(spark, small, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(docs, block_bytes=block_bytes).collect()}
    want = by_hand(rows)
    assert got == want and sum(w[1] > 0 for w in want.values()) > 10


def test_query(spark, small):
    rows = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    want = {i: (n, r, hashlib.sha256(k.encode()).hexdigest()) for i, (n, r, k) in by_hand(rows).items()}
    got = QUERIES["op1_substring_dedup"](spark, small)
    assert got.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()} == want


def test_edge_rows(spark):
    rows = [(1, "a b c d"), (2, "x a\tb \n c y"), (3, None), (4, ""), (5, " \t "), (6, "b c"), (7, "q q q q q q"), (8, "a b c a b c"),
            (9, "é ü " * 70_000), (10, "é ü é ü")]
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, id int, block string, n_words string")
    for size in (1 << 24, 40):
        got = {r.id: r for r in substrings.remove_repeats(df, words=3, block_bytes=size).collect()}
        assert {i: (r.n_words, r.n_removed, r.kept) for i, r in got.items()} == by_hand(rows, 3)
    assert got[2].kept == "x y" and [tuple(s) for s in got[2].removed] == [(1, 4)]
    assert got[7].kept == "q q q q q q" and got[8].n_removed == 6


def test_null_ids_repeated_ids_and_empty_table(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (6, "z a b c")], schema)
    got = sorted((r.id or 0, r.n_removed, r.kept) for r in substrings.remove_repeats(df, words=3).collect())
    assert got == [(0, 0, "a b c d"), (5, 0, "a b c d"), (5, 0, "a b c d"), (6, 3, "z")]
    assert substrings.remove_repeats(spark.createDataFrame([], schema)).count() == 0


def test_text_is_moved_once(spark, small, plan):
    df = substrings.remove_repeats(table(spark, small, "documents"), block_bytes=1 << 18)
    df.collect()
    assert "ReusedExchange" in plan(df)


def thue_morse(steps):
    """Two strings that every polynomial hash modulo 2**64 with an odd base confuses."""
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("steps", [10, 11])
def test_words_that_polynomials_confuse(spark, steps):
    same = " ".join("w" * i for i in range(1, 13))
    a, b = thue_morse(steps)
    df = spark.createDataFrame([(1, f"{same} {a}"), (2, f"{same} {b}"), (3, f"{same} {a}")], "doc_id long, text string")
    assert {r.id: r.n_removed for r in substrings.remove_repeats(df).collect()} == {1: 0, 2: 0, 3: 13}
    x, y = (" ".join(w) for w in thue_morse(5))  # windows of 32 words
    df = spark.createDataFrame([(1, x), (2, y), (3, x)], "doc_id long, text string")
    assert {r.id: r.n_removed for r in substrings.remove_repeats(df, words=32).collect()} == {1: 0, 2: 0, 3: 32}
    with pytest.raises(ValueError):
        window_hashes([[b"a"] * 100], 65)
