import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import public_tokenizers
from tidemark.llm import alignment
from tidemark.llm.common import stored, table
from tidemark.llm.automaton import byte_alphabet
from tidemark.llm.queries import QUERIES

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Groups and links of a text, token by token."""
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    alphabet = byte_alphabet()

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        whole = (" " + text).encode() if text else b""
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        spelt = [[bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids[0]], [b_bytes(i) for i in ids[1]]]
        if any(b"".join(x) != whole for x in spelt) or not whole:
            return [], []
        ends = [np.cumsum([len(x) for x in side]).tolist() for side in spelt]
        groups, links, i, j = [([], [])], [], 0, 0
        while i < len(ids[0]) and j < len(ids[1]):
            links.append((ids[0][i], ids[1][j]))
            e, f = ends[0][i], ends[1][j]
            if e <= f:
                groups[-1][0].append(ids[0][i])
                i += 1
            if f <= e:
                groups[-1][1].append(ids[1][j])
                j += 1
            if e == f:
                groups.append(([], []))
        return groups[:-1], links
    return run


def digest(groups):
    told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(told.encode()).hexdigest() if groups else ""


def expected(plain, rows):
    found = [(i, *plain(text)) for i, text in rows]
    counts = Counter(link for _, _, links in found for link in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = [(i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
            sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest(g)) for i, g, links in found]
    return sorted(out, key=repr), counts, {(a, b): {i for i, _, links in found if (a, b) in links} for a, b in counts}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from([" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", ";\r\n", "\r", "\x0b", "\x0c", "\xa0", " ", "　", "\x85", "\x1c", "\0", "▁", "​"]),
    st.sampled_from(["word", "word,", "Été.", "it's", "12", "a1", "日本", "<|endoftext|>", "<s>", "<unk>", "<0x41>", "...", "é", "🙂", "aaaa", "՘"]),
    st.text(max_size=4)), max_size=12).map("".join))
def test_texts_align_as_token_by_token(plain, text):
    using = alignment.aligner(*PATHS)
    counts, digests, of, pairs = using.align([text, "", text])
    groups, links = plain(text)
    want = [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links)]
    assert counts.T.tolist() == [want, [0] * 4, want] and digests == [digest(groups), "", digest(groups)]
    assert sorted(pairs[of == 0].tolist()) == sorted(pairs[of == 2].tolist()) == sorted(a * using.n_b + b for a, b in links)


def test_query_equals_token_by_token(spark, small, plain):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    got = sorted((tuple(r[c] for c in columns) for r in QUERIES["op13_cross_tokenizer_alignment"](spark, small).collect()), key=repr)
    assert got == expected(plain, rows)[0]


@pytest.mark.parametrize("links, at_once", [(1 << 20, 1 << 20), (40, 7)])
def test_segments_and_parts_change_nothing(spark, plain, links, at_once, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 50)
    rows = [(1, None), (2, ""), (None, "no id here"), (3, "a a a a " * 9), (3, "a a a a " * 9), (4, "x▁y"), (5, "long words, " * 3000), (6, " \n "),
            (7, "<|endoftext|> <s>"), *[(i, f"text number {i % 5} of many; many") for i in range(8, 90)]]
    docs = spark.createDataFrame([(*r, 7, "x", "y") for r in rows], "doc_id long, text string, segment long, id string, pair string")
    docs = docs.repartition(3)
    found, counted = alignment.aligned(docs, *PATHS, keep=stored, segment_links=links, pairs_at_once=at_once)
    want, counts, holders = expected(plain, rows)
    assert sorted(map(tuple, found.collect()), key=repr) == want
    got = {(r.a, r.b): (r.n_links, r.n_docs, r.best) for r in counted.collect()}
    n_docs = Counter(link for _, text in rows for link in set(plain(text)[1]))
    assert {k: v[:2] for k, v in got.items()} == {k: (n, n_docs[k]) for k, n in counts.items()}
    assert found.count() == len(rows)


def test_dense_bitmaps():
    keys = np.repeat([3, 5, 9, 11], [10, 20_000, 65_536, 3])
    docs = np.concatenate([np.arange(10) * 7, np.arange(20_000) * 3, np.arange(65_536), [1, 2, 65_535]])
    for pairs, sizes, raw in alignment.bitmaps(keys, docs):
        assert pairs.tolist() == [3, 5, 9, 11] and len(raw) == 13 * 2 + 2 * 8192
        assert np.array_equal(alignment.documents_of(sizes, raw), docs)


def test_empty_table(spark):
    found, counted = alignment.aligned(spark.createDataFrame([], "doc_id long, text string"), *PATHS, keep=stored)
    assert found.count() == 0 and counted.count() == 0
