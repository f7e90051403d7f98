import glob
import io
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import token_files
from tidemark.llm.common import table
from tidemark.llm.files import files_folder
from tidemark.llm.queries import QUERIES, tokenizer_file

from .test_substrings import thue_morse


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_file())
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def ids(raw, kind=np.uint16):
    return np.frombuffer(raw, kind).tolist()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from([" ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "\x0b", "\x0c", "\xa0", " ", "　", "\x85", "\x1c", "\0", "﻿"]),
    st.sampled_from(["word", "word,", "Été.", "it's", "'s", "12", "a1", "don't!", "x.", "日本", "²", "<|endoftext|>", "...", "é", "a,b"]),
    st.text(max_size=4)), max_size=12).map("".join))
def test_remembered_words_change_nothing(plain, text):
    used = token_files.encoder(tokenizer_file(), 2)
    assert ids(used.encode([text])[0]) == plain(text)
    assert ids(used.encode([text, None, ""])[0]) == plain(text)


@pytest.mark.parametrize("steps", [10, 11])
def test_words_that_polynomials_confuse(plain, steps):
    used = token_files.Encoder(tokenizer_file(), 2)
    for text in thue_morse(steps):
        assert ids(used.encode([text])[0]) == plain(text)


def test_words_with_one_hash_are_told_apart(plain):
    used = token_files.Encoder(tokenizer_file(), 2)
    used.hash.words = lambda raw, starts, ends: (ends - starts).astype(np.uint64)
    for text in ("one two three four", "six ten seven, nine"):
        assert [ids(x) for x in used.encode([text, "a b"])] == [plain(text), plain("a b")]


def test_forgetting_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 3)
    used = token_files.Encoder(tokenizer_file(), 2)
    for text in ("one two, three.", "two, one. four five", "one two, six seven eight", "three. one two,"):
        assert ids(used.encode([text])[0]) == plain(text)


@pytest.mark.parametrize("length, sizes", [(4, [1, 3, 4, 4, 9, 1]), (4, [4]), (3, [700, 1, 2, 600]), (8, [1])])
def test_files_round_trip(length, sizes):
    kind, sink, stream = np.dtype(np.uint16), io.BytesIO(), []
    writer = token_files._Writer(sink, kind, length)
    for i, n in enumerate(sizes):
        one = np.arange(len(stream), len(stream) + n, dtype=kind)
        writer.add(i, one.tobytes())
        stream += one.tolist()
    writer.close()
    data = pa.py_buffer(sink.getvalue())
    found = token_files.Sequences(data)
    assert len(found) == -(-len(stream) // length)
    parts = [found[i] for i in range(len(found))]
    assert np.concatenate([i[m] for i, m in parts]).tolist() == stream
    assert all(m.all() for _, m in parts[:-1])
    address, values = data.address, parts[0][0]
    assert address <= values.ctypes.data < address + data.size  # a view, not a copy


def test_query_equals_library(spark, small, plain):
    docs = sorted((r.doc_id, r.text) for r in table(spark, small, "documents").select("doc_id", "text").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op8_token_files"](spark, small).collect()}
    want, at = {}, 0
    for i, text in docs:
        own = plain(text)
        want[i] = (at, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        at += len(own)
    assert got == want


def test_many_files_and_edge_rows(spark, plain):
    rows = [(5, "five " * 40), (None, "no id"), (3, None), (4, ""), (3, "x y"), (3, "x y"), (9, "long " * 30_000), (-1, " \n "), (7, "seven")]
    docs = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "doc_id long, text string, id string, name string, tie int")
    folder = files_folder(spark, "t")
    files = token_files.write_token_files(docs, folder, tokenizer_file(), length=16, task_bytes=40, file_tokens=32)
    found = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: (r.name, r.nth))
    assert [r.id for r in found] == [None, -1, 3, 3, 3, 4, 5, 7, 9]
    texts = {r.id: np.frombuffer(r.ids, "<u4").tolist() for r in found}
    assert texts[9] == plain("long " * 30_000) and texts[4] == [2] and texts[-1] == plain(" \n ") and texts[None] == plain("no id")
    assert sorted(len(r.ids) // 4 for r in found if r.id == 3) == sorted(len(plain(t)) for t in (None, "x y", "x y"))
    assert files.count() == len(glob.glob(f"{folder.removeprefix('file://')}/*.arrow")) > 2
    assert sum(r.n_tokens for r in files.collect()) == sum(len(r.ids) // 4 for r in found)
    with pa.memory_map(sorted(glob.glob(f"{folder.removeprefix('file://')}/*.arrow"))[-1]) as source:
        assert token_files.Sequences(source)[0][0].size == 16


def test_empty_table(spark):
    folder = files_folder(spark, "t")
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.write_token_files(docs, folder, tokenizer_file()).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0
