"""Token ids in Arrow stream files: equal-length sequences and masks as fixed-size lists."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.files import whole_files, written
from tidemark.llm.rolling import RollingHash

LENGTH = 2048
#: Sequences in a record batch; with it, sequence i stands in batch i // BATCH.
BATCH = 64
#: Tokens after which a file ends, at the next end of a document.
FILE_TOKENS = 1 << 20
#: Bytes of text that a task writes, on average.
TASK_BYTES = 16 << 20
_PIECE_BYTES = 1 << 20
#: Words whose ids a worker remembers; about 45 bytes each.
REMEMBERED = 1_000_000

# Blanks outside ASCII, which the tokenizer's pre-tokenization counts as blanks as well.
_WIDE = re.compile("[\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_KIND = np.zeros(256, np.uint8)  # of a byte: 1 blank, 2 letter, 3 mark
_KIND[list(b" \t\n\r\x0b\x0c")] = 1
_KIND[list(range(65, 91)) + list(range(97, 123))] = 2
_KIND[list(b".,;:!?")] = 3


class Encoder:
    """Ids of whole texts. Ids of words are remembered, for no token of the library reaches over their ends.

    Byte-level pre-tokenization lets no token reach from a non-blank into a blank, nor from a letter into a
    mark. So a text is cut before every run of ASCII blanks, and between an ASCII letter and a mark that ends
    a word. A text with blanks outside ASCII, which may join such runs, is encoded in one go. Words are looked
    up by a hash of 64 bits and compared byte by byte; texts of a batch in which two words share a hash are
    encoded in one go as well.
    """

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), end + 1)
        self.type = np.dtype(np.uint16 if size <= 1 << 16 else np.uint32)
        self.end = np.array([end], self.type)
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if len(line_end) == 1 else None
        self.hash = RollingHash(1)
        self._forget()

    def _forget(self) -> None:
        """``known`` hashes in order; the ids of the i-th stand in ``pool`` from ``first[i]``, ``size[i]`` of them,
        its bytes in ``letters`` from ``begin[i]``, ``length[i]`` of them."""
        self.known = np.empty(0, np.uint64)
        self.first, self.size, self.begin, self.length = (np.empty(0, np.uint32) for _ in range(4))
        self.pool, self.used = np.empty(1 << 16, self.type), 0
        self.letters, self.spelt = np.empty(1 << 16, np.uint8), 0

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.type) for x in found]

    def _word_ids(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words with what stands before them; plain ones are encoded in one text and cut at its line ends."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if w.lstrip(" ").isalnum() or w[:1] == "\n" and w[1:].isalnum()]
        if plain and self.line_end is not None:
            ids = self._ids(["\n".join([words[i].removeprefix("\n") for i in plain])])[0]
            line_end = ids.dtype.type(self.line_end)
            ends = np.flatnonzero(ids == line_end)
            for i, s, e in zip(plain, [0, *(ends + 1).tolist()], [*ends.tolist(), ids.size]):
                out[i] = np.concatenate(([line_end], ids[s:e])) if words[i][0] == "\n" else ids[s:e]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._ids([words[i] for i in rest])):
            out[i] = ids
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = self._word_ids(words)
        size = np.array([x.size for x in ids], np.uint32)
        total = int(size.sum())
        while self.used + total > self.pool.size:
            self.pool = np.concatenate((self.pool, np.empty_like(self.pool)))
        self.pool[self.used:self.used + total] = np.concatenate(ids)
        first = (self.used + np.cumsum(size) - size).astype(np.uint32)
        self.used += total
        raw = np.frombuffer(b"".join([w.encode() for w in words]), np.uint8)
        while self.spelt + raw.size > self.letters.size:
            self.letters = np.concatenate((self.letters, np.empty_like(self.letters)))
        self.letters[self.spelt:self.spelt + raw.size] = raw
        length = np.array([len(w.encode()) for w in words], np.uint32)
        begin = (self.spelt + np.cumsum(length) - length).astype(np.uint32)
        self.spelt += raw.size
        at = np.searchsorted(self.known, hashes)
        self.known, self.first, self.size, self.begin, self.length = (np.insert(old, at, new) for old, new in (
            (self.known, hashes), (self.first, first), (self.size, size), (self.begin, begin), (self.length, length)))

    def _same(self, raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, at: np.ndarray) -> bool:
        """Whether the words are, byte by byte, the remembered ones at ``at``."""
        sizes = stops - starts
        if not np.array_equal(sizes, self.length[at]):
            return False
        ends = np.cumsum(sizes)
        along = np.arange(int(ends[-1]) if ends.size else 0)
        here = np.repeat(starts - ends + sizes, sizes) + along
        return np.array_equal(raw[here], self.letters[np.repeat(self.begin[at] - ends + sizes, sizes) + along])

    def _of_pieces(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts without zero bytes and wide blanks."""
        raw = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1  # the zero byte after each text
        kind = _KIND[raw]
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        after = np.concatenate((kind[1:], np.zeros(1, np.uint8)))
        last = np.concatenate((raw[1:] == 0, np.ones(1, bool)))
        new = (kind == 1) & (before != 1) | (kind == 3) & (before == 2) & ((after == 1) | last)
        new[ends] = True
        new[np.concatenate(([0], ends[:-1] + 1))] = True
        starts = np.flatnonzero(new)
        is_word = raw[starts] != 0
        stops = np.concatenate((starts[1:], [raw.size]))[is_word]
        starts = starts[is_word]
        hashes, place, of = np.unique(self.hash.words(raw, starts, stops), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        at[at == self.known.size] = 0
        fresh = self.known[at] != hashes if self.known.size else np.ones(hashes.size, bool)
        if fresh.any():
            data = raw.tobytes()
            self._learn(hashes[fresh], [data[s:e].decode() for s, e in zip(starts[place[fresh]].tolist(), stops[place[fresh]].tolist())])
            at = np.searchsorted(self.known, hashes)
        if not self._same(raw, starts, stops, at[of]):
            return self._ids([t.decode() for t in texts])
        first, size = self.first[at][of].astype(np.int64), self.size[at][of].astype(np.int64)
        done = np.cumsum(size)
        ids = self.pool[np.repeat(first - done + size, size) + np.arange(done[-1] if done.size else 0)]
        # Words before the end of each text, and the ids up to there.
        cuts = np.concatenate(([0], done))[np.searchsorted(starts, ends)]
        return np.split(ids, cuts[:-1])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id, as bytes; null counts as empty."""
        out: list[np.ndarray | None] = [None] * len(texts)
        waiting, size = [], 0
        for i, text in enumerate(texts):
            text = text or ""
            if "\0" in text or not text.isascii() and _WIDE.search(text):
                out[i] = self._ids([text])[0]
            else:
                waiting.append((i, text.encode()))
                size += len(waiting[-1][1])
            if waiting and (size > _PIECE_BYTES or i + 1 == len(texts)):
                for (k, _), ids in zip(waiting, self._of_pieces([t for _, t in waiting])):
                    out[k] = ids
                waiting, size = [], 0
                if self.known.size > REMEMBERED:
                    self._forget()
        return [np.concatenate((ids, self.end)).tobytes() for ids in out]


@cache
def encoder(path: str, end: int) -> Encoder:
    return Encoder(path, end)


def file_schema(kind: np.dtype, length: int) -> pa.Schema:
    """``segments``: from which token of which document on which places of a sequence are filled."""
    segment = pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("first", pa.int32()), ("n", pa.int32())])
    return pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length)),
                      ("segments", pa.list_(segment))])


class _Writer:
    """Packs a stream of documents into sequences; the last one of a file is filled up with masked zeros."""

    def __init__(self, out: pa.NativeFile, kind: np.dtype, length: int):
        self.schema, self.kind, self.length = file_schema(kind, length), kind, length
        self.stream = pa.ipc.new_stream(out, self.schema)
        self.parts: list[bytes] = []
        self.docs: list[tuple[int | None, int, int]] = []  # what waits: id, tokens already put, tokens left
        self.waiting = self.tokens = self.count = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.kind.itemsize
        self.parts.append(ids)
        self.docs.append((doc_id, 0, n))
        self.waiting, self.tokens, self.count = self.waiting + n, self.tokens + n, self.count + 1
        if self.waiting >= BATCH * self.length:
            self._put(self.waiting // (BATCH * self.length) * BATCH)

    def _put(self, sequences: int) -> None:
        size = sequences * self.length
        flat = np.frombuffer(b"".join(self.parts), self.kind)
        used, mask = flat[:size], np.zeros(size, bool)
        mask[:used.size] = True
        segments: list[list[tuple]] = [[] for _ in range(sequences)]
        at, left = 0, []
        for doc_id, offset, n in self.docs:
            while n and at < size:
                take = min(n, self.length - at % self.length)
                segments[at // self.length].append((doc_id, offset, at % self.length, take))
                at, offset, n = at + take, offset + take, n - take
            if n:
                left.append((doc_id, offset, n))
        self.parts, self.docs, self.waiting = [flat[size:].tobytes()], left, max(0, flat.size - size)
        ids = np.zeros(size, self.kind)
        ids[:used.size] = used
        for s in range(0, sequences, BATCH):
            e = min(s + BATCH, sequences)
            part = slice(s * self.length, e * self.length)
            self.stream.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(ids[part]), self.length),
                 pa.FixedSizeListArray.from_arrays(pa.array(mask[part]), self.length),
                 pa.array(segments[s:e], self.schema.field("segments").type)], schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            self._put(math.ceil(self.waiting / self.length))
        self.stream.close()


class Sequences:
    """Random access to the sequences of a file, without copying: give it a memory map or a buffer."""

    def __init__(self, source: pa.Buffer | pa.NativeFile):
        self.batches = pa.ipc.open_stream(source).read_all().to_batches()
        self.sizes = [b.num_rows for b in self.batches]

    def __len__(self) -> int:
        return sum(self.sizes)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence; the ids are a view of the source."""
        batch, at = self.batches[i // BATCH], i % BATCH
        ids, mask = batch.column(0), batch.column(1)
        length = ids.type.list_size
        return (ids.values.slice(at * length, length).to_numpy(), mask.values.slice(at * length, length).to_numpy(zero_copy_only=False))


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                      end: int = 2, length: int = LENGTH, task_bytes: int = TASK_BYTES,
                      file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write the ids of every whole text, each with the id ``end`` after it, in ascending order of id.

    Returns what was written, a row for each file: ``(name, n_docs, n_tokens)``; in order of name, the files
    hold the documents in order of id (a row without id comes first; rows that repeat an id in order of a
    hash of their text). Texts are dealt by ranges of (id, text hash) and sorted in their tasks; ids are
    16-bit numbers if the vocabulary allows it. A document is never cut between files, so a file has
    ``file_tokens`` tokens and at most one document more. Null and empty texts are just the end id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, math.ceil(size / task_bytes)), "id", "tie").sortWithinPartitions("id", "tie")
    out = pa.schema([("name", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using, task, number = encoder(tokenizer, end), TaskContext.get().partitionId(), 0
        found = ((i, ids) for batch in batches for i, ids in zip(batch.column(0).to_pylist(), using.encode(batch.column(1).to_pylist())))
        document = next(found, None)
        while document is not None:
            name = f"tokens-{task:07d}-{number:05d}.arrow"
            with written(folder, name) as sink:
                file = _Writer(sink, using.type, length)
                while document is not None and file.tokens < file_tokens:
                    file.add(*document)
                    document = next(found, None)
                file.close()
            number += 1
            yield pa.RecordBatch.from_pydict({"name": [name], "n_docs": [file.count], "n_tokens": [file.tokens]}, schema=out)

    return stored(dealt.select("id", "text").mapInArrow(write, "name string, n_docs long, n_tokens long"), "token-files")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(name, nth, id, first, ids)``: every document of the files, its place in its file and its ids as
    little-endian unsigned 32-bit numbers."""
    out = pa.schema([("name", pa.string()), ("nth", pa.int64()), ("id", pa.int64()), ("first", pa.int64()), ("ids", pa.binary())])

    def documents(content: pa.Buffer) -> Iterator[tuple[int | None, bytes]]:
        open_id, parts = None, []
        for batch in pa.ipc.open_stream(content):
            length = batch.column(0).type.list_size
            ids, segments = batch.column(0).values.to_numpy(), batch.column(2)
            start = np.repeat(np.arange(batch.num_rows) * length, np.diff(segments.offsets.to_numpy()))
            flat = segments.values
            start += flat.field(2).to_numpy()
            for doc_id, offset, s, n in zip(*(c.tolist() for c in (flat.field(0), flat.field(1), start, flat.field(3)))):
                if parts and not offset:
                    yield open_id, b"".join(parts)
                    parts = []
                open_id = doc_id
                parts.append(ids[s:s + n].astype("<u4").tobytes())
        if parts:
            yield open_id, b"".join(parts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                at, all_of = 0, enumerate(documents(content.as_buffer()))
                while some := list(islice(all_of, 512)):
                    sizes = [len(ids) // 4 for _, (_, ids) in some]
                    first = [at + n for n in accumulate([0, *sizes])]
                    at = first.pop()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), pa.array([nth for nth, _ in some], pa.int64()),
                         pa.array([i for _, (i, _) in some], pa.int64()), pa.array(first, pa.int64()),
                         pa.array([ids for _, (_, ids) in some], pa.binary())], schema=out)

    return whole_files(spark, folder, "*.arrow").mapInArrow(read, "name string, nth long, id long, first long, ids binary")
