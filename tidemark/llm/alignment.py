"""Tokens of two tokenizers aligned by their bytes; how often ids are linked, from inverted bitmaps of id pairs."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.automaton import chunk, chunks, encoder
from tidemark.llm.common import texts

#: Links that a worker gathers before it writes their bitmaps.
SEGMENT_LINKS = 4 << 20
#: Documents of a segment: their numbers fit 16 bits.
SEGMENT_DOCS = 1 << 16
#: Documents above which a bitmap is kept as bits, not as a list of numbers: the same size there.
DENSE = SEGMENT_DOCS // 16
#: Bytes of bitmaps in a row of the index.
ROW_BYTES = 1 << 20
#: Pairs (12 bytes each) whose scores are sent to the workers at a time.
PAIRS_AT_ONCE = 4 << 20
#: Chunks of text whose alignment a worker remembers.
REMEMBERED = 500_000
#: After a batch with so many characters of new chunks (long ones), a worker starts again to remember.
_MOST_BYTES = 4 << 20


class Aligner:
    """Ids, groups and links of texts; those of chunks that no token of either vocabulary reaches over are remembered."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a, self.b = encoder(a_path, specials=False), sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_labels = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.a_size = self.a.label_size
        self.b_size = np.array([len(x) for x in self.b_labels], np.int64)
        self.n_b = len(pieces)
        # Texts may be cut before a blank that follows a non-blank, unless a piece reaches over such a place.
        self.cuts = not any(re.search(r"[^\u2581\s][\u2581 \t\n\x0b\x0c]", p) for p in pieces)
        self.head = len(self.b.encode("a"))
        names = [str(i).encode() for i in range(max(len(self.a.labels), self.n_b))]
        self.names = [x + end for end in (b",", b"|", b";") for x in names]
        self.n_names = len(names)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str | bytes, int] = {}
        self.text: list[bytes | None] = []
        self.counts = np.zeros((4, 0), np.int64)  # tokens of A and of B, groups, links
        self.first, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _b_ids(self, parts: list[str]) -> list[list[int]]:
        # Behind a letter, a chunk's pieces are those it has in the text.
        return [ids[self.head:] for ids in self.b.encode(["a" + p for p in parts], num_threads=1)]

    def _learn(self, keys: list[str | bytes]) -> None:
        parts = [chunk(key) for key in keys]
        raw = [p.encode() for p in parts]
        a_raw, b_ids, labels = self.a.spelt(keys), self._b_ids(parts), self.b_labels
        # Tokens of A are arcs along the bytes and always spell them.
        good = [b"".join([labels[i] for i in b]) == r for r, b in zip(raw, b_ids)]
        sizes = np.array([len(r) if g else 0 for r, g in zip(raw, good)], np.int64)
        if not all(good):
            a_raw, b_ids = [a if g else b"" for a, g in zip(a_raw, good)], [b if g else [] for b, g in zip(b_ids, good)]
        n_a, n_b = np.array([len(x) // 4 for x in a_raw]), np.array([len(x) for x in b_ids])
        a, b = np.frombuffer(b"".join(a_raw), "<u4").astype(np.int64), np.array([i for x in b_ids for i in x], np.int64)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        # Between two neighbouring ends, one token of A and one of B overlap: a link.
        ends = np.union1d(a_ends, b_ends)
        at_a, at_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        both = ends[(a_ends[at_a] == ends) & (b_ends[at_b] == ends)] if ends.size else ends
        stops = np.cumsum(sizes)
        n_links = np.diff(np.searchsorted(ends, stops, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(both, stops, "right"), prepend=0)
        # The ids in order of groups, A before B, each with what follows it.
        side = np.concatenate((2 * np.searchsorted(both, a_ends), 2 * np.searchsorted(both, b_ends) + 1))
        order = np.argsort(side, kind="stable")
        side, names = side[order], np.concatenate((a, b))[order]
        follows = np.where(np.append(side[1:] == side[:-1], False)[:side.size], 0, 1 + (side & 1))
        spelt = list(map(self.names.__getitem__, (names + self.n_names * follows).tolist()))
        cuts = np.cumsum(n_a + n_b).tolist()
        first = self.pool.size + np.cumsum(n_links) - n_links
        self.known.update(zip(keys, range(len(self.text), len(self.text) + len(keys))))
        self.text += [b"".join(spelt[s:e])[:-1] if g else None for s, e, g in zip([0, *cuts], cuts, good)]
        self.counts = np.concatenate((self.counts, np.stack((n_a, n_b, n_groups, n_links))), axis=1)
        self.first = np.concatenate((self.first, first))
        self.pool = np.concatenate((self.pool, a[at_a] * self.n_b + b[at_b]))

    def align(self, found: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text: counts (tokens of A and B, groups, links) and digest; of each link: its text and pair."""
        keys = [(chunks(" " + t) if self.cuts else [(" " + t).encode()]) if t else [] for t in found]
        fresh = {key for own in keys for key in own if key not in self.known}
        if len(self.known) + len(fresh) > REMEMBERED or len(self.pool) > 20 * REMEMBERED:
            self._forget()
            fresh = {key for own in keys for key in own}
        if fresh:
            self._learn(list(fresh))
        slots = [list(map(self.known.__getitem__, own)) for own in keys]
        told = [list(map(self.text.__getitem__, own)) for own in slots]
        good = [bool(own) and None not in own for own in told]
        digests = [hashlib.sha256(b";".join(own)).hexdigest() if g else "" for own, g in zip(told, good)]
        slots = [own if g else [] for own, g in zip(slots, good)]
        flat = np.array([s for own in slots for s in own], np.int64)
        sums = np.concatenate((np.zeros((4, 1), np.int64), np.cumsum(self.counts[:, flat], axis=1)), axis=1)
        ends = np.cumsum([len(own) for own in slots]) if slots else np.zeros(0, np.int64)
        counts = np.diff(sums[:, ends], axis=1, prepend=0)
        n, first = self.counts[3, flat], self.first[flat]
        places = np.repeat(first - np.cumsum(n) + n, n)
        pairs = self.pool[places + np.arange(places.size)]
        if sum(map(len, fresh)) > _MOST_BYTES:
            self._forget()
        return counts, digests, np.repeat(np.arange(len(found)), counts[3]), pairs


@cache
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def bitmaps(keys: np.ndarray, docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """Compressed bitmaps of sorted ``(key, doc)``: keys, their numbers of documents, and the bitmaps one after another."""
    starts = np.flatnonzero(np.concatenate((np.ones(min(1, keys.size), bool), keys[1:] != keys[:-1])))
    sizes = np.diff(starts, append=keys.size)
    width = np.where(sizes > DENSE, SEGMENT_DOCS // 8, 2 * sizes)
    row = np.cumsum(width) // ROW_BYTES
    for s, e in zip(*_runs(row)):
        dense = np.flatnonzero(sizes[s:e] > DENSE) + s
        parts, at = [], starts[s]
        for d in dense.tolist():
            parts.append(docs[at:starts[d]].astype("<u2").tobytes())
            at = starts[d] + sizes[d]
            bits = np.zeros(SEGMENT_DOCS, bool)
            bits[docs[starts[d]:at]] = True
            parts.append(np.packbits(bits).tobytes())
        parts.append(docs[at:starts[e - 1] + sizes[e - 1]].astype("<u2").tobytes())
        yield keys[starts[s:e]], sizes[s:e], b"".join(parts)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return ([0, *cuts.tolist()], [*cuts.tolist(), values.size]) if values.size else ([], [])


def documents_of(sizes: np.ndarray, raw: bytes) -> np.ndarray:
    """The documents of the bitmaps that ``bitmaps`` made, one bitmap after another."""
    if not (sizes > DENSE).any():
        return np.frombuffer(raw, "<u2")
    at, out, done = 0, [], 0
    for d in np.flatnonzero(sizes > DENSE).tolist():
        n = int(sizes[done:d].sum())
        out.append(np.frombuffer(raw, "<u2", n, at))
        at += 2 * n
        out.append(np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, SEGMENT_DOCS // 8, at))).astype("<u2"))
        at, done = at + SEGMENT_DOCS // 8, d + 1
    return np.concatenate([*out, np.frombuffer(raw, "<u2", offset=at)])


_SCHEMA = ("segment long, doc int, id long, n_a long, n_b long, n_groups long, n_links long, digest string, "
           "plane int, pairs binary, sizes binary, bits binary")
_ARROW = pa.schema([("segment", pa.int64()), ("doc", pa.int32()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("digest", pa.string()), ("plane", pa.int32()),
                    ("pairs", pa.binary()), ("sizes", pa.binary()), ("bits", pa.binary())])


def index(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          segment_links: int = SEGMENT_LINKS) -> DataFrame:
    """Rows of documents (``doc`` is their number in their segment), and the inverted index of each segment.

    Every pair of ids that is linked in a segment has a compressed bitmap of the documents it is linked in
    (plane -1), and bitmaps of the documents whose number of further links has bit 0, 1, … set (planes 0, 1, …).
    A row of the index holds the bitmaps of neighbouring pairs of one plane, about ``ROW_BYTES`` of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using, task = aligner(a_path, b_path), TaskContext.get().partitionId()
        number, n_docs, waiting, n_waiting = 0, 0, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number, n_docs, waiting, n_waiting
            keys = np.sort(np.concatenate([np.zeros(0, np.int64), *waiting]))
            new = np.flatnonzero(np.concatenate((np.ones(min(1, keys.size), bool), keys[1:] != keys[:-1])))
            more, keys = np.diff(new, append=keys.size) - 1, keys[new]
            plane = -1
            while keys.size:
                on = slice(None) if plane < 0 else (more >> plane & 1).astype(bool)
                for pairs, sizes, raw in bitmaps(keys[on] >> 16, keys[on] & 0xFFFF):
                    row = {"segment": [(task << 32) + number], "plane": [plane], "pairs": [pairs.astype("<i8").tobytes()],
                           "sizes": [sizes.astype("<u4").tobytes()], "bits": [raw]}
                    yield pa.RecordBatch.from_arrays([pa.array(row.get(f.name, [None]), f.type) for f in _ARROW], schema=_ARROW)
                plane += 1
                left = more >> plane > 0
                keys, more = keys[left], more[left]
            number, n_docs, waiting, n_waiting = number + 1, 0, [], 0

        for batch in batches:
            ids, found = batch.column(0).to_pylist(), [t.decode() for t in texts(batch.column(1))]
            counts, digests, of, pairs = using.align(found)
            if n_docs + len(ids) > SEGMENT_DOCS:
                yield from flush()
            n = len(ids)
            columns = {"segment": np.full(n, (task << 32) + number), "doc": np.arange(n_docs, n_docs + n), "id": ids, "digest": digests,
                       **dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts))}
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)
            waiting.append(pairs << 16 | (of + n_docs))
            n_docs, n_waiting = n_docs + n, n_waiting + pairs.size
            if n_waiting > segment_links:
                yield from flush()
        yield from flush()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _SCHEMA)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bytes]]:
    for segment, plane, pairs, sizes, raw in zip(*(c.to_pylist() for c in batch.columns)):
        yield segment, plane, np.frombuffer(pairs, "<i8"), np.frombuffer(sizes, "<u4").astype(np.int64), raw


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and links of the pairs, popcounted bitmap by bitmap."""
    for batch in batches:
        for _, plane, pairs, sizes, _ in _rows(batch):
            links = sizes if plane < 0 else sizes << plane
            yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(sizes if plane < 0 else np.zeros_like(sizes)), pa.array(links)],
                                             names=["pair", "n_docs", "n_links"])


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """``(pair, a, b, n_docs, n_links, best)`` of every pair of ids in the index.

    Segments hold different documents, so the union of a pair's bitmaps is all of them, and their popcounts
    add up: a pair has one bitmap for a plane of a segment however many documents hold it, so frequent pairs
    make no more rows than rare ones. ``best`` marks the pairs with the most links of their ``b``, ties included.
    """
    found = rows.where("plane is not null").select("segment", "plane", "pairs", "sizes", F.lit(None).cast("binary").alias("bits")).mapInArrow(
        _counted, "pair long, n_docs long, n_links long").groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    found = found.select("pair", F.floor(F.col("pair") / n_b).cast("int").alias("a"), (F.col("pair") % n_b).cast("int").alias("b"), "n_docs", "n_links")
    most = found.groupBy("b").agg(F.max("n_links").alias("most"))
    return found.join(most, "b").select("pair", "a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))


def _sums(rows: DataFrame, scores: pa.Table) -> DataFrame:
    """``(segment, doc, n_best, count_sum)`` over the pairs of ``scores``, once or more for a document."""
    order = np.argsort(scores.column("pair").to_numpy())
    sent = rows.sparkSession.sparkContext.broadcast(tuple(scores.column(c).to_numpy()[order] for c in ("pair", "n_links", "best")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = sent.value
        now, sums = None, np.zeros((2, SEGMENT_DOCS), np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            docs = np.flatnonzero(sums[1])
            if docs.size:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(docs.size, now)), pa.array(docs.astype(np.int32)), *map(pa.array, sums[:, docs])],
                                                 names=["segment", "doc", "n_best", "count_sum"])
                sums[:] = 0

        for batch in batches:
            for segment, plane, pairs, sizes, raw in _rows(batch):
                if segment != now:
                    yield from flush()
                    now = segment
                at = np.minimum(np.searchsorted(known, pairs), known.size - 1)
                weight = np.where(known[at] == pairs, counts[at], 0) if known.size else np.zeros(pairs.size, np.int64)
                docs = documents_of(sizes, raw)
                times = 1 << max(plane, 0)
                np.add.at(sums[1], docs, np.repeat(weight * times, sizes))
                is_best = np.repeat((weight > 0) & best[at], sizes)
                np.add.at(sums[0], docs[is_best], times)
        yield from flush()

    return rows.where("plane is not null").select("segment", "plane", "pairs", "sizes", "bits").mapInArrow(
        run, "segment long, doc int, n_best long, count_sum long")


def scores_of_documents(rows: DataFrame, counted: DataFrame, pairs_at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """``(segment, doc, n_best, count_sum)``: the postings give every document the scores of its pairs.

    The scores are counted and sent to the workers, at most about ``pairs_at_once`` of them at a time; the
    index is read once for each such part, and each part adds its sums. Nothing of the index is shuffled.
    """
    parts = max(1, -(-counted.count() // pairs_at_once))
    counted = counted.select("pair", "n_links", "best")
    found = [_sums(rows, (counted.where(F.pmod(F.xxhash64("pair"), F.lit(parts)) == part) if parts > 1 else counted).toArrow())
             for part in range(parts)]
    return reduce(DataFrame.unionByName, found).groupBy("segment", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
            keep: Callable[[DataFrame, str], DataFrame] | None = None, segment_links: int = SEGMENT_LINKS,
            pairs_at_once: int = PAIRS_AT_ONCE) -> tuple[DataFrame, DataFrame]:
    """A row for each document, ``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest)``, and ``pair_counts``.

    ``a_path`` is a byte-level vocabulary, ``b_path`` a sentencepiece model; each text is encoded with a space
    before it. Groups are cut where tokens of both end; a link is a token of A and one of B that overlap.
    ``n_best`` counts the links whose pair has the most links of its B id in all documents, ``count_sum`` adds
    up the links of the pairs, ``digest`` spells the ids group by group. ``keep`` writes the index and the
    pairs (``common.stored``), so that texts are read once.

    Null and empty texts, and texts that one of the vocabularies cannot spell byte by byte, have no tokens:
    zeros and an empty digest. Rows that repeat an id or have none are documents of their own. A text of any
    length is one document of a segment. An empty table gives no rows.
    """
    import sentencepiece

    keep = keep or (lambda df, label: df)
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows = keep(index(docs, a_path, b_path, id_col, text_col, segment_links), "alignment")
    counted = keep(pair_counts(rows, n_b), "pairs")
    sums = scores_of_documents(rows, counted, pairs_at_once)
    found = rows.where("doc is not null").join(sums, ["segment", "doc"], "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "digest")
    return found, counted
