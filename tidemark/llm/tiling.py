"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.llm.rolling import window_hashes

#: Words of the shortest tile; a seed is a window of as many words.
SEED_WORDS = 5
#: A document is contaminated if tiles cover this share of an item's words.
COVERAGE = 0.5
#: Words of benchmark items that are sent to the executors at once.
BLOCK_WORDS = 1 << 20
_FILTER_BITS = 20

SCHEMA = ("item_id long, item_words long, covered_words long, coverage double, n_tiles long, longest_tile long")


def tiles(doc: list[bytes], item: list[bytes], at_doc: np.ndarray, at_item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of an item: ``(start in item, start in document, words)``, longest first.

    ``at_doc`` and ``at_item`` are the starts of all shared windows of ``seed`` words. Windows that follow
    each other on a diagonal form a match; again and again the longest match whose words are free in both
    texts becomes a tile (ties: first in the item, then in the document). A match that has lost words to a
    tile competes again with each of its free parts of ``seed`` words or more.
    """
    order = np.lexsort((at_item, at_item - at_doc))
    i, d = at_item[order], at_doc[order]
    new = np.flatnonzero((np.diff(i) != 1) | (np.diff(d) != 1)) + 1
    heads, ends = np.concatenate(([0], new)), np.concatenate((new, [i.size]))
    queue = [(-(e - s + seed - 1), int(i[s]), int(d[s])) for s, e in zip(heads.tolist(), ends.tolist())]
    heapq.heapify(queue)
    used_item, used_doc, found = np.zeros(len(item), bool), set(), []
    while queue:
        length, a, b = heapq.heappop(queue)
        n = -length
        free = [not used_item[a + k] and b + k not in used_doc and item[a + k] == doc[b + k] for k in range(n)]
        if all(free):
            found.append((a, b, n))
            used_item[a:a + n] = True
            used_doc.update(range(b, b + n))
            continue
        start = None
        for k, is_free in enumerate([*free, False]):
            if is_free and start is None:
                start = k
            elif not is_free and start is not None:
                if k - start >= seed:
                    heapq.heappush(queue, (start - k, a + start, b + start))
                start = None
    return found


class Items:
    """Some benchmark items and the hashes of their seeds."""

    def __init__(self, rows: list[tuple[int, str]], seed: int, coverage: float):
        self.seed, self.coverage = seed, coverage
        self.ids = [r[0] for r in rows]
        self.words = [(r[1] or "").encode().lower().split() for r in rows]
        counts = np.array([max(0, len(w) - seed + 1) for w in self.words], np.int64)
        hashes = window_hashes(self.words, seed)[0]
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(rows)), counts)[order]
        self.start = (np.arange(hashes.size) - np.repeat(np.cumsum(counts) - counts, counts))[order]
        self.coarse = np.zeros(1 << _FILTER_BITS, bool)
        self.coarse[hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def matches(self, column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """``(row, item, tiles)`` for the texts and items whose tiles cover enough of the item."""
        found = [t.lower().split() for t in texts(column)]
        counts = np.array([max(0, len(w) - self.seed + 1) for w in found], np.int64)
        hashes = window_hashes(found, self.seed)[0]
        maybe = np.flatnonzero(self.coarse[hashes >> np.uint64(64 - _FILTER_BITS)])
        first = np.searchsorted(self.hashes, hashes[maybe], "left")
        times = np.searchsorted(self.hashes, hashes[maybe], "right") - first
        maybe, first, times = maybe[times > 0], first[times > 0], times[times > 0]
        ends = np.cumsum(counts)
        row = np.searchsorted(ends, maybe, "right")
        at = maybe - (ends - counts)[row]
        # A seed of the text meets each of its places in the items.
        place = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        row, at, item, start = np.repeat(row, times), np.repeat(at, times), self.item[place], self.start[place]
        order = np.lexsort((item, row))
        row, at, item, start = row[order], at[order], item[order], start[order]
        cuts = np.flatnonzero((np.diff(row) != 0) | (np.diff(item) != 0)) + 1
        bounds = [0, *cuts.tolist(), row.size] if row.size else []
        for s, e in zip(bounds, bounds[1:]):
            words, need = self.words[item[s]], self.coverage * len(self.words[item[s]])
            reach = np.zeros(len(words) + 1, np.int64)
            np.add.at(reach, start[s:e], 1)
            np.add.at(reach, start[s:e] + self.seed, -1)
            if (np.cumsum(reach) > 0).sum() >= need:  # no tiling covers more than the seeds do
                laid = tiles(found[row[s]], words, at[s:e], start[s:e], self.seed)
                if laid and sum(n for *_, n in laid) >= need:
                    yield int(row[s]), int(item[s]), laid


def _blocks(items: DataFrame, id_col: str, text_col: str, seed: int, coverage: float, block_words: int) -> Iterator[Items]:
    """The items in blocks of about ``block_words`` words, one after another; at least one block."""
    rows = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / (6 * block_words)))
    for block in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block) if n > 1 else rows
        yield Items(sorted((tuple(r) for r in part.collect()), key=repr), seed, coverage)


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", seed_words: int = SEED_WORDS,
                 coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(id, item_id, item_words, covered_words, coverage, n_tiles, longest_tile)``: texts that hold an item.

    Words are cut at ASCII blanks and lower-cased in ASCII. Windows of ``seed_words`` words that a text
    shares with an item are found by rolling hash, joined into matches and laid as tiles, longest first; no
    word is covered twice, so an item whose passages stand in another order is still covered. A row comes
    out for each text and item of which tiles cover the share ``coverage`` or more.

    The items are a query set: they reach the executors in blocks of bounded size, and every text is held
    against every block where it is read, without a shuffle. Null or blank texts, and items shorter than a
    seed, match nothing. Repeated rows each match; a row without id comes out without id. Empty tables give
    no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def against(block: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = defaultdict(list)
                ids = batch.column(0).to_pylist()
                for row, item, laid in block.matches(batch.column(1)):
                    sizes, total = [n for *_, n in laid], len(block.words[item])
                    for name, value in (("id", ids[row]), ("item_id", block.ids[item]), ("item_words", total),
                                        ("covered_words", sum(sizes)), ("coverage", sum(sizes) / total),
                                        ("n_tiles", len(sizes)), ("longest_tile", max(sizes))):
                        made[name].append(value)
                if made:
                    yield pa.RecordBatch.from_pydict(dict(made), schema=out)
        return run

    out = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.int64()), ("covered_words", pa.int64()),
                     ("coverage", pa.float64()), ("n_tiles", pa.int64()), ("longest_tile", pa.int64())])
    parts = [rows.mapInArrow(against(block), f"id long, {SCHEMA}")
             for block in _blocks(items, item_col, item_text_col, seed_words, coverage, block_words)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", seed_words: int = SEED_WORDS, coverage: float = COVERAGE,
                         block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, whose text holds no item. No shuffle, no join."""
    def clean(block: Items, at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in block.matches(batch.column(at)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
        return run

    at = docs.columns.index(text_col)
    for block in _blocks(items, item_col, item_text_col, seed_words, coverage, block_words):
        docs = docs.mapInArrow(clean(block, at), docs.schema)
    return docs
