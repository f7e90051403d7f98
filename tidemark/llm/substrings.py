"""Substring de-duplication: repeated word windows found by Rabin-Karp hashes, removed as maximal intervals."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import longs, texts
from tidemark.llm.rolling import window_hashes

#: Bytes of text in a block, and of the texts whose windows meet in one hash range.
BLOCK_BYTES = 8 << 20
_U = np.uint64


class _Block:
    """Windows of the documents of a block, in order of id: hashes, and each distinct hash once."""

    def __init__(self, ids: np.ndarray, found: list[list[bytes]], words: int):
        self.counts = np.array([max(0, len(w) - words + 1) for w in found], np.int64)
        h, more = window_hashes(found, words, 2)
        more = (more >> _U(48)).astype(np.uint16)
        self.order = _ordered(h, more)
        h, more = h[self.order], more[self.order]
        self.new = _begins(h, more)
        self.h, self.more = h[self.new], more[self.new]
        self.owner = np.repeat(ids, self.counts)

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Which windows also start in a smaller document: in an earlier block, or earlier in this one."""
        group = np.cumsum(self.new) - 1
        owner = self.owner[self.order]
        flags = np.zeros(self.order.size, bool)
        flags[self.order] = elsewhere[group] | (owner > owner[self.new][group])
        return flags


def _ordered(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    order = np.argsort(h, kind="stable")
    s, m = h[order], more[order]
    return np.lexsort((more, h)) if ((s[1:] == s[:-1]) & (m[1:] != m[:-1])).any() else order


def _begins(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.concatenate((np.ones(min(1, h.size), bool), (h[1:] != h[:-1]) | (more[1:] != more[:-1])))


def _packed(h: np.ndarray, more: np.ndarray) -> bytes:
    """Steps between sorted hashes, byte by byte: high bytes of the steps are zero and compress away."""
    steps = np.diff(h, prepend=_U(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes() + more.tobytes()


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw) // 10
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n).reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64), np.frombuffer(raw, np.uint16, n, 8 * n)


def _by_id(group: pa.Table) -> tuple[np.ndarray, list[list[bytes]]]:
    group = group.sort_by("id")
    return longs(group.column("id")), [t.split() for t in texts(group.column("text"))]


def _ship(words: int, buckets: int):
    def run(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        if block >= 0:
            one = _Block(*_by_id(group), words)
            edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
            cuts = np.concatenate(([0], np.searchsorted(one.h, edges), [one.h.size])).tolist()
            sent = [(b, _packed(one.h[s:e], one.more[s:e])) for b, (s, e) in enumerate(zip(cuts, cuts[1:])) if e > s]
        else:
            sent = []
        return pa.table({"block": pa.array([block] * len(sent), pa.int64()), "bucket": pa.array([b for b, _ in sent], pa.int64()),
                         "hashes": pa.array([h for _, h in sent], pa.binary())})
    return run


def _seen_before(group: pa.Table) -> pa.Table:
    """Of the hashes in one range: which came from an earlier block too, in the order in which they were sent."""
    group = group.sort_by("block")
    parts = [_unpacked(raw) for raw in group.column("hashes").to_pylist()]
    h, more = (np.concatenate(side) for side in zip(*parts))
    order = _ordered(h, more)
    flags = np.empty(h.size, bool)
    flags[order] = ~_begins(h[order], more[order])
    cuts = np.cumsum([0] + [p[0].size for p in parts]).tolist()
    packed = [np.packbits(flags[s:e]).tobytes() for s, e in zip(cuts, cuts[1:])]
    return pa.table({"block": group.column("block"), "bucket": group.column("bucket"),
                     "n": pa.array(np.diff(cuts)), "flags": pa.array(packed, pa.binary())})


def _intervals(starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that overlap or touch merge into maximal intervals of words."""
    gaps = np.flatnonzero(np.diff(starts) > words)
    return starts[np.concatenate(([0], gaps + 1))], starts[np.concatenate((gaps, [starts.size - 1]))] + words


SCHEMA = "id long, n_words long, n_removed long, kept string, removed array<struct<start:long,end:long>>"
_OUT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()),
                  ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _cut(words: int):
    def run(group: pa.Table, flagged: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _OUT.empty_table()
        if group.column("block")[0].as_py() < 0:
            ids, found = group.column("id"), [t.split() for t in texts(group.column("text"))]
            marks = None
        else:
            ids, found = _by_id(group)
            one, flagged = _Block(ids, found, words), flagged.sort_by("bucket")
            bits = [np.unpackbits(np.frombuffer(f, np.uint8), count=n).astype(bool)
                    for n, f in zip(flagged.column("n").to_pylist(), flagged.column("flags").to_pylist())]
            marks = one.repeated(np.concatenate([np.empty(0, bool), *bits]))
            ends = np.cumsum(one.counts).tolist()
        n_words, removed, kept = [], [], []
        for i, w in enumerate(found):
            spans: list[tuple[int, int]] = []
            if marks is not None:
                at = np.flatnonzero(marks[ends[i] - int(one.counts[i]):ends[i]])
                if at.size:
                    spans = list(zip(*(side.tolist() for side in _intervals(at, words))))
            n_words.append(len(w))
            rest, last = [], 0
            for s, e in spans:
                rest += w[last:s]
                last = e
            kept.append(b" ".join(rest + w[last:] if spans else w).decode())
            removed.append([{"start": s, "end": e} for s, e in spans])
        return pa.Table.from_arrays(
            [pa.array(ids) if isinstance(ids, np.ndarray) else ids, pa.array(n_words, pa.int64()),
             pa.array([sum(x["end"] - x["start"] for x in spans) for spans in removed], pa.int64()),
             pa.array(kept, pa.string()), pa.array(removed, _OUT.field("removed").type)], schema=_OUT)
    return run


def _block_of(bounds: list[float]) -> Column:
    @F.pandas_udf("long")
    def block(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(float, na_value=np.nan), side="right"))
    return block


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 13,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(id, n_words, n_removed, kept, removed)``: every text without the words of windows seen in a smaller id.

    A window is ``words`` consecutive words of one text. Every word covered by a window whose words also start
    in a row with a smaller id is removed; windows are judged on the input. ``kept`` has the other words joined
    by a blank, ``removed`` the maximal intervals ``[start, end)`` in words.

    Documents are gathered once into blocks of neighbouring ids (a few MB each). A block sends every distinct
    window hash once, dealt by hash range; a range finds the hashes that an earlier block sent as well and
    answers with one bit for each. So a window that stands in a third of all rows counts once a block, and
    neither side holds more than one block or one range. Two windows count as equal if two independent
    polynomial hashes of 80 bits together agree: n windows give n**2 / 2**81 false matches on average.

    Null and blank texts have no words. Rows without id stay whole and remove nothing elsewhere. Rows that
    repeat an id do not remove each other. Texts shorter than a window stay. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    bounds = rows.approxQuantile("id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    spare = -1 - F.pmod(F.xxhash64("text"), F.lit(n))
    blocks = rows.withColumn("block", F.when(F.col("id").isNull(), spare).otherwise(_block_of(sorted(bounds or []))("id")))
    sent = blocks.groupBy("block").applyInArrow(_ship(words, n), "block long, bucket long, hashes binary")
    seen = sent.groupBy("bucket").applyInArrow(_seen_before, "block long, bucket long, n long, flags binary")
    return blocks.groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(_cut(words), SCHEMA)
