"""Shards of equal bytes by sampled splitters."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of keys a shard is made up of, and samples drawn for each of them.
RANGES = 128
SAMPLES = 8
#: A group of equal keys with this share of a shard is placed on its own.
HEAVY = 0.1
#: Rows that are numbered in one task.
NUMBERED = 1 << 16
OVERHEAD = 16


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD


class Splitters:
    """Ranges of keys: between sampled boundaries, and one or more for each heavy key."""

    def __init__(self, bounds: list[int], heavy: dict[int, int]):
        self.bounds = np.array(sorted(set(bounds)), np.int64)
        self.keys = np.array(sorted(heavy), np.int64)
        self.parts = np.array([heavy[k] for k in sorted(heavy)], np.int64)
        self.first = self.bounds.size + 1 + np.cumsum(self.parts) - self.parts

    def range_of(self) -> Callable:
        """A column function: the range of a key; the rows of a heavy key are dealt to its parts by ``spread``."""
        bounds, keys, parts, first = self.bounds, self.keys, self.parts, self.first

        @F.pandas_udf("long")
        def of(key: pd.Series, spread: pd.Series) -> pd.Series:
            k = key.to_numpy(np.int64)
            out = np.searchsorted(bounds, k, side="right").astype(np.int64)
            if keys.size:
                at = np.minimum(np.searchsorted(keys, k), keys.size - 1)
                own = keys[at] == k
                low = spread.to_numpy(np.int64).view(np.uint64) >> np.uint64(32)
                out[own] = (first[at] + ((low * parts[at].astype(np.uint64)) >> np.uint64(32)).astype(np.int64))[own]
            return pd.Series(out)
        return of


def place(ranges: list[tuple[int, int]], heavy: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Ranges ``(range, bytes)`` to shards of near equal bytes.

    Heavy keys go to the emptiest shard, heaviest first. The other ranges fill what is left of the shards
    in order of key: a range goes where its middle falls.
    """
    load, out = [(0, s) for s in range(shards)], {}
    for name, size in sorted(heavy, key=lambda x: (-x[1], x[0])):
        least, s = heapq.heappop(load)
        out[name] = s
        heapq.heappush(load, (least + size, s))
    filled = [n for n, _ in sorted(load, key=lambda x: x[1])]
    light = sum(n for _, n in ranges)
    # The level up to which the light ranges fill the shards.
    level, order = 0.0, sorted(filled)
    for i, n in enumerate(order, 1):
        level = (light + sum(order[:i])) / i
        if i == shards or level <= order[i]:
            break
    ends = list(accumulate(max(0.0, level - n) for n in filled))
    last = max((s for s in range(shards) if filled[s] < level), default=0)
    at, s = 0, 0
    for name, n in ranges:
        while s < last and ends[s] <= at + n / 2:
            s += 1
        out[name] = s
        at += n
    return out


def shards_of(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
              ranges: int = RANGES, keep=None) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)``: every row's shard of near equal bytes and its place there.

    A row's size is the UTF-8 bytes of its text and ``OVERHEAD``; its key is a hash of the text, so equal
    texts stay together. Keys are sampled by size (about ``shards * ranges * SAMPLES`` of them, whatever the
    table's size); quantiles of the sample cut the keys into ranges, whose bytes are then counted. A range
    with more than twice its share is sampled again and cut further, until it is light enough or holds one
    key. A key with a tenth of a shard or more is placed on its own, and one that is too large for a shard
    is cut by a hash of the id. Ranges fill the shards in order of key.

    Slots count from 0 without gaps: rows are numbered in bins of bounded size, behind the rows of the
    shard's earlier bins. A null text has no bytes and a null checksum. Repeated rows, null ids and ties are
    rows like any other (rows that agree in text and id stay together however many they are). An empty table
    gives no rows. ``keep`` writes the narrow table that the passes read (``common.stored``).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_bytes(F.col(text_col)).alias("size"),
                       F.crc32(F.col(text_col)).alias("text_crc32"), F.xxhash64(F.col(text_col)).alias("key"))
    rows = rows.withColumn("spread", F.xxhash64("id", "key"))
    rows = keep(rows, "sizes") if keep else rows
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / shards)
    # At most shards / HEAVY keys are heavy.
    sums = rows.groupBy("key").agg(F.sum("size").alias("n")).where(F.col("n") >= HEAVY * share).collect()
    heavy = {r["key"]: 1 if r["n"] <= share else math.ceil(r["n"] * ranges / share) for r in sums}
    whole = {r["key"] for r in sums if r["n"] <= share}
    fine = share / ranges
    light = rows.join(F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in heavy], "key long")), "key", "left_anti")

    def sampled(some: DataFrame, weight: Column, turn: int) -> list[int]:
        """Every ``SAMPLES``-th key of a sample in which a key stands for ``1 / weight`` bytes."""
        draw = F.pmod(F.xxhash64("spread", F.lit(turn)), F.lit(1 << 40)) / float(1 << 40)
        keys = sorted(r["key"] for r in some.where(draw < F.col("size") * weight).select("key").collect())
        return keys[SAMPLES - 1::SAMPLES] if turn == 0 else keys

    bounds = sampled(light, F.lit(SAMPLES / fine), 0)
    turn = 0
    while True:
        turn += 1
        using = Splitters(bounds, heavy)
        placed = rows.withColumn("range", using.range_of()("key", "spread"))
        found = placed.groupBy("range").agg(F.sum("size").alias("n"), F.count("*").alias("rows"), F.min("key").alias("low"),
                                            F.max("key").alias("high"), F.max("size").alias("most")).collect()
        full = [r for r in found if r["n"] > 2 * fine and r["low"] != r["high"] and r["range"] <= using.bounds.size]
        if not full:
            break
        spans = rows.sparkSession.createDataFrame([(r["range"], SAMPLES / (2 * fine)) for r in full], "range long, weight double")
        more = sampled(placed.join(F.broadcast(spans), "range"), F.col("weight"), turn)
        # Boundaries on either side of what the sample hit, and the heart of the range if it hit nothing new.
        bounds = [*using.bounds.tolist(), *more, *(k + 1 for k in more), *(r["high"] for r in full)]
    at = {r["range"]: r for r in found}
    alone = {int(f) for f, k in zip(using.first.tolist(), using.keys.tolist()) if k in whole}
    shard_of = place([(i, at[i]["n"]) for i in sorted(at) if i not in alone], [(i, at[i]["n"]) for i in alone if i in at], shards)
    bins = {i: math.ceil(r["rows"] / NUMBERED) for i, r in at.items()}
    plan = rows.sparkSession.createDataFrame([(i, shard_of[i], bins[i]) for i in at], "range long, shard int, bins int")
    dealt = placed.select("id", "size", "text_crc32", "key", "spread", "range").join(F.broadcast(plan), "range").withColumn(
        "bin", F.pmod(F.xxhash64("spread", F.lit(-1)), F.col("bins").cast("long")))
    sizes = {(r["range"], r["bin"]): r["n"] for r in dealt.groupBy("range", "bin").agg(F.count("*").alias("n")).collect()}
    used, first = [0] * shards, []
    for (i, b), n in sorted(sizes.items()):
        first.append((i, b, used[shard_of[i]]))
        used[shard_of[i]] += n
    base = rows.sparkSession.createDataFrame(first, "range long, bin long, first long")
    order = Window.partitionBy("range", "bin").orderBy("key", "spread", "id")
    return dealt.withColumn("nth", F.row_number().over(order)).join(F.broadcast(base), ["range", "bin"]).select(
        "id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"))
