"""SimHash near-duplicates by deletion variants of fingerprint halves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import longs, stored, texts
from tidemark.llm.components import components

SEED = 42
#: Two fingerprints are linked if they differ in so many bits at most. With two halves, one differs by one bit at most.
MOST_BITS = 3
#: Members of one index entry that are compared in one go; larger entries are cut into pairs of chunks.
ENTRY = 4096
#: Ids (8 bytes each) that may be broadcast to drop their rows.
BROADCAST_IDS = 1 << 20
_ROWS = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> bytes:
    """64 bits, most significant first: a bit is set if it is set in over half of the shingles' hashes."""
    found = text.lower().split()
    if not found:
        return bytes(8)
    line = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_digest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest, n = xxhash.xxh64_digest, len(found) - words + 1
    first, last = starts[:n].tolist(), ends[words - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _ROWS):
        hashes = b"".join([digest(line[s:e], SEED) for s, e in zip(first[at:at + _ROWS], last[at:at + _ROWS])])
        ones += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > n).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, fp)``: the 64-bit fingerprint of every text as a signed long; null and blank texts have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(fingerprint(t, words) for t in texts(batch.column(1)))
            fps = np.frombuffer(raw, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, fp long")


def _first_entry(x: np.ndarray, variant: int) -> np.ndarray:
    """Whether ``variant`` is the first of the index entries that two fingerprints with difference ``x`` share."""
    half, bit = variant >> 5, np.uint64(variant & 31)
    high, low = x >> np.uint64(32), x & np.uint64(0xFFFFFFFF)
    here = low if half else high
    own = (here == (np.uint64(1) << bit)) | ((here == 0) & (bit == 0))
    return own & (np.bitwise_count(high) > 1) if half else own


def _linked(x: np.ndarray, variant: int) -> np.ndarray:
    return (np.bitwise_count(x) <= MOST_BITS) & _first_entry(x, variant)


def _forest(fps: np.ndarray, variant: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect the members of an entry as all its links would: fewer links than members."""
    edges, left = [], fps
    while left.size > 1:
        front, left = [left[0]], left[1:]
        while front and left.size:
            at = front.pop()
            hit = _linked(left ^ at, variant)
            if hit.any():
                near, left = left[hit], left[~hit]
                edges.append((np.full(near.size, at), near))
                front.extend(near)
    return edges


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(entry, chunks, fp)`` with equal entries next to each other become verified links."""
    def of_runs(entry: np.ndarray, chunks: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        cuts = np.flatnonzero((entry[1:] != entry[:-1]) | (chunks[1:] != chunks[:-1])) + 1
        bounds = np.concatenate(([0], cuts, [entry.size]))
        made: list[tuple[np.ndarray, np.ndarray]] = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if e - s > 1:
                made += _forest(np.unique(fps[s:e]), int(entry[s] >> 32))
        if made:
            a, b = (np.concatenate(side).view(np.int64) for side in zip(*made))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    kept = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
    for batch in batches:
        now = [longs(batch.column(0)), longs(batch.column(1)), longs(batch.column(2)).view(np.uint64)]
        entry, chunks, fps = (np.concatenate(pair) for pair in zip(kept, now))
        if entry.size:
            tail = (entry == entry[-1]) & (chunks == chunks[-1])
            cut = entry.size - int(np.argmin(tail[::-1])) if not tail.all() else 0
            yield from of_runs(entry[:cut], chunks[:cut], fps[:cut])
            kept = [entry[cut:], chunks[cut:], fps[cut:]]
    yield from of_runs(*kept)


def links(distinct: DataFrame, entry_size: int = ENTRY) -> DataFrame:
    """Links between different fingerprints (column ``fp``) at ``MOST_BITS`` or fewer differing bits.

    A fingerprint has two halves; if two fingerprints differ by three bits, one half differs by one at most.
    So each half is indexed once for each of its bits with that bit deleted (64 entries a fingerprint), and
    entries are joined by equality: members of an entry are verified against the whole fingerprints. Of the
    links of an entry a spanning forest is returned, which has the same components; a link is looked at in
    only one of the entries that both ends share. An entry with more than ``entry_size`` members is cut into
    chunks, and each pair of chunks is compared in a group of its own.
    """
    variants = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("v")).select("fp", F.expr(
        "(cast(v as bigint) << 32) | ((if(v < 32, fp >>> 32, fp & 4294967295L)) & ~(1L << (v & 31)))").alias("entry"))
    sized = variants.withColumn("n", F.count("*").over(Window.partitionBy("entry"))).where("n > 1")
    schema = "a long, b long"
    usual = sized.where(F.col("n") <= entry_size).select("entry", F.lit(0).cast("long").alias("chunks"), "fp")
    found = usual.sortWithinPartitions("entry").mapInArrow(_links, schema)
    cut = sized.where(F.col("n") > entry_size).withColumn("g", F.ceil(F.col("n") * 2 / entry_size)).withColumn(
        "c", F.pmod(F.xxhash64("fp"), F.col("g"))).withColumn("d", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)))
    cut = cut.select("entry", (F.least("c", "d") * F.col("g") + F.greatest("c", "d")).alias("chunks"), "fp")
    pairs = cut.repartition("entry", "chunks").sortWithinPartitions("entry", "chunks").mapInArrow(_links, schema)
    return found.unionByName(pairs).distinct()


def _classes(prints: DataFrame, entry_size: int) -> DataFrame:
    """``(fp, root)`` of every fingerprint: equal roots are one component."""
    nodes = prints.select("fp").distinct()
    roots = components(links(nodes, entry_size)).withColumnRenamed("node", "fp")
    return nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    entry_size: int = ENTRY) -> DataFrame:
    """``(id, fp, component)`` for every row: its fingerprint and the least id that links reach from it.

    Equal texts have equal fingerprints and share one node of the graph. A null or blank text has fingerprint
    0 and is linked like any other. A row without id has a fingerprint but no component and links nothing.
    Rows that repeat an id appear as often as they came; the id belongs to the components of all its texts'
    fingerprints, each row to that of its own. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    nodes = prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("first"))
    named = nodes.join(_classes(nodes, entry_size), "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component"))
    classes = named.join(least, "root").select(F.col("fp").alias("node"), "component")
    return prints.join(classes, (prints.fp == classes.node) & prints.id.isNotNull(), "left").select(
        "id", "fp", "component")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                            broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row of ``docs``, all its columns unchanged, of every component: that with the least id.

    Rows are judged by id and text: one that shares its id with another text stays if it is the first of its own
    component. Rows without id are compared too; they come after those with one, in order of a hash of their
    text. Of rows equal in id and text one stays. What goes is counted; up to ``broadcast_ids`` pairs of id and
    hash are broadcast, so texts stay where they are read, more are joined by a shuffle.
    """
    key = [F.col(id_col).cast("long").alias("key_id"), F.xxhash64(F.col(text_col)).alias("key_text")]
    prints = stored(_keyed_fingerprints(docs, key, text_col, words), "fingerprints")
    rows = prints.groupBy("fp", "key_id", "key_text").agg(F.count("*").alias("n"))
    place = F.struct(F.col("key_id").isNull().alias("last"), "key_id", "key_text")
    named = rows.join(_classes(prints, ENTRY), "fp")
    first = named.groupBy("root").agg(F.min(place).alias("first"))
    judged = stored(named.join(first, "root").select("key_id", "key_text", "n", (place == F.col("first")).alias("stays")), "judged")
    gone = judged.where("not stays").select("key_id", "key_text")
    if gone.count() <= broadcast_ids:
        gone = F.broadcast(gone)

    def same(of: DataFrame) -> Column:
        return F.col(id_col).cast("long").eqNullSafe(of["key_id"]) & (F.xxhash64(F.col(text_col)) == of["key_text"])

    kept = docs.join(gone, same(gone), "left_anti")
    repeated = judged.where("stays and n > 1").select("key_id", "key_text")
    if repeated.isEmpty():
        return kept
    one_each = kept.join(repeated, same(repeated), "left_semi").withColumn("key of the text", F.xxhash64(F.col(text_col))).dropDuplicates(
        [id_col, "key of the text"])
    return kept.join(repeated, same(repeated), "left_anti").unionByName(one_each.select(docs.columns))


def _keyed_fingerprints(docs: DataFrame, key: list[Column], text_col: str, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.frombuffer(b"".join(fingerprint(t, words) for t in texts(batch.column(2))), ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], names=["key_id", "key_text", "fp"])
    return docs.select(*key, F.col(text_col).alias("text")).mapInArrow(run, "key_id long, key_text long, fp long")
