"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most frequent n-grams that make up a profile.
PROFILE = 400
#: Labelled documents a language is learnt from, at most.
SAMPLE = 3000
UNKNOWN = "und"
_BITS = np.uint64(21)  # a code point


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(text: str | None) -> np.ndarray:
    """1-, 2- and 3-grams of the lower-cased words of a text, as numbers; words are runs of letters.

    A word is padded with one blank on either side; no n-gram reaches into another word.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.uint64)
    points = np.where(letter, points, 32)
    points = points[letter | np.concatenate(([True], letter[:-1]))]
    points = np.concatenate(([32], points, [32])).astype(np.uint64)
    a, b, c = points[:-2], points[1:-1], points[2:]
    pairs = (points[:-1] << _BITS) | points[1:]
    threes = ((a << (_BITS + _BITS)) | (b << _BITS) | c)[b != 32]
    return np.concatenate((points[points != 32], pairs[pairs != ((32 << 21) | 32)], threes))


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and how often each occurs."""
    grams = np.sort(grams)
    at = np.flatnonzero(np.concatenate((np.ones(min(1, grams.size), bool), grams[1:] != grams[:-1])))
    return grams[at], np.diff(at, append=grams.size)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first; ties in order of the n-gram."""
    if counts.size > size:
        least = np.partition(counts, counts.size - size)[counts.size - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))[:size]]


class Profiles:
    """Ranked n-grams of each language, and the out-of-place distance of a text to all of them."""

    def __init__(self, ranks: dict[str, list[int]], size: int):
        self.size, self.names = size, sorted(ranks)
        self.known = np.unique(np.array([g for r in ranks.values() for g in r], np.uint64))
        # A last column for n-grams that no language has.
        self.rank = np.full((len(self.names), self.known.size + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            self.rank[i, np.searchsorted(self.known, np.array(ranks[name], np.uint64))] = np.arange(len(ranks[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language (ties: first by name) and how near it is, 0 to 1."""
        grams, counts = counted(ngrams(text))
        if not grams.size or not self.names:
            return UNKNOWN, 0.0
        top = ranked(grams, counts, self.size)
        at = np.searchsorted(self.known, top)
        at[self.known[np.minimum(at, self.known.size - 1)] != top] = self.known.size
        theirs = self.rank[:, at]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(top.size))).sum(axis=1)
        best = int(np.argmin(apart))
        return self.names[best], 1 - float(apart[best]) / (self.size * top.size)


def learn(docs: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", size: int = PROFILE, sample: int = SAMPLE) -> Profiles:
    """Profiles of the languages in ``lang_col``, from rows where ``usable`` holds and text and language are known.

    A language is learnt from a random ``sample`` of its documents at most (by hash of the id, so reruns
    agree); their n-grams are counted in Spark, and ``size`` n-grams a language reach the driver. Without
    usable rows there are no languages, and every text is ``und``.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                       (F.lit(True) if usable is None else usable).alias("use"))
    rows = rows.where("use and text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().collect()
    if not sizes:
        return Profiles({}, size)
    draw = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*(x for r in sizes for x in (F.lit(r["lang"]), F.lit(min(1.0, 1.2 * sample / r["count"])))))
    picked = rows.where(draw < share[F.col("lang")])
    first = Window.partitionBy("lang").orderBy(draw, "id", F.xxhash64("text"))
    picked = picked.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= sample).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = (batch.column(i).to_pylist() for i in (0, 1))
            for lang in sorted(set(langs)):
                grams, counts = counted(np.concatenate([ngrams(t) for of, t in zip(langs, texts) if of == lang]))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * grams.size), pa.array(grams.view(np.int64)),
                                                  pa.array(counts)], names=["lang", "gram", "n"])

    counts = picked.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).collect()
    ranks: dict[str, list[int]] = {}
    for row in sorted(best, key=lambda r: (r["lang"], r["rank"])):
        ranks.setdefault(row["lang"], []).append(row["gram"])
    return Profiles(ranks, size)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text", lang_col: str = "lang_pred",
             score_col: str = "score") -> DataFrame:
    """``docs`` with the language of every whole text and its score; a column of one of these names is replaced.

    A text's ``profiles.size`` most frequent n-grams are held against each profile: an n-gram is as far away
    as its ranks differ, or as a whole profile if the language lacks it. The score is 1 for the language's
    own ranking and 0 for a text with nothing in common with any language. Null texts and texts without a
    letter are ``und`` with score 0. Runs where the rows are read, without a shuffle.
    """
    kept = [c for c in docs.columns if c not in (lang_col, score_col)]
    at = docs.columns.index(text_col)
    schema = docs.select(*(docs[c] for c in docs.columns)).select(kept).withColumn(lang_col, F.lit("")).withColumn(
        score_col, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t) for t in batch.column(at).to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*kept, lang_col, score_col])
    return docs.mapInArrow(run, schema)


def only_known(docs: DataFrame, profiles: Profiles, least_score: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns unchanged, whose text is in one of the languages.

    Texts that are ``und`` or further than ``1 - least_score`` from every profile are rejected.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (profiles.predict(t) for t in batch.column(at).to_pylist())
            yield batch.filter(pa.array([name != UNKNOWN and score >= least_score for name, score in found], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
