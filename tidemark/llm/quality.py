"""Quality rules and a hashed n-gram likelihood ratio between trusted and raw text, in DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the hashed 1- and 2-grams: a weight each reaches the executors.
BUCKETS = 1 << 18
#: Bits of the filter on trusted ids: 8 MB of them, whatever the number of ids, reach the executors by a broadcast.
PLACES = 1 << 26
#: Rows that a round of the search for the threshold brings to the driver, at most.
BINS = 1 << 12
#: Share of the trusted documents that the threshold lets through.
TRUSTED_KEPT = 0.99
#: A document is scored by a model that was learnt without the trusted documents of its own fold.
FOLDS = 2
REPEAT = 8  # words of a window; n_repeat_words joins halves, so it is fixed
_BLOCK = 1 << 15  # bits of a value of bitmap_construct_agg
_WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    """``words``, their hashes (``ones``) and the hashes of all pairs of neighbours (``twos``), once a row.

    ``twos`` has an entry for every word; the last one is no pair.
    """
    found = docs.withColumn("words", words(F.col(text_col)))
    found = found.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
    return found.withColumn("twos", F.transform("ones", lambda h, i: F.xxhash64(h, F.get("ones", i + 1))))


def _grams() -> Column:
    """Hashes of all 1- and 2-grams of a row of ``_hashed``."""
    return F.concat("ones", F.slice("twos", F.lit(1), F.greatest(F.size("ones") - 1, F.lit(0))))


def _bucket(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All ids labelled good and not toxic by every label they have."""
    judged = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    return judged.where((F.col("quality") == 1) & ~F.coalesce(F.col("toxic") == 1, F.lit(False))).select("id")


def fold(id_col: Column) -> Column:
    return F.pmod(F.xxhash64(id_col, F.lit("fold")), F.lit(FOLDS)).cast("int")


def maybe_trusted(rows: DataFrame, trusted: DataFrame) -> DataFrame:
    """``rows`` and ``maybe``: true for every trusted ``id`` and for few others, so that only these need a join by id.

    Each trusted id sets one of ``PLACES`` bits. More ids make ``maybe`` true for more rows, but the filter no larger.
    """
    place = F.xxhash64(F.col("id"), F.lit("place")).bitwiseAND(F.lit(PLACES - 1))
    block, bit = F.floor(place / _BLOCK), place % _BLOCK
    blocks = trusted.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    found = rows.withColumn("block", block).join(F.broadcast(blocks), "block", "left")
    byte = F.conv(F.hex(F.substring("bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.col("id").isNotNull() & F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    return found.select(*rows.columns, maybe.alias("maybe"))


def weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row with an array: for each fold and bucket, log of its share in the trusted texts of the other folds
    over its share in all texts.

    Every 1- and 2-gram of every text counts for the raw model, those of trusted ids for the target models.
    Counts of a task are combined before the shuffle, so no more than ``(FOLDS + 1) * BUCKETS`` rows leave it.
    All multinomials are smoothed by one. The ids grow with the labels, so they are joined by a shuffle at every
    size; only the texts of ``maybe_trusted`` ids take part, the others are counted where they are read.
    """
    rows = maybe_trusted(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), trusted)
    joined = rows.where("maybe").join(trusted.withColumn("fold", fold(F.col("id"))).hint("merge"), "id", "left")
    rows = rows.where("not maybe").withColumn("fold", F.lit(None).cast("int")).select("text", "fold").union(joined.select("text", "fold"))
    grams = _hashed(rows, "text").select("fold", F.explode(_grams()).alias("gram"))
    counts = grams.groupBy(_bucket(F.col("gram")).alias("bucket"), "fold").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.sum("n").alias("raw"), F.sum(F.when(F.col("fold").isNotNull(), F.col("n"))).alias("target"),
        *[F.sum(F.when(F.col("fold") == f, F.col("n"))).alias(f"of_{f}") for f in range(FOLDS)])
    every = docs.sparkSession.range(BUCKETS).withColumnRenamed("id", "bucket").join(counts, "bucket", "left").na.fill(0)
    others = [(F.col("target") - F.col(f"of_{f}")).alias(f"without_{f}") for f in range(FOLDS)]
    # One row of BUCKETS numbers for each model.
    names = ["raw", *[f"without_{f}" for f in range(FOLDS)]]
    kept = every.select("bucket", "raw", *others).agg(*[F.sum(n).alias(f"all_{n}") for n in names],
                                                      F.array_sort(F.collect_list(F.struct("bucket", *names))).alias("each"))
    share = lambda n, total: F.log((n + 1) / (total + BUCKETS))

    def of_fold(name: str) -> Column:
        return F.transform("each", lambda x: share(x[name], F.col(f"all_{name}")) - share(x["raw"], F.col("all_raw")))

    return kept.select(F.concat(*[of_fold(n) for n in names[1:]]).alias("weights"))


def n_repeat_words() -> Column:
    """Words covered by windows of 8 words that occur twice or more in the text, the first one included.

    Of a row of ``_hashed``: the hash of a window is made of those of its halves, down to the pairs in
    ``twos``. The windows' places are sorted by hash, those with an equal neighbour are sorted by place, and
    each adds the words up to the next one, 8 at most. Texts without a repeated window stop at the count of
    distinct hashes.
    """
    n = F.size("twos")

    def joined(halves: Column, apart: int) -> Column:
        return F.transform(halves, lambda h, i: F.xxhash64(h, F.get(halves, i + apart)))

    eights = _then(F.col("twos"), lambda twos: _then(joined(twos, 2), lambda fours: joined(fours, 4)))
    windows = F.when(n >= REPEAT, F.slice(eights, F.lit(1), n - (REPEAT - 1)))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _then(placed, lambda p: F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])))
        places = F.sort_array(F.transform(twice, lambda x: x["i"]))
        gaps = _then(places, lambda p: F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(REPEAT)), F.lit(REPEAT))))
        return F.aggregate(gaps, F.lit(0), lambda total, x: total + x)

    found = _then(windows, lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0)))
    return F.coalesce(found, F.lit(0)).cast("long")


def _then(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return F.coalesce(_then(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long")


def scored(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score)`` of every row.

    The score is the mean weight of a text's 1- and 2-grams in the model without its fold; a text without words
    has none. One pass, no shuffle: the model is one row of ``FOLDS * BUCKETS`` numbers, which the query reads once.
    """
    rows = _hashed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "text")
    # The optimizer moves the subquery into the sum, its only use: rows are not copied with the model.
    rows = rows.withColumn("weights", model.select("weights").scalar())
    # The place where the fold's weights begin is found once a row, not once a gram.
    sums = _then(fold(F.col("id")) * BUCKETS, lambda start: F.aggregate(
        _grams(), F.lit(0.0), lambda total, g: total + F.get("weights", start + _bucket(g))))
    n = F.size("words").cast("long")
    found = rows.select(
        "id", n.alias("n_words"), F.coalesce(F.char_length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long").alias("word_chars"),
        F.coalesce(F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")), F.lit(0)).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"), n_repeat_words().alias("n_repeat_words"),
        F.when(n > 0, sums / (2 * n - 1)).alias("score"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def least_of(scores: DataFrame, share: float) -> float | None:
    """The percentile ``share`` of the column ``score``, exact, as ``F.percentile`` defines it; None of no score.

    Scores are counted in ever finer bins around the place, so they never meet in one task.
    """
    n, low, high = scores.agg(F.count("score"), F.min("score"), F.max("score")).first()
    if not n:
        return None
    place = (n - 1) * share
    rank = first = math.floor(place)
    while low < high:
        at = F.least(F.floor((F.col("score") - low) / ((high - low) / BINS)), F.lit(BINS - 1))
        bins = scores.where(F.col("score").between(low, high)).groupBy(at.alias("bin")).agg(
            F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["bin"]):
            if rank < r["n"]:
                low, high = r["low"], r["high"]
                break
            rank -= r["n"]
    up_to, after = scores.agg(F.count(F.when(F.col("score") <= low, 1)), F.min(F.when(F.col("score") > low, F.col("score")))).first()
    if place == first or up_to > first + 1:
        return low
    return (first + 1 - place) * low + (place - first) * after


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           keep: Callable[[DataFrame, str], DataFrame] | None = None, label_id_col: str | None = None) -> DataFrame:
    """``scored`` and ``kept``: the base rules hold and the score reaches the threshold.

    The threshold is a number of the run: the score that ``TRUSTED_KEPT`` of the trusted documents reach
    which pass the base rules. No document's score depends on a model that knows its text as trusted, so the
    threshold means the same for trusted documents and for those without a label. Without trusted documents the
    models differ by nothing and the base rules decide alone. A null or blank text has no words and is not
    kept; a row without id is judged like any other; rows that repeat an id are judged one by one.
    ``label_id_col`` is the column of ``labels`` (that of ``docs`` by default). ``keep`` writes the trusted ids,
    the model and the scores (``common.stored``), so that texts are read three times: to count those of trusted
    ids, to count the others, and to score. The threshold is found when this function is called.
    """
    keep = keep or (lambda df, label: df)
    trusted = keep(trusted_ids(labels, label_id_col or id_col), "trusted")
    found = keep(scored(docs, keep(weights(docs, trusted, id_col, text_col), "weights"), id_col, text_col), "scores")
    good = keep(found.where(~F.col("base_failed")).join(trusted, "id", "left_semi").select("score"), "good")
    least = least_of(good, 1 - TRUSTED_KEPT)
    verdict = ~F.col("base_failed") & (F.col("score") >= (float("-inf") if least is None else least))
    return found.withColumn("kept", F.coalesce(verdict, F.lit(False)))
