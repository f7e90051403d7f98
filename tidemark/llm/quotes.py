"""Quotation linking: quoted passages find the messages they come from, and conversations their reply order."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Turns of a conversation that are looked at in one task.
SPAN = 1024
_MARK = re.compile(r"[ \t]?>")
# Lines that only say whose words follow.
_SAYS = re.compile(r"(on\b.*\bwrote|.{0,80}\bwr(ote|ites)|am\b.*\bschrieb\b.*|le\b.*\ba écrit|el\b.*\bescribió)\s*:\s*", re.IGNORECASE)


def level_and_words(line: str) -> tuple[int, str]:
    """How often a line is quoted (``> >`` and ``>>`` are twice) and what is left without the marks."""
    at = level = 0
    while found := _MARK.match(line, at):
        at, level = found.end(), level + 1
    return level, line[at:].strip() if level else line


def passages(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes, and its passages ``(level, normalised words)``.

    A passage is a run of lines of one level without a blank line; its lines are passages as well, so a
    quote that left lines out is found again. Normalised means lower case and single blanks. A line that
    only says whose words follow, right before lines of the next level, belongs to no passage.
    """
    lines = [level_and_words(x) for x in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    kept: list[tuple[int, str]] = []
    following = 0  # level of the next line that is not blank
    for level, words in reversed(lines):
        if words.strip():
            says = following == level + 1 and _SAYS.fullmatch(words.strip())
            following = level
            if says:
                continue
        kept.append((level, words))
    kept.reverse()
    found: dict[tuple[int, str], None] = {}
    run: list[str] = []
    at = 0
    for level, words in [*kept, (-1, "")]:
        if run and (level != at or not words.strip()):
            for unit in (" ".join(run), *run):
                found[at, unit] = None
            run = []
        at = level
        if words.strip():
            run.append(" ".join(words.lower().split()))
    own = re.sub(r"\n{3,}", "\n\n", "\n".join(words for level, words in kept if level == 0)).strip("\n")
    return own, list(found)


def _parsed(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, own`` and ``units``: a struct of level, hash and number of words for each passage."""
    unit = pa.struct([("level", pa.int32()), ("passage", pa.binary()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [passages(t) for t in batch.column(3).to_pylist()]
            units = [[(level, xxhash.xxh3_128_digest(words), words.count(" ") + 1) for level, words in p] for _, p in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([own for own, _ in found], pa.string()), pa.array(units, pa.list_(unit))],
                names=["conv", "turn", "role", "own", "units"])
    return rows.mapInArrow(run, "conv long, turn long, role string, own string, units array<struct<level:int,passage:binary,words:long>>")


def _span(turn: Column) -> Column:
    return F.floor(turn / SPAN)


def _sources(units: DataFrame) -> DataFrame:
    """Quoted units with ``source``: the last earlier turn of the conversation whose own words hold the passage.

    A passage that very many turns hold is looked up span by span; what earlier spans hold comes from one
    row for each of them.
    """
    own = F.when(F.col("level") == 0, F.col("turn"))
    units = units.withColumn("span", _span(F.col("turn")))
    here = Window.partitionBy("conv", "passage", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = units.withColumn("near", F.max(own).over(here)).where("level > 0")
    spans = units.groupBy("conv", "passage", "span").agg(F.max(own).alias("last"))
    before = Window.partitionBy("conv", "passage").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("far", F.max("last").over(before)).where("far is not null").drop("last")
    return near.join(spans, ["conv", "passage", "span"], "left").withColumn("source", F.coalesce("near", "far")).where("source is not null")


def _threads(parents: DataFrame) -> DataFrame:
    """``conv, turn, thread, depth`` of the turns that reply to something, by doubling the way up."""
    now = stored(parents.select("conv", "turn", F.col("reply_to").alias("up"), F.lit(1).cast("long").alias("depth")), "replies")
    while True:
        above = now.select("conv", F.col("turn").alias("up"), F.col("up").alias("above"), F.col("depth").alias("more"))
        joined = now.join(above, ["conv", "up"], "left")
        if joined.where("above is not null").isEmpty():
            return now.withColumnRenamed("up", "thread")
        now = stored(joined.select("conv", "turn", F.coalesce("above", "up").alias("up"),
                                   (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "replies")


def conversations(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``(conv, turn, role, text, reply_to, quoted, thread, depth, position)``: messages without quotes, in order of replies.

    Quoted lines are parsed into passages with their level; a passage is joined by the hash of its
    normalised words to the own words of earlier messages of its conversation, the latest one if several
    hold it. A message replies to the turn that most of its words quoted once come from (ties: the later
    turn); ``quoted`` lists all turns that it quotes, with the level. ``thread`` is the first message above
    it, ``depth`` the number of replies up to there, ``position`` its place in its thread, where a reply
    stands behind what it replies to.

    A message that quotes nothing known begins a thread. Null and blank texts have no words. Rows without
    conversation or turn are kept without links, thread and position. Rows that repeat a turn share its
    links and have places of their own. Empty tables give no rows.
    """
    rows = messages.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                           F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text"))
    parsed = stored(_parsed(rows), "messages")
    placed = parsed.where("conv is not null and turn is not null")
    units = placed.select("conv", "turn", F.explode("units").alias("unit")).select("conv", "turn", "unit.*").distinct()
    links = stored(_sources(units).groupBy("conv", "turn", "level", "source").agg(F.sum("words").alias("words")), "links")
    parents = links.where("level = 1").groupBy("conv", "turn").agg(F.max(F.struct("words", "source"))["source"].alias("reply_to"))
    quoted = links.groupBy("conv", "turn").agg(F.array_sort(F.collect_list(F.struct("level", "source"))).alias("quoted"))
    found = quoted.join(parents, ["conv", "turn"], "left").join(_threads(parents), ["conv", "turn"], "left")
    linked = placed.select("conv", "turn", "role", F.col("own").alias("text")).join(found, ["conv", "turn"], "left").select(
        "conv", "turn", "role", "text", "reply_to", "quoted", F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))
    linked = linked.withColumn("span", _span(F.col("turn")))
    # A place is counted in its span of the thread, behind what earlier spans hold.
    held = linked.groupBy("conv", "thread", "span").count()
    before = Window.partitionBy("conv", "thread").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    here = Window.partitionBy("conv", "thread", "span").orderBy("turn", "role", "text")
    ordered = linked.withColumn("nth", F.row_number().over(here)).join(held, ["conv", "thread", "span"]).withColumn(
        "position", (F.col("before") + F.col("nth") - 1).cast("long")).drop("span", "nth", "before")
    lost = parsed.where("conv is null or turn is null").select(
        "conv", "turn", "role", F.col("own").alias("text"), F.lit(None).cast("long").alias("reply_to"),
        F.lit(None).cast("array<struct<level:int,source:bigint>>").alias("quoted"), F.lit(None).cast("long").alias("thread"),
        F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("position"))
    columns = ["conv", "turn", "role", "text", "reply_to", "quoted", "thread", "depth", "position"]
    return ordered.select(columns).unionByName(lost.select(columns))


def as_mails(messages: DataFrame) -> DataFrame:
    """The messages as a mail program would send them: each quotes the message that it replies to, and that
    one's quote. A turn replies to the turn before it, every fourth (by hash) to the one before that.

    Every row becomes one mail. Where rows repeat a turn, the first of them by role and text (nulls first) is the
    one that is quoted. Rows without conversation or turn quote nothing and are not quoted.
    """
    far = (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0) & (F.col("turn") > 1)
    own = messages.select("conv_id", "turn", "role", "text", F.when(far, F.col("turn") - 2).otherwise(F.col("turn") - 1).alias("up"))
    said = own.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(F.struct("role", "text", "up")).alias("first")).select("conv_id", "turn", "first.*")
    above = said.select("conv_id", F.col("turn").alias("up"), F.col("role").alias("up_role"), F.col("text").alias("up_text"), F.col("up").alias("top"))
    top = said.select("conv_id", F.col("turn").alias("top"), F.col("role").alias("top_role"), F.col("text").alias("top_text"))

    def quote(text: Column) -> Column:
        return F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))

    inner = F.concat(F.coalesce(F.concat("top_role", F.lit(" wrote:\n"), quote(F.col("top_text")), F.lit("\n\n")), F.lit("")), F.col("up_text"))
    outer = F.coalesce(F.concat("up_role", F.lit(" wrote:\n"), quote(inner), F.lit("\n\n")), F.lit(""))
    return own.join(above, ["conv_id", "up"], "left").join(top, ["conv_id", "top"], "left").select(
        "conv_id", "turn", "role", F.concat(outer, F.coalesce("text", F.lit(""))).alias("text"))
