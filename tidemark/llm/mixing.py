"""Mixing overlapping sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A pattern is a set of sources that some documents belong to. More patterns than this are refused.
MOST_PATTERNS = 20_000
#: Rows that a round of the threshold search brings to the driver, at most.
_BINS = 1 << 16
_BITS = 62


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
            most: int = 2) -> dict[str | None, Fraction]:
    """How many words each source should give.

    Sources in order of code points, null last, have the weights in turn and share ``share`` of all sizes.
    A target stops at ``most`` times its source's size; what is too much is shared again by weight among
    the others, until no target is too high.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: Fraction(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, free, out = Fraction(share) * sum(sizes.values()), set(order), {}
    while free:
        whole = sum(weight[s] for s in free)
        full = {s for s in free if not whole or left * weight[s] / whole > most * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / whole for s in free}
        out |= {s: Fraction(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        free -= full
    return out


def route(words: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], most: int = 2) -> list[dict[int, int]]:
    """Min-cost flow of pattern words into source quotas: ``{source: words}`` for each pattern.

    A pattern gives its words once at cost 1, a second time at cost 2 and so on, up to ``most`` times, to
    sources its documents belong to. Costs stand only on the arcs out of the flow's origin, so shortest
    augmenting paths use the cheap arcs up before the next dearer ones: a maximum flow is found with the
    first repetition, then continued with the second. The flow is a maximum one, and the cheapest of those.
    """
    p, flow, room = len(words), [{} for _ in words], list(quotas)
    givers: list[set[int]] = [set() for _ in quotas]  # patterns that give to a source
    for _ in range(most):
        spare = list(words)
        progress = True
        while progress:
            progress = False
            # Levels from the patterns with words to spare, over sources, back over patterns that could give elsewhere.
            came: dict[tuple[str, int], tuple[str, int] | None] = {("p", i): None for i in range(p) if spare[i] > 0}
            queue, end = deque(came), None
            while queue and end is None:
                kind, i = at = queue.popleft()
                for nxt in ([("s", s) for s in members[i]] if kind == "p" else [("p", q) for q in sorted(givers[i])]):
                    if nxt not in came:
                        came[nxt] = at
                        if nxt[0] == "s" and room[nxt[1]] > 0:
                            end = nxt
                            break
                        queue.append(nxt)
            if end is not None:
                path, at = [end], came[end]
                while at is not None:
                    path.append(at)
                    at = came[at]
                path.reverse()
                moved = min([spare[path[0][1]], room[end[1]]] + [flow[path[k][1]][path[k - 1][1]] for k in range(2, len(path), 2)])
                for k in range(0, len(path) - 1, 2):
                    i, s = path[k][1], path[k + 1][1]
                    flow[i][s] = flow[i].get(s, 0) + moved
                    givers[s].add(i)
                    if k:
                        before = path[k - 1][1]
                        flow[i][before] -= moved
                        if not flow[i][before]:
                            del flow[i][before]
                            givers[before].discard(i)
                spare[path[0][1]] -= moved
                room[end[1]] -= moved
                progress = True
    return flow


@dataclass
class Mix:
    """``patterns`` has a row for each pattern: ``(pattern, times, below, source_size, target)``."""

    patterns: DataFrame
    sizes: dict[str | None, int]
    targets: dict[str | None, Fraction]
    source_col: str
    id_col: str
    text_col: str
    seed: int


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _pattern(docs: DataFrame, source_col: str) -> Column:
    """The set of sources of a row as text; a plain column is a set of one."""
    kind = dict(docs.dtypes)[source_col]
    column = docs[source_col]
    members = F.array_sort(F.array_distinct(column)) if kind.startswith("array") else F.array(column.cast("string"))
    return F.to_json(F.coalesce(members, F.array(F.lit(None).cast("string"))))


def _draw(id_col: Column, text_col: Column, seed: int) -> Column:
    """A row's place in its pattern's seeded order, in [0, 2**62)."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text_col), 64 - _BITS)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep=None) -> Mix:
    """How often the documents of each pattern of sources are taken so that sources reach their targets.

    ``source_col`` is a source or an array of them; documents with the same set are a pattern. The words of
    a pattern flow into the targets of its sources (``route``), no more than ``most`` times over. Of what a
    pattern gives, all its documents are taken the whole number of times, and the rest is made up by one
    more turn of the documents that come first in a seeded order, up to the place where the sum of their
    words is nearest to it. That place is found by counting words in ever finer bins of the order, so
    nothing is sorted and no pattern meets in one task.

    Sizes are words of whole texts; a null text has none. A null source, or an empty or null array, is a
    source of its own. Rows equal in id and text are taken alike. Empty tables give an empty mix.
    ``keep`` writes the narrow table of sizes for the rounds of the search (``common.stored``).
    """
    narrow = docs.select(_pattern(docs, source_col).alias("pattern"), n_words(docs[text_col]).alias("size"),
                         _draw(docs[id_col], docs[text_col], seed).alias("draw"))
    narrow = keep(narrow, "sizes") if keep else narrow
    found = narrow.groupBy("pattern").agg(F.sum("size").alias("words")).orderBy("pattern").limit(MOST_PATTERNS + 1).collect()
    if len(found) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} sets of sources: join rare sources before mixing")
    parsed = narrow.sparkSession.createDataFrame([(r["pattern"],) for r in found], "pattern string").select(
        "pattern", F.from_json("pattern", "array<string>").alias("members")).collect()
    of = {r["pattern"]: r["members"] or [None] for r in parsed}
    names, words = [r["pattern"] for r in found], [r["words"] for r in found]
    sizes: dict[str | None, int] = {}
    for name, n in zip(names, words):
        for s in of[name]:
            sizes[s] = sizes.get(s, 0) + n
    wanted = targets(sizes, weights, share, most)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(order)}
    flow = route(words, [[at[s] for s in of[name]] for name in names], [round(wanted[s]) for s in order], most)
    gives = [sum(f.values()) for f in flow]
    times = [g // n if n else 0 for g, n in zip(gives, words)]
    rest = {name: g - t * n for name, g, t, n in zip(names, gives, times, words)}
    below = _places(narrow, {k: r for k, r in rest.items() if r})
    rows = [(name, t, below.get(name, 0), sizes[of[name][0]], float(wanted[of[name][0]])) for name, t in zip(names, times)]
    patterns = narrow.sparkSession.createDataFrame(rows, "pattern string, times long, below long, source_size long, target double")
    return Mix(patterns, sizes, wanted, source_col, id_col, text_col, seed)


def _places(narrow: DataFrame, rest: dict[str, int]) -> dict[str, int]:
    """For each pattern, the place in its order below which the words come nearest to ``rest``."""
    spark, done = narrow.sparkSession, {}
    open_ = {k: (0, 1 << _BITS, r) for k, r in rest.items()}  # [from, to) and the words still wanted from there on
    while open_:
        bins = max(16, _BINS // len(open_))
        rows = [(k, lo, hi, max(1, -(-(hi - lo) // bins))) for k, (lo, hi, _) in open_.items()]
        spans = spark.createDataFrame(rows, "pattern string, lo long, hi long, step long")
        counted = narrow.join(F.broadcast(spans), "pattern").where("draw >= lo and draw < hi").groupBy(
            "pattern", F.expr("lo + (draw - lo) div step * step").alias("start")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.min("draw").alias("first"), F.max("draw").alias("last"))
        by: dict[str, list] = {}
        for r in counted.collect():
            by.setdefault(r["pattern"], []).append(r)
        for k, (_, hi, wanted) in list(open_.items()):
            for r in sorted(by[k], key=lambda r: r["start"]):
                if r["words"] > wanted:
                    if r["first"] == r["last"]:  # one place in the order: in or out, whichever is nearer
                        done[k] = r["first"] + 1 if r["words"] - wanted < wanted else r["first"]
                    else:
                        open_[k] = (r["first"], r["last"] + 1, wanted)
                    break
                wanted -= r["words"]
            else:
                done[k] = hi
        open_ = {k: v for k, v in open_.items() if k not in done}
    return done


def taken(docs: DataFrame, mixed: Mix, times_col: str = "times") -> DataFrame:
    """``docs`` and a column that says how often the mix takes each row. The patterns are broadcast
    (``MOST_PATTERNS`` at most); rows are neither moved nor sorted. A column of that name is replaced."""
    kept = [c for c in docs.columns if c != times_col]
    own, name, times, below = (f"{'_' * max(map(len, docs.columns))}{x}" for x in ("own", "pattern", "times", "below"))  # unused names
    plan = mixed.patterns.select(F.col("pattern").alias(name), F.col("times").alias(times), F.col("below").alias(below))
    rows = docs.withColumn(own, _pattern(docs, mixed.source_col))
    turn = F.when(_draw(docs[mixed.id_col], docs[mixed.text_col], mixed.seed) < F.col(below), 1).otherwise(0)
    joined = rows.join(F.broadcast(plan), F.col(own) == F.col(name))
    return joined.select(*(docs[c] for c in kept), (F.col(times) + turn).cast("long").alias(times_col))


def mixed_rows(docs: DataFrame, mixed: Mix) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all their columns unchanged."""
    times = "_" * max(map(len, docs.columns)) + "times"
    rows = taken(docs, mixed, times)
    return rows.withColumn(times, F.explode(F.array_repeat(F.lit(True), F.col(times).cast("int")))).select(docs.columns)
