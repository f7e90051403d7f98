import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import quotes
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """Links, threads and places of ``{(conv, turn): text}``, message by message."""
    own = {k: {u for level, u in quotes.passages(t)[1] if level == 0} for k, t in rows.items()}
    out = {}
    for conv, turn in sorted(rows):
        votes, quoted = {}, set()
        for level, unit in quotes.passages(rows[conv, turn])[1]:
            held = [k for c, k in rows if level and c == conv and k < turn and unit in own[c, k]]
            if held:
                quoted.add((level, max(held)))
                if level == 1:
                    votes[max(held)] = votes.get(max(held), 0) + unit.count(" ") + 1
        up = max(votes, key=lambda k: (votes[k], k)) if votes else None
        thread, depth = (out[conv, up][2], out[conv, up][3] + 1) if up is not None else (turn, 0)
        position = sum(1 for (c, k), o in out.items() if c == conv and o[2] == thread)
        out[conv, turn] = (up, sorted(quoted), thread, depth, position)
    return out


def test_levels():
    assert quotes.level_and_words("> > a > b") == (2, "a > b")
    assert quotes.level_and_words(">>>x") == (3, "x") and quotes.level_and_words(">") == (1, "")
    assert quotes.level_and_words("  plain ") == (0, "  plain ") and quotes.level_and_words("1 > 0") == (0, "1 > 0")


def test_passages():
    text = "Ann wrote:\n> Bob wrote:\n>> deep  Words\n>> more\n>\n> mid\n\nI said:\nown words\nsecond\n\n\n\nlast"
    own, found = quotes.passages(text)
    assert own == "I said:\nown words\nsecond\n\nlast"
    assert found == [(2, "deep words more"), (2, "deep words"), (2, "more"), (1, "mid"), (0, "i said: own words second"), (0, "i said:"),
                     (0, "own words"), (0, "second"), (0, "last")]
    assert quotes.passages(None) == ("", []) and quotes.passages(" \n> \n") == (" ", [])


def test_query_equals_brute_force(spark, small):
    mails = {(r.conv_id, r.turn): r.text for r in quotes.as_mails(table(spark, small, "conversations")).collect()}
    plain = {(r.conv_id, r.turn): r.text for r in table(spark, small, "conversations").collect()}
    got = {(r.conv_id, r.turn): r for r in QUERIES["op9_quotation_linking"](spark, small).collect()}
    want = by_hand(mails)
    assert {k: (r.reply_to, r.thread, r.depth, r.position, r.n_quoted) for k, r in got.items()} == {
        k: (up, thread, depth, place, len(quoted)) for k, (up, quoted, thread, depth, place) in want.items()}
    assert {k: r.text for k, r in got.items()} == plain
    assert sum(r.reply_to in (r.turn - 1, r.turn - 2) for r in got.values()) > 0.95 * sum(t > 0 for _, t in got)
    assert any(r.reply_to == r.turn - 2 for r in got.values())


@pytest.mark.parametrize("span", [1, 4, 1024])
def test_long_conversations_with_common_passages(spark, monkeypatch, span):
    monkeypatch.setattr(quotes, "SPAN", span)
    rng, rows = random.Random(span), {}
    for conv in (1, 2):
        for turn in range(40):
            said = rng.choice(["thanks", f"words of {conv} {turn}", f"line {turn}\nthanks"])
            up = rng.randrange(turn) if turn and rng.random() < 0.8 else None
            quoted = "" if up is None else "x wrote:\n" + "\n".join("> " + x for x in rows[conv, up].split("\n")) + "\n\n"
            rows[conv, turn] = quoted + said
    df = spark.createDataFrame([(c, t, "r", x) for (c, t), x in rows.items()], SCHEMA)
    got = {(r.conv, r.turn): (r.reply_to, [tuple(q) for q in r.quoted or []], r.thread, r.depth, r.position) for r in quotes.conversations(df).collect()}
    assert got == by_hand(rows) and max(g[3] for g in got.values()) > 3


def test_edge_rows(spark):
    rows = [(1, 0, "a", "hello there"), (1, 1, None, "> Hello   THERE\nhi"), (1, 1, None, "> Hello   THERE\nhi"), (1, 2, "a", None), (1, 3, "a", ""),
            (None, 4, "a", "> hello there"), (2, None, "b", "> hello there\nx"), (2, 0, "b", "> hello there"), (1, 5, "a", "> nobody said\nso"),
            (3, 0, "a", "w " * 40_000), (3, 1, "b", "> " + "w " * 40_000 + "\nyes")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", span long, own string")
    got = sorted(((r.conv or 0, r.turn if r.turn is not None else -1, r.reply_to, r.thread, r.depth, r.position, r.text[:9]) for r in quotes.conversations(df).collect()), key=repr)
    assert got == sorted([
        (1, 0, None, 0, 0, 0, "hello the"), (1, 1, 0, 0, 1, 1, "hi"), (1, 1, 0, 0, 1, 2, "hi"), (1, 2, None, 2, 0, 0, ""), (1, 3, None, 3, 0, 0, ""),
        (0, 4, None, None, 0, None, ""), (2, -1, None, None, 0, None, "x"), (2, 0, None, 0, 0, 0, ""), (1, 5, None, 5, 0, 0, "so"),
        (3, 0, None, 0, 0, 0, "w w w w w"), (3, 1, 0, 0, 1, 1, "yes")], key=repr)
    assert quotes.conversations(df.limit(0)).count() == 0


def test_mails(spark):
    df = spark.createDataFrame([(1, 0, "a", "x\ny"), (1, 1, "b", "z")], SCHEMA)
    got = {r.turn: r.text for r in quotes.as_mails(df).orderBy(F.col("turn")).collect()}
    assert got == {0: "x\ny", 1: "a wrote:\n> x\n> y\n\nz"}


def test_rows_that_repeat_a_turn_become_one_mail_each(spark):
    rows = [(1, t, "user", f"text {t} {c}") for t in range(4) for c in range(5)] + [(1, 2, None, None), (None, 1, "user", "x"), (2, None, "user", "y")]
    mails = quotes.as_mails(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(mails) == len(rows)
    assert sorted(m.text.split("\n")[-1] for m in mails) == sorted(r[3] or "" for r in rows)
    assert {m.text for m in mails if m.conv_id == 1 and m.turn == 1 and m.text.endswith("1 4")} == {"user wrote:\n> text 0 0\n\ntext 1 4"}
    assert {m.text for m in mails if m.conv_id != 1} == {"x", "y"}
