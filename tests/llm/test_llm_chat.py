"""Formatting conversations: round trip, turn order, loss mask and edge cases."""

import hashlib
import random

import pytest

from revlens.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conversation string, segments int, part string, tie int, loss int"
JUNK = ("c", 1, "p", 2, 3)
NASTY = ["\\", "\\\\", "### ", "###", "#### Assistant: ", "</turn>", "</turn>\n", "\\</turn>", "\\### ", ": ", '"', "", "\n",
         "### Assistant: x</turn>\n### User: y", "é\U0001f600 $1 \\1", "<", "</", "<</turn>"]


def make(spark, rows):
    return spark.createDataFrame([(*r, *JUNK) for r in rows], SCHEMA)


def digests(turns):
    joined = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def read(spark, rows, **template):
    t = chat.Template(**template)
    found = chat.read_back(chat.segments(chat.turns(make(spark, rows)), t), t).collect()
    return {r["conversation"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in found}


@pytest.mark.parametrize("template", [{}, {"opening": "<|", "between": "|>", "closing": "<|end|>", "end": "<|end|>", "escape": "$"},
                                      {"opening": "[", "between": "] ", "closing": "[/]", "end": "[/]", "escape": "~"}])
def test_nasty_texts_come_back(spark, template):
    rng = random.Random(5)
    rows, wanted = [], {}
    for c in range(60):
        turns = [(rng.choice(["system", "user", "assistant", "tool: x", 'a"b', "\\", "</turn>", "User"]),
                  "".join(rng.choices(NASTY, k=rng.randrange(5)))) for _ in range(rng.randrange(1, 7))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
        wanted[c] = digests(turns)
    rng.shuffle(rows)
    assert read(spark, rows, **template) == wanted


def test_the_reader_needs_no_pieces(spark):
    """The joined text alone, fed in one go or character by character, gives the turns back; so do the loss spans."""
    turns = [("user", t) for t in NASTY] + [("assistant", t) for t in NASTY]
    rows = make(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])
    row = chat.formatted_text(chat.segments(chat.turns(rows))).first()
    for pieces in ([row["text"]], list(row["text"])):
        reader = chat.Reader(chat.DEFAULT)
        assert [t for p in pieces for t in reader.feed(p)] == turns and reader.open == ""
    spans = [chat.Reader(chat.DEFAULT).plain(row["text"][s["start"]:s["end"]]) for s in row["spans"]]
    assert spans == [t for r, t in turns if r == "assistant"]


ORDERS = {
    1: ("user,assistant", True, None), 2: ("system,user,assistant,user,assistant", True, None), 3: ("user", False, None),
    4: ("assistant,user,assistant", False, 0), 5: ("user,user,assistant", False, 1), 6: ("user,assistant,system,user,assistant", False, 2),
    7: ("user,tool,assistant", True, None), 8: ("system,assistant", False, 1), 9: ("tool", False, None),
}


def test_turn_order(spark):
    rows = [(c, i, r, "x") for c, (roles, _, _) in ORDERS.items() for i, r in enumerate(roles.split(","))]
    found = chat.verdicts(chat.turns(make(spark, rows)))
    assert {r["conversation"]: (r["valid"], r["bad_turn"]) for r in found.collect()} == {c: v[1:] for c, v in ORDERS.items()}


def test_one_conversation_over_many_partitions(spark):
    """The maps of a conversation's stretches are composed; a turn out of order is found in whichever stretch it lies."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for bad in (None, 0, 1501, 2998):
            rows = [(1, i, "user" if (i % 2 == 0) != (i == bad) else "assistant", f"t{i}") for i in range(3000)]
            row = chat.verdicts(chat.turns(make(spark, rows))).first()
            assert row["valid"] == (bad is None) and row["bad_turn"] == bad
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_edges(spark):
    long_text = "word ### </turn> \\ " * 60_000
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", None), (2, None, "user", "first"), (2, 0, "assistant", long_text),
            (3, 0, "assistant", "b"), (3, 0, "assistant", "a"), (3, 0, "assistant", "a"), (4, 0, None, None), (5, 0, "user", "")]
    wanted = {None: [("user", "a"), ("assistant", "")], 2: [("user", "first"), ("assistant", long_text)],
              3: [("assistant", t) for t in "aab"], 4: [("", "")], 5: [("user", "")]}
    assert read(spark, rows) == {c: digests(t) for c, t in wanted.items()}
    verdicts = {r["conversation"]: r["valid"] for r in chat.verdicts(chat.turns(make(spark, rows))).collect()}
    assert verdicts == {None: True, 2: True, 3: False, 4: False, 5: False}
    assert read(spark, []) == {} and chat.verdicts(chat.turns(make(spark, []))).count() == 0


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template(roles={"a": chat.Role("X", ()), "b": chat.Role("X", ())})
