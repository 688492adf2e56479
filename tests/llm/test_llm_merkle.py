"""Manifest trees against a plain recursive hash, proofs and folds, and edge cases."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from revlens.llm import merkle, midstates

SCHEMA = "doc_id bigint, source string, text string, tree string, place int, leaf string, deal int, level string, base int"
JUNK = ("t", 1, "l", 2, "v", 3)


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def walk(levels, place):
    """(siblings, left and right ones by level) of a leaf."""
    steps = []
    for level in levels[:-1]:
        run = level[place // 3 * 3:place // 3 * 3 + 3]
        steps.append((run[:place % 3], run[place % 3 + 1:]))
        place //= 3
    return steps


def brute(rows, shown):
    """Sorted (id, leaf, subroot, root, proof, folded) of rows (id, source, text), by plain recursion."""
    groups = {}
    for i, source, text in rows:
        leaf = h(field(i), field(source), field(text))
        groups.setdefault(source, []).append((i is not None, i or 0, leaf, i, h(field(i), field(source), field(shown(i, text)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([r[2] for r in sorted(groups[s], key=lambda r: r[:3])]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for place, (_, _, leaf, i, other) in enumerate(sorted(groups[s], key=lambda r: r[:3])):
            steps = walk(trees[s], place) + walk(top, k)
            now = other
            for left, right in steps:
                now = h(*left, now, *right)
            out.append((i, leaf, trees[s][-1][0], top[-1][0], h(*[x for a, b in steps for x in a + b]), now))
    return sorted(out, key=str)


def run(spark, rows, shown=lambda text: F.translate(text, "\n", "")):
    docs = spark.createDataFrame([(*r, *JUNK) for r in rows], SCHEMA)
    head = [F.col("doc_id"), F.col("source")]
    found = merkle.manifest(docs, merkle.leaf(*head, F.col("text")), "source", "doc_id",
                            doc_id=F.col("doc_id"), shown=merkle.leaf(*head, shown(F.col("text"))))
    digests = merkle.fold(found, "shown").select("doc_id", *[F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")])
    return found, sorted(map(tuple, digests.collect()), key=str)


def bare(i, text):
    return None if text is None else text.replace("\n", "")


@pytest.mark.parametrize("blocks", [0, 1, 3, 7])
def test_states_equal_hashlib(blocks):
    messages = [random.Random(i).randbytes(64 * blocks) for i in range(50)]
    states = midstates.start(50)
    for k in range(blocks):
        part = np.frombuffer(b"".join(m[64 * k:64 * k + 64] for m in messages), "u1").reshape(-1, 64)
        kept = midstates.as_bytes(states)
        states = midstates.absorb(midstates.from_bytes(kept), part)
    digests = midstates.finish(states, np.full(50, blocks))
    assert [d.tobytes() for d in digests] == [hashlib.sha256(m).digest() for m in messages]


def test_trees_and_folds(spark):
    rng = random.Random(3)
    rows = [(i, f"s{rng.randrange(40) if i % 3 else 0}", "a\nb" * rng.randrange(4) + str(i)) for i in range(1500)]
    assert run(spark, rows)[1] == brute(rows, bare)


def test_more_levels_than_a_block(spark, monkeypatch):
    """Blocks of nine: the upper levels come in more rounds, also in the tree over the groups."""
    monkeypatch.setattr(merkle, "STEPS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    monkeypatch.setattr(merkle, "DEAL_ROWS", 64)
    rows = [(i, "big" if i % 2 else f"é{i % 61}", f"text {i}\n") for i in range(700)]
    assert run(spark, rows)[1] == brute(rows, bare)


def test_kept_states_are_prefix_hashes(spark):
    found, _ = run(spark, [(i, "s", f"t{i}") for i in range(5)])
    for node in found.nodes.collect():
        children = [bytes(node["children"][32 * k:32 * k + 32]) for k in range(node["width"])]
        assert hashlib.sha256("".join(c.hex() for c in children).encode()).digest() == bytes(node["digest"])
        state = midstates.start(1)
        for k, child in enumerate(children):
            assert midstates.as_bytes(state).tobytes() == bytes(node["states"][32 * k:32 * k + 32])
            state = midstates.absorb(state, np.frombuffer(child.hex().encode(), "u1").reshape(1, 64))


def test_edges(spark):
    long_text = "line of a very long text\n" * 40_000
    rows = [(1, None, None), (2, None, ""), (None, "a", "no id\n"), (None, "a", "no id\n"), (None, "a", "other"), (4, "a", "é\n\U0001f600"),
            (4, "a", "é\n\U0001f600"), (4, "a", "same id"), (5, "b", long_text), (6, "", "\n\n")]
    assert run(spark, rows)[1] == brute(rows, bare)


def test_one_row_and_none(spark):
    (row,) = run(spark, [(1, "a", "x\ny")])[1]
    assert row[1] == row[2] == row[3] and row[4] == h() and row[5] != row[3]
    assert run(spark, [])[1] == []
    assert run(spark, [])[0].nodes.count() == 0
