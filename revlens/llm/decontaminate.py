"""Benchmark passages in documents, also with their sentences reordered, by greedy string tiling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from revlens.llm.text import checked_broadcast, narrow
from revlens.session import staged

PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
HASH_PRIME, HASH_BASE = (1 << 61) - 1, 1_000_003


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII spaces, A-Z lower-cased, without ASCII punctuation."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(None, PUNCTUATION).split()


def seed_hashes(words: list[bytes], size: int, step: int) -> list[int]:
    """Signed XXH64 of the runs of `size` words that start at every `step`-th word."""
    import xxhash

    spaced = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(0, len(words) - size + 1)
    pieces = zip(starts[:n:step].tolist(), ends[size - 1::step].tolist())
    return np.array([xxhash.xxh64_intdigest(spaced[a:b]) for a, b in pieces], np.uint64).view(np.int64).tolist()


def _free_runs(values: list[int], marked: bytearray, least: int) -> list[tuple[int, int]]:
    """[start, end) of stretches of at least `least` unmarked, known tokens."""
    runs, start = [], None
    for i in range(len(values) + 1):
        free = i < len(values) and values[i] >= 0 and not marked[i]
        if free and start is None:
            start = i
        elif not free and start is not None:
            if i - start >= least:
                runs.append((start, i))
            start = None
    return runs


def _window_hashes(values: list[int], runs: list[tuple[int, int]], size: int) -> Iterator[tuple[int, int]]:
    """(start, Karp-Rabin hash) of every window of `size` tokens, the hash rolled from one to the next."""
    lead = pow(HASH_BASE, size - 1, HASH_PRIME)
    for start, end in runs:
        h = 0
        for v in values[start:start + size]:
            h = (h * HASH_BASE + v + 1) % HASH_PRIME
        yield start, h
        for i in range(start, end - size):
            h = ((h - (values[i] + 1) * lead) * HASH_BASE + values[i + size] + 1) % HASH_PRIME
            yield i + 1, h


def tile(doc: list[bytes], test: list[bytes], min_match: int) -> list[tuple[int, int, int]]:
    """Non-overlapping (doc start, test start, length), each the longest still to be had, of `min_match` words or more.

    Matches of at least `size` words are found by rolling hashes over unmarked words. When one
    is more than twice as long, the search starts again at its length; otherwise all are marked,
    longest first, and the size is halved down to `min_match`. Of equally long matches the first
    in the document, then in the test, goes first.
    """
    names: dict[bytes, int] = {}
    right = [names.setdefault(w, len(names)) for w in test]
    left = [names.get(w, -1) for w in doc]
    done_left, done_right, found = bytearray(len(left)), bytearray(len(right)), []
    size = max(min_match, len(test) // 2)
    while True:
        table: dict[int, list[int]] = {}
        for at, h in _window_hashes(right, _free_runs(right, done_right, size), size):
            table.setdefault(h, []).append(at)
        matches, longest = [], 0
        for at, h in _window_hashes(left, _free_runs(left, done_left, size), size):
            for other in table.get(h, ()):
                n = 0
                while (at + n < len(left) and other + n < len(right) and left[at + n] == right[other + n]
                       and not done_left[at + n] and not done_right[other + n]):
                    n += 1
                if n >= size:
                    matches.append((n, at, other))
                    longest = max(longest, n)
        if longest > 2 * size:
            size = longest
            continue
        queue = sorted(matches, key=lambda m: (-m[0], m[1], m[2]))
        while queue:
            n, at, other = queue.pop(0)
            free = 0
            while free < n and not done_left[at + free] and not done_right[other + free]:
                free += 1
            if free < n:  # a longer tile took its tail or all of it
                if free >= size:
                    queue.append((free, at, other))
                    queue.sort(key=lambda m: (-m[0], m[1], m[2]))
                continue
            done_left[at:at + n] = done_right[other:other + n] = b"\1" * n
            found.append((at, other, n))
        if size == min_match:
            return found
        size = max(min_match, size // 2)


def candidates(docs: DataFrame, tests: DataFrame, min_match: int, seed: int) -> DataFrame:
    """Distinct (doc, item) that share a seed, a run of words so placed that no match is missed.

    Tests give every run of `seed` words, documents those at each `min_match - seed + 1`-th word: any
    match of `min_match` words holds one. A test shorter than `min_match` gives itself as one
    seed, looked up at every word; only such lengths as occur are taken.
    """
    step = min_match - seed + 1

    @F.pandas_udf("array<bigint>")
    def test_seeds(texts: pd.Series) -> pd.Series:
        return pd.Series([seed_hashes(w, seed if len(w) >= min_match else max(len(w), 1), 1) for w in map(tokens, texts)])

    @F.pandas_udf("int")
    def size(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: len(tokens(t)))

    short = [r[0] for r in tests.select(size("text").alias("n")).where((F.col("n") > 0) & (F.col("n") < min_match)).distinct().collect()]

    @F.pandas_udf("array<bigint>")
    def doc_seeds(texts: pd.Series) -> pd.Series:
        def of(words: list[bytes]) -> list[int]:
            found = seed_hashes(words, seed, step)
            for n in short:
                found += seed_hashes(words, n, 1)
            return found

        return pd.Series([of(tokens(t)) for t in texts])

    seeds = staged(tests.select("item", F.explode(test_seeds("text")).alias("seed")).distinct(), "seeds")
    rows = docs.select("doc", F.explode(doc_seeds("text")).alias("seed"))
    return rows.join(checked_broadcast(seeds, 500_000), "seed").select("doc", "item").distinct()


def leaks(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text", min_match: int = 8, seed: int = 5,
          threshold: float = 0.5) -> DataFrame:
    """(doc, item, n_tokens, covered, coverage, n_tiles, longest) of each document that holds a test.

    Tests and documents that share a seed are tiled against each other; `coverage` is the part
    of the test's words in tiles, in whatever order the document has them, and pairs below
    `threshold` are left out. A test of fewer words than `min_match` must occur as a whole.
    Only documents with a candidate are read a second time; the table of candidates is broadcast
    only if a count finds it small. Texts stream through a pair at a time, so a task holds one
    batch, and a test that very many documents share is split like any skewed join key.

    Null and empty texts, tests without words, and rows without id match nothing. Rows that
    repeat an id are one document: a test counts with its best row. No tests or no documents
    give no rows.
    """
    rows = narrow(docs, doc=id_col, text=text_col).where("doc is not null and text is not null")
    items = narrow(tests, item=item_col, text=item_text).where("item is not null and text is not null")
    pairs = staged(candidates(rows, items, min_match, seed), "candidates")
    whole = rows.join(checked_broadcast(pairs, 200_000), "doc").join(
        items.withColumnRenamed("text", "test"), "item").select("doc", "item", "text", "test")

    def tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, last, words = [], None, []
            for doc, item, text, test in zip(batch["doc"], batch["item"], batch["text"], batch["test"]):
                if text is not last:
                    last, words = text, tokens(text)
                wanted = tokens(test)
                if not wanted:
                    continue
                found = tile(words, wanted, min(min_match, len(wanted)))
                covered = sum(n for _, _, n in found)
                out.append((doc, item, len(wanted), covered, covered / len(wanted), len(found),
                            max((n for _, _, n in found), default=0)))
            yield pd.DataFrame(out, columns=["doc", "item", "n_tokens", "covered", "coverage", "n_tiles", "longest"])

    kind = {f.name: f.dataType.simpleString() for f in whole.schema}
    found = whole.mapInPandas(tiled, f"doc {kind['doc']}, item {kind['item']}, n_tokens int, covered int, "
                              "coverage double, n_tiles int, longest int").where(F.col("coverage") >= threshold)
    best = F.max(F.struct("covered", "longest", "n_tiles", "n_tokens", "coverage")).alias("best")
    return found.groupBy("doc", "item").agg(best).select(
        "doc", "item", "best.n_tokens", "best.covered", "best.coverage", "best.n_tiles", "best.longest")


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` less the documents of `leaks`; rows without id stay."""
    bad = staged(found.select("doc").distinct(), "leaks")
    return docs.join(checked_broadcast(bad, 500_000), docs[f"`{id_col}`"] == bad["doc"], "left_anti")
