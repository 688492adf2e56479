"""SimHash fingerprints and all links between those that differ in a few bits."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from revlens.llm.components import components
from revlens.llm.text import narrow, row_hash
from revlens.session import staged

BITS = 64


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)


def text_fingerprint(text: bytes | None, shingle: int, seed: int = 42, block: int = 1 << 15) -> int:
    """Unsigned 64 bits of a text in UTF-8: those set in over half of the shingles' XXH64, 0 for a text without words."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    first, last = (ends - sizes)[: max(1, len(words) - shingle + 1)], ends[min(shingle, len(words)) - 1:]
    counts = np.zeros(BITS, np.uint64)
    for at in range(0, len(first), block):
        pieces = zip(first[at:at + block].tolist(), last[at:at + block].tolist())
        counts += _bit_counts(np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in pieces], np.uint64))
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int) -> Column:
    """The fingerprint of every whole text as a bigint with the same bits; 0 for a null text or one without words."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([text_fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text.cast("binary"))


def bit_count_embedding(fp: Column, segment: int) -> Column:
    """Each segment's number of set bits, written as that many ones at the segment's low end.

    In this form the Manhattan distance of two vectors of counts is the number of differing bits,
    and a part of the vector is a mask.
    """
    ones = (1 << segment) - 1
    parts = None
    for at in range(0, BITS, segment):
        count = F.bit_count(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit(ones)))
        unary = F.call_function("shiftleft", F.lit(1).cast("bigint"), count) - 1
        part = F.shiftleft(unary, at)
        parts = part if parts is None else parts.bitwiseOR(part)
    return parts


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def groups_of_segments(segment: int, n_groups: int) -> list[int]:
    """Bit masks of `n_groups` groups of neighbouring segments, of sizes as even as can be."""
    starts = np.array_split(np.arange(0, BITS, segment), n_groups)
    return [sum(((1 << segment) - 1) << int(s) for s in group) for group in starts]


def shared_groups(n: int, max_distance: int, segment: int = 2) -> int:
    """How many equal groups a cell asks for: that with the least rows and expected candidates for each of `n` random points.

    More groups make more cells of finer grain. Any number finds the same pairs, so this changes the work only.
    """
    same = sum(comb(segment, c) ** 2 for c in range(segment + 1)) / 4 ** segment  # two segments with equal counts
    def work(shared: int) -> float:
        cells, equal = comb(max_distance + shared, shared), BITS // segment * shared / (max_distance + shared)
        return cells * (1 + n * same ** equal)
    return min(range(3, 9), key=work)


def links(unique: DataFrame, max_distance: int = 4, segment: int = 2, shared: int | None = None) -> DataFrame:
    """(a, b) with a < b of `unique` (fp) for all pairs of fingerprints at most `max_distance` bits apart.

    Fingerprints become points: the bit counts of their segments. The Manhattan distance of two
    points is at most the fingerprints' distance. The coordinates are cut into
    `max_distance + shared` groups; within Manhattan distance `max_distance` at least `shared` groups are
    equal, so joining the grid's cells of every choice of `shared` groups meets every near
    pair. A pair is taken only in the cell of its first equal groups, so once, and goes on if its
    Manhattan distance and then its real distance hold. The join is by (choice, cell); cells of
    random fingerprints hold few rows, because `shared` follows the number of points if it isn't given.
    It is a merge join by hint: the planner takes the cells for as small as the points' files, and would
    broadcast a table tens of times as large through the driver.
    """
    if shared is None:
        shared = shared_groups(unique.count(), max_distance, segment)
    masks = groups_of_segments(segment, max_distance + shared)
    choices = [sum(1 << g for g in c) for c in combinations(range(len(masks)), shared)]
    cell_mask = {c: _signed(sum(m for g, m in enumerate(masks) if c >> g & 1)) for c in choices}
    points = staged(unique.select("fp", bit_count_embedding(F.col("fp"), segment).alias("point")), "points")
    cells = points.select("fp", "point", F.explode(F.array(*[
        F.struct(F.lit(c).alias("choice"), F.col("point").bitwiseAND(F.lit(m)).alias("cell"))
        for c, m in cell_mask.items()])).alias("at")).select("fp", "point", "at.choice", "at.cell")
    x, y = cells.alias("x"), cells.alias("y")
    differ = F.col("x.point").bitwiseXOR(F.col("y.point"))
    equal = sum(
        (F.when(differ.bitwiseAND(F.lit(_signed(m))) == 0, F.lit(1 << g)).otherwise(F.lit(0)) for g, m in enumerate(masks)),
        F.lit(0),
    )
    # The lowest `shared` set bits of `equal` are the choice: no set bit of `equal` below its top is missing from it.
    top = F.call_function("shiftleft", F.lit(1), F.floor(F.log2(F.col("x.choice"))).cast("int") + 1) - 1
    is_first = equal.bitwiseAND(top) == F.col("x.choice")
    near = (
        (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(differ) <= max_distance)
        & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_distance) & is_first
    )
    same_cell = (F.col("x.choice") == F.col("y.choice")) & (F.col("x.cell") == F.col("y.cell"))
    return x.join(y.hint("merge"), same_cell & near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                    max_distance: int = 4) -> DataFrame:
    """(doc, fp, component): fingerprint and component, the smallest id that is reachable by links.

    Fingerprints are computed once per row and staged; from then on equal fingerprints are one
    point, so copies never meet in pairs. Components run over fingerprints and come back to the
    documents by a join on the fingerprint, in which AQE can split a very common one.

    A text of fewer words than a shingle is one shingle; null, empty and blank texts have
    fingerprint 0 and link like any other. Rows that repeat an id get a row each. Rows without
    id are kept; where no other row is reachable their component is null. An empty table gives no rows.
    """
    rows = narrow(docs, doc=id_col, text=text_col)
    marked = staged(rows.select("doc", fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    found = rooted(marked, max_distance)
    smallest = found.groupBy("root").agg(F.min("least").alias("component"))
    labels = found.join(smallest, "root").select(F.col("fp").alias("label"), "component")
    return marked.join(labels, F.col("fp") == F.col("label")).select("doc", "fp", "component")


def rooted(marked: DataFrame, max_distance: int) -> DataFrame:
    """(fp, least, root) of each different fingerprint of `marked` (doc, fp): its smallest id, and the root of its component."""
    unique = marked.groupBy("fp").agg(F.min("doc").alias("least"))
    stars = components(staged(links(unique.select("fp"), max_distance), "links"))
    return unique.join(stars, unique.fp == stars.a, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                max_distance: int = 4) -> DataFrame:
    """`docs` less all documents of a component of `near_duplicates` but the one with the smallest id, which stays once.

    Fingerprints are computed once and staged with the ids and the rows' hashes; rows that stay are found by id and hash.
    An id that occurs with several texts stays with that one of its texts which represents the component. Of rows that repeat
    both, the one with the least `row_hash` stays. Rows without id link others but represent none, and stay. Null, empty and blank
    texts are copies of each other. An empty table gives no rows; columns of any name and type come along.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), row_hash(docs).alias("hash"), fingerprint(F.col(f"`{text_col}`"), shingle).alias("fp"))
    rows = staged(rows, "simhash-rows")
    found = rooted(rows.select("doc", "fp"), max_distance).where("least IS NOT NULL")
    least = found.groupBy("root").agg(F.min(F.struct("least", "fp")).alias("x")).select(F.col("x.least").alias("doc"), "x.fp")
    stay = rows.join(least, ["doc", "fp"]).groupBy("doc", "fp").agg(F.min("hash").alias("hash")).select("doc", "hash")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select(F.col(f"`{id_col}`").alias("doc"), row_hash(docs).alias("hash"), F.struct(*columns).alias("row"))
    once = whole.join(stay, ["doc", "hash"]).dropDuplicates(["doc", "hash"])  # rows equal in every column are one
    return once.select("row.*").union(docs.where(F.col(f"`{id_col}`").isNull()).select(*columns))
