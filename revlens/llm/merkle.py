"""Manifest of a dataset as trees of SHA-256, folded anew from states kept before each child.

Every group of rows is a tree over its leaves in order, and the groups' roots are the leaves of
one more tree. A parent hashes up to three children one after another and keeps the hash's state
before each of them. To fold a changed child, the state before its slot is resumed with the
replacement and the siblings on its right; those on its left are never read.

Trees are built in rounds of `STEPS` levels: a block of 3**STEPS neighbours is a whole subtree, so
a task builds it alone, and the next round sees one row for each block. No step holds a group:
places come from a range partitioning, blocks of all groups are dealt out evenly.

Edge cases: a null in a leaf column is `-`, an empty text `0:`. Rows without group value are a group of their own, the
first one. Rows without order value come first in their group; ties are ordered by their leaves, so repeated rows are
leaves of their own. A group of one row has its leaf as root, one group's root is the root of all. An empty
table gives no rows. Columns that are not named take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.llm import midstates as sha
from revlens.llm.text import checked_broadcast
from revlens.session import drop_staged, staged

ARITY = 3
STEPS = 7  # levels in a block
BLOCK = ARITY ** STEPS
DEAL_ROWS = 8192
TOP = -1  # the tree over the groups' roots
NODE = ("tree bigint, height int, place bigint, depth int, width int, children binary, states binary, digest binary")


@dataclass
class Manifest:
    """`leaves` (kept columns, tree, place, depth, leaf), `groups` (group, tree, n, depth) and `nodes`:
    one row a parent with its children's digests and the hash states before each of them, 32 bytes each."""

    leaves: DataFrame
    groups: DataFrame
    nodes: DataFrame
    top_depth: int


def leaf(*columns: Column) -> Column:
    """SHA-256, 32 bytes, of the columns: `-` for a null, else the length in bytes, `:` and the value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def depth_of(n: Column) -> Column:
    """Levels above `n` leaves until one node remains."""
    powers = F.array(*[F.lit(ARITY ** k).cast("bigint") for k in range(40)])
    return F.size(F.filter(powers, lambda p: p < n))


def power_of(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ARITY ** i).cast("bigint") for i in range(40)]), (k + 1).cast("int"))


def numbered(df: DataFrame, *order: Column | str, name: str = "at") -> DataFrame:
    """Numbers all rows 0, 1, ... in this order: range partitions are sorted, and each adds the rows before it."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = staged(rows.withColumn("_part", F.shiftright("_row", 33)), "in-order")
    parts = rows.groupBy("_part").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = rows.join(checked_broadcast(parts, 100_000), "_part")
    return found.select(*df.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias(name))


def manifest(docs: DataFrame, leaf_of: Column, group: str, order: str, **kept: Column) -> Manifest:
    """Places all rows of `docs` by `group` and `order` and builds their trees; `kept` are columns to carry along."""
    rows = docs.select(F.col(f"`{group}`").alias("_group"), F.col(f"`{order}`").alias("_order"), leaf_of.alias("leaf"),
                       *[c.alias(name) for name, c in kept.items()])
    rows = staged(rows.withColumn("_tie", F.monotonically_increasing_id()), "leaves")
    placed = numbered(rows, "_group", "_order", "leaf", "_tie")
    groups = placed.groupBy("_group").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    groups = staged(numbered(groups, "first", name="tree").withColumn("depth", depth_of(F.col("n"))), "groups")
    by_group = checked_broadcast(groups.withColumnRenamed("_group", "_same"), 100_000)
    leaves = placed.join(by_group, F.col("_group").eqNullSafe(F.col("_same")))
    leaves = staged(leaves.select(*kept, "tree", (F.col("at") - F.col("first")).alias("place"), "depth", "leaf"), "places")
    drop_staged(rows)
    top_depth = depth_of_count(groups.count())
    nodes = build(leaves.select("tree", "place", "depth", F.col("leaf").alias("digest")))
    roots = nodes.where("height = depth").select("tree", "digest").union(leaves.where("depth = 0").select("tree", "leaf"))
    roots = staged(roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("place"),
                                F.lit(top_depth).alias("depth"), "digest"), "roots")
    return Manifest(leaves, groups, nodes.union(build(roots)), top_depth)


def depth_of_count(n: int) -> int:
    depth = 0
    while ARITY ** depth < n:
        depth += 1
    return depth


def build(rows: DataFrame) -> DataFrame:
    """All parents above the rows (tree, place, depth, digest), a round of `STEPS` levels after another."""
    made, base = None, 0
    while True:
        open_rows = rows.where(F.col("depth") > base)
        n = open_rows.count()
        if made is not None and n == 0:
            return made
        deals = n // DEAL_ROWS + 1
        dealt = open_rows.select("tree", "place", "depth", "digest", F.lit(base).alias("base"), dealt_to("place", deals))
        part = staged(dealt.groupBy("deal").applyInArrow(_parents, NODE), "nodes")
        made = part if made is None else made.union(part)
        base += STEPS
        rows = part.where(F.col("height") == base)


def dealt_to(place: str, deals: int) -> Column:
    block = F.floor(F.col(place) / BLOCK)
    return F.pmod(F.xxhash64("tree", block), F.lit(deals)).alias("deal")


def fold(found: Manifest, shown: str) -> DataFrame:
    """(kept columns, leaf, subroot, root, proof, folded) for every leaf, digests as 32 bytes.

    `shown` is a kept column with the leaf as somebody shows it: `folded` is the root that follows from it with the
    manifest's siblings. `proof` hashes the siblings from the leaf to the root, left to right.
    """
    leaves = found.leaves
    low = found.nodes.where((F.col("tree") != TOP) & (F.col("height") <= STEPS))
    low = low.withColumn("block", F.floor(F.col("place") * power_of(F.col("height")) / BLOCK))
    low = low.select("tree", "block", F.col("height").alias("level"), "place", "width", "children", "states", "digest")
    # The few parents above a block go along with it.
    above = leaves.where(F.col("place") % BLOCK == 0).select("tree", (F.col("place") / BLOCK).cast("bigint").alias("block"), "depth")
    levels = F.filter(F.sequence(F.lit(0), F.col("depth") + found.top_depth),
                      lambda x: (x > STEPS) | (x > F.col("depth")))
    above = above.withColumn("level", F.explode(levels))
    inside = F.col("level") <= F.col("depth")
    above = above.select(
        "tree", "block", "level", F.when(inside, F.col("tree")).otherwise(TOP).alias("_tree"),
        F.when(inside, F.col("level")).otherwise(F.col("level") - F.col("depth")).alias("_height"), inside.alias("_inside"))
    above = above.withColumn("_place", F.when(F.col("_inside"), F.col("block") * BLOCK).otherwise(F.col("tree")))
    above = above.withColumn("_place", F.col("_place") - F.col("_place") % power_of(F.col("_height"))).withColumn(
        "_place", (F.col("_place") / power_of(F.col("_height"))).cast("bigint"))
    high = found.nodes.withColumnsRenamed({"tree": "_tree", "height": "_height", "place": "_place"})
    above = above.join(high.drop("depth"), ["_tree", "_height", "_place"])
    above = above.select("tree", "block", "level", F.when(F.col("_inside"), F.col("_place")).otherwise(F.lit(0).cast("bigint")).alias("place"),
                         "width", "children", "states", "digest")
    deals = leaves.count() // DEAL_ROWS + 1
    parents = low.union(above).withColumn("deal", F.pmod(F.xxhash64("tree", "block"), F.lit(deals)))
    rows = leaves.select("*", dealt_to("place", deals))
    out = leaves.drop("tree", "place", "depth").schema
    for name in ("subroot", "root", "proof", "folded"):
        out = out.add(name, "binary")
    columns = out.names

    def folded(left: pa.Table, right: pa.Table) -> pa.Table:
        return _folded(left, right, shown, found_depth).select(columns)

    found_depth = found.top_depth
    return rows.groupBy("deal").cogroup(parents.groupBy("deal")).applyInArrow(folded, out)


def _digests(column: pa.ChunkedArray, width: int = 1) -> np.ndarray:
    """Binary values as rows of `width` times 32 bytes, filled up with zeros."""
    joined = b"".join(v.ljust(32 * width, b"\0") for v in column.to_pylist())
    return np.frombuffer(joined, "u1").reshape(-1, width, 32) if width > 1 else np.frombuffer(joined, "u1").reshape(-1, 32)


def _binary(rows: np.ndarray, lengths=None) -> pa.Array:
    flat = np.ascontiguousarray(rows).reshape(len(rows), -1)
    if lengths is None:
        return pa.array([r.tobytes() for r in flat], pa.binary())
    return pa.array([r[: 32 * n].tobytes() for r, n in zip(flat, lengths)], pa.binary())


def _parents(table: pa.Table) -> pa.Table:
    """The parents, up to `STEPS` levels, of all blocks of one deal."""
    tree, place, depth, base = (table[c].to_numpy() for c in ("tree", "place", "depth", "base"))
    order = np.lexsort((place, tree))
    tree, place, depth, base = (x[order] for x in (tree, place, depth, base))
    digest = _digests(table["digest"])[order]
    levels = []
    for level in range(1, STEPS + 1):
        live = depth >= base + level
        tree, place, depth, base, digest = (x[live] for x in (tree, place, depth, base, digest))
        if not len(tree):
            break
        up = place // ARITY
        first = np.r_[True, (tree[1:] != tree[:-1]) | (up[1:] != up[:-1])]
        at = np.flatnonzero(first)
        width = np.diff(np.r_[at, len(tree)])
        children = np.zeros((len(at), ARITY, 32), "u1")
        children[np.cumsum(first) - 1, place % ARITY] = digest
        states = np.zeros((len(at), ARITY, 32), "u1")
        now = sha.start(len(at))
        for slot in range(ARITY):
            has = width > slot
            states[has, slot] = sha.as_bytes(now[has])
            now[has] = sha.absorb(now[has], sha.hex_blocks(children[has, slot]))
        tree, place, depth, base, digest = tree[at], up[at], depth[at], base[at], sha.finish(now, width)
        levels.append(pa.table({
            "tree": pa.array(tree, pa.int64()), "height": pa.array(base + level, pa.int32()), "place": pa.array(place, pa.int64()),
            "depth": pa.array(depth, pa.int32()), "width": pa.array(width, pa.int32()),
            "children": _binary(children, width), "states": _binary(states, width), "digest": _binary(digest)}))
    return pa.concat_tables(levels)


def _folded(left: pa.Table, right: pa.Table, shown: str, top_depth: int) -> pa.Table:
    """Folds all leaves of one deal level by level, each from the state before its slot."""
    tree, place, depth = (left[c].to_numpy() for c in ("tree", "place", "depth"))
    n = len(tree)
    now, proof, n_proof = _digests(left[shown]).copy(), sha.start(n), np.zeros(n, "i8")
    subroot = _digests(left["leaf"]).copy()
    root = subroot.copy()
    level_of, width = right["level"].to_numpy(), right["width"].to_numpy()
    children, states, digest = _digests(right["children"], ARITY), _digests(right["states"], ARITY), _digests(right["digest"])
    nodes = pd.DataFrame({"tree": right["tree"].to_numpy(), "up": right["place"].to_numpy(), "node": np.arange(len(level_of))})
    for level in range(1, int((depth + top_depth).max(initial=0)) + 1):
        rows = np.flatnonzero(depth + top_depth >= level)
        inside = depth[rows] >= level
        up = np.where(inside, place[rows] // ARITY ** level, 0)
        above = np.power(ARITY, np.maximum(level - depth[rows] - 1, 0).astype("i8"))
        slot = np.where(inside, place[rows] // ARITY ** (level - 1), tree[rows] // above) % ARITY
        here = nodes[level_of == level].drop_duplicates(["tree", "up"])
        node = pd.DataFrame({"tree": tree[rows], "up": up}).merge(here, "left", ["tree", "up"])["node"].to_numpy("i8")
        state = sha.absorb(sha.from_bytes(states[node, slot]), sha.hex_blocks(now[rows]))
        siblings = proof[rows]
        for other in range(ARITY):
            exists = other < width[node]
            block = sha.hex_blocks(children[node, other])
            after, beside = exists & (other > slot), exists & (other != slot)
            state[after] = sha.absorb(state[after], block[after])
            siblings[beside] = sha.absorb(siblings[beside], block[beside])
            n_proof[rows[beside]] += 1
        proof[rows] = siblings
        now[rows] = sha.finish(state, width[node])
        subroot[rows[depth[rows] == level]] = digest[node[depth[rows] == level]]
        last = depth[rows] + top_depth == level
        root[rows[last]] = digest[node[last]]
    root[depth + top_depth == 0] = subroot[depth + top_depth == 0]
    for name, values in (("subroot", subroot), ("root", root), ("proof", sha.finish(proof, n_proof)), ("folded", now)):
        left = left.append_column(name, _binary(values))
    return left
