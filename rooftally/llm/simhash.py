"""SimHash near-deduplication through vantage-point trees.

A tree over a bounded sample of fingerprints splits Hamming space into shards: at each node a
fingerprint lies inside or outside a ball around the vantage point. It has one home shard, and by
the triangle inequality can only have near ones across a boundary that it is within the radius of,
so it also visits those shards. Distances of random fingerprints lie close together, so over all 64 bits
most boundaries would be crossed. There is a tree for each half of the bits instead: two fingerprints that
differ in 3 bits differ in at most one bit of one half, so each tree searches a radius of 1.

Every fingerprint is routed through both trees, and every pair within the radius meets in some shard, where
smaller trees over all bits find it exactly. Leaves that stay large get trees of their own, from samples of
their fingerprints. A shard gives a forest over its links, not all its pairs; the forests are joined by
:mod:`components`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, ready, retain, staged
from .components import connected

SHINGLE_WORDS = 3
RADIUS = 3
SEED = 42
TREES = 2              # each over its share of the bits
SAMPLE = 16_384        # fingerprints that shape a tree; all are routed through it
LEAF_SAMPLE = 256      # fingerprints that shape the tree of a large leaf, about
SHARD = 8_192          # fingerprints that a shard is meant to be home to
MOST_SHARDS = 1 << 18  # leaves of a tree, which goes to every task; with more fingerprints shards grow
BLOCK = 65_536         # most fingerprints of either side in one task; larger shards are cut into blocks


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text, A-Z folded, over its word shingles, repeats included; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < shingle_words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(shingle_words))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(shingle, SEED) for shingle in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start:start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64).view(np.int64)


def fingerprints(documents: DataFrame, id_column: str, text_column: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``_id``, ``_print`` (the fingerprint's bits as a long) and ``_mark`` (a hash of the folded text) of every row."""
    rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"), _mark_of(text_column).alias("_mark"))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text.as_py(), shingle_words) for text in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_signed(prints)), batch.column(2)], ["_id", "_print", "_mark"])

    ready(documents.sparkSession)
    schema = rows.selectExpr("_id", "0L _print", "_mark").schema
    return rows.mapInArrow(mark, schema)


def _mark_of(text_column: str) -> Column:
    return F.xxhash64(fold(F.col(f"`{text_column}`")))


@dataclass
class Tree:
    """Nodes in arrays. A child below zero is shard ``-child - 1``."""

    vantage: np.ndarray
    bound: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    shards: int


def build_tree(sample: np.ndarray, shards: int, radius: int) -> Tree:
    """A tree of about ``shards`` leaves that are home to like shares of ``sample``."""
    random = np.random.default_rng(SEED)
    vantage, bound, inner, outer, count = [], [], [], [], 0

    def grow(points: np.ndarray, parts: int) -> int:
        nonlocal count
        split = choose_split(points, radius, random, 32) if parts > 1 and len(points) > 1 else None
        if split is None:
            count += 1
            return -count
        at, (point, limit, near) = len(vantage), split
        vantage.append(point), bound.append(limit), inner.append(0), outer.append(0)
        share = min(parts - 1, max(1, round(parts * near.mean())))
        inner[at] = grow(points[near], share)
        outer[at] = grow(points[~near], parts - share)
        return at

    grow(np.unique(sample), shards)
    return Tree(np.array(vantage, np.uint64), np.array(bound, np.int64), np.array(inner, np.int64), np.array(outer, np.int64), count)


def graft(tree: Tree, leaves: dict[int, Tree]) -> Tree:
    """``tree`` with trees in the place of some of its leaves. Their first leaf takes the number of the leaf, others get new ones."""
    parts, shards, roots = [tree], tree.shards, {}
    nodes = len(tree.vantage)
    for leaf, own in leaves.items():
        numbers = np.append(leaf, shards + np.arange(own.shards - 1))
        inner, outer = (np.where(child < 0, -numbers[np.where(child < 0, -child - 1, 0)] - 1, child + nodes) for child in (own.inner, own.outer))
        if len(own.vantage):
            roots[leaf] = nodes
        parts.append(Tree(own.vantage, own.bound, inner, outer, own.shards))
        nodes, shards = nodes + len(own.vantage), shards + own.shards - 1
    # The tree's own children that were leaves become the roots of what stands there now.
    moved = np.array([roots.get(leaf, -leaf - 1) for leaf in range(tree.shards)], np.int64)
    inner, outer = (np.where(child < 0, moved[np.where(child < 0, -child - 1, 0)], child) for child in (tree.inner, tree.outer))
    parts[0] = Tree(tree.vantage, tree.bound, inner, outer, tree.shards)
    return Tree(*(np.concatenate([getattr(part, name) for part in parts]) for name in ("vantage", "bound", "inner", "outer")), shards)


def choose_split(points: np.ndarray, radius: int, random: np.random.Generator, tries: int = 8) -> tuple[np.uint64, int, np.ndarray] | None:
    """Of a few vantage points with their median ball, the one that fewest points are near the boundary of."""
    best = None
    for point in random.choice(points, min(tries, len(points)), replace=False):
        distance = np.bitwise_count(points ^ point)
        limit = int(np.median(distance))
        if limit >= distance.max():
            limit = int(distance.max()) - 1
        near = distance <= limit
        if limit < 0 or near.all() or not near.any():
            continue
        crossing = np.mean((distance > limit - radius) & (distance <= limit + radius))
        if best is None or crossing < best[0]:
            best = (crossing, point, limit, near)
    return best and best[1:]


def route(tree: Tree, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shards of each fingerprint: positions in ``prints``, shards, and whether the shard is its home."""
    if not len(tree.vantage):
        at = np.arange(len(prints))
        return at, np.zeros(len(prints), np.int64), np.ones(len(prints), bool)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    node, at, home = np.zeros(len(prints), np.int64), np.arange(len(prints)), np.ones(len(prints), bool)
    while len(node):
        distance = np.bitwise_count(prints[at] ^ tree.vantage[node]).astype(np.int64)
        inside, limit = distance <= tree.bound[node], tree.bound[node]
        # Of two homes on either side of a ball, the outer one visits the inner side.
        enters = np.where(home, inside | (distance <= limit + radius), distance <= limit + radius)
        leaves = np.where(home, ~inside, distance > limit - radius)
        parts = [
            (tree.inner[node[enters]], at[enters], home[enters] & inside[enters]),
            (tree.outer[node[leaves]], at[leaves], home[leaves]),
        ]
        node, at, home = (np.concatenate(x) for x in zip(*parts))
        ended = node < 0
        done.append((at[ended], -node[ended] - 1, home[ended]))
        node, at, home = node[~ended], at[~ended], home[~ended]
    return tuple(np.concatenate(x) for x in zip(*done))


def near_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever the pairs of ``left`` and ``right`` within ``radius`` connect."""
    random = np.random.default_rng(SEED)
    found_left, found_right = [], []
    stack = [(left, right)]
    while stack:
        a, b = stack.pop()
        if not len(a) or not len(b):
            continue
        split = choose_split(a, radius, random) if len(a) > 128 and len(a) * len(b) > 1 << 18 else None
        if split:
            point, limit, near = split
            distance = np.bitwise_count(b ^ point).astype(np.int64)
            stack.append((a[near], b[distance <= limit + radius]))
            stack.append((a[~near], b[distance > limit - radius]))
            continue
        rows = max(1, (1 << 20) // len(b))
        for start in range(0, len(a), rows):
            part = a[start:start + rows]
            close = np.bitwise_count(part[:, None] ^ b[None, :]) <= radius
            x, y = sparse_links(close)
            found_left.append(part[x]), found_right.append(b[y])
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *found_left]), np.concatenate([empty, *found_right])


def sparse_links(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a link matrix; of a dense one, only as many as keep what it connects together."""
    rows, columns = close.shape
    x, y = np.nonzero(close)
    if len(x) <= 4 * (rows + columns):
        return x, y
    label = np.arange(rows)
    while True:
        column = np.full(columns, rows)
        np.minimum.at(column, y, label[x])
        lower = label.copy()
        np.minimum.at(lower, x, column[y])
        if (lower == label).all():
            break
        label = lower
    # Components are known: link each column to its component's first row, and each row to a column of its own.
    used = np.flatnonzero(column < rows)
    first = np.full(rows, -1)
    first[x[::-1]] = y[::-1]
    has = np.flatnonzero(first >= 0)
    # A root row may not touch every column it stands for, but the two are connected, so the link adds nothing new.
    return np.concatenate([column[used], has]), np.concatenate([used, first[has]])


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes linked to the smallest node of their component, one link for each node but that one."""
    nodes, position = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = position[:len(a)], position[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        lower = label.copy()
        np.minimum.at(lower, x, low)
        np.minimum.at(lower, y, low)
        np.minimum.at(lower, label[x], low)
        np.minimum.at(lower, label[y], low)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[other], nodes[label[other]]


def part_masks(trees: int) -> list[np.uint64]:
    """The bits of each tree."""
    bounds = [64 * k // trees for k in range(trees + 1)]
    return [np.uint64((1 << b) - (1 << a)) for a, b in zip(bounds, bounds[1:])]


def shard_tree(prints: DataFrame, chosen: np.ndarray, mask: np.uint64, radius: int, shards: int, leaf_sample: int) -> Tree:
    """A tree over the bits of ``mask`` with about ``shards`` leaves: from the sample ``chosen`` first, then from samples of its large leaves."""
    tree = build_tree(chosen & mask, min(shards, max(1, len(chosen) // 4)), radius)
    if shards <= tree.shards or not len(tree.vantage):
        return tree

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at, where, _ = route(tree, values & mask, 0)
            yield pa.RecordBatch.from_arrays([pa.array(_signed(values[at])), pa.array(where)], ["_print", "_shard"])

    at_home = staged(prints.select("_print").mapInArrow(homes, "_print bigint, _shard bigint"), "homes")
    sizes = at_home.groupBy("_shard").agg(F.count(F.lit(1)).alias("_size"))
    meant = prints.count() / shards
    large = staged(sizes.where(F.col("_size") > 2 * meant), "large-shards")
    # About as many of each large leaf, whatever its size.
    drawn = at_home.join(F.broadcast(large), "_shard").where(F.pmod(F.xxhash64(F.lit(SEED), "_print"), "_size") < leaf_sample)
    found = drawn.select("_shard", "_size", "_print").toPandas()
    own = {}
    for leaf, part in found.groupby("_shard"):
        parts = max(2, round(part["_size"].iloc[0] / meant))
        own[int(leaf)] = build_tree(part["_print"].to_numpy(np.int64).view(np.uint64) & mask, min(parts, max(2, len(part) // 2)), radius)
    return graft(tree, own)


def near_edges(
    prints: DataFrame, radius: int, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK, trees: int = TREES, leaf_sample: int = LEAF_SAMPLE,
) -> DataFrame:
    """Edges (``a``, ``b``) that connect the distinct fingerprints of ``prints`` as all pairs within ``radius`` do.

    ``sample`` and ``leaf_sample`` for each leaf of a first tree bound what the driver reads to shape the trees.
    Sizes of shards are counted over all fingerprints, and a shard of more than ``block`` homes or visitors is
    searched block against block.
    """
    spark = ready(prints.sparkSession)
    total = prints.count()
    chosen = prints.orderBy(F.xxhash64("_print"), "_print").limit(sample).select("_print").toPandas()["_print"].to_numpy(np.int64).view(np.uint64)
    # Of two fingerprints within the radius, one share of the bits has no more than its share of the differences.
    near, shards = radius // trees, max(1, min(MOST_SHARDS, -(-total // shard)))
    masks = part_masks(trees)
    forests = [shard_tree(prints, chosen, mask, near, shards, leaf_sample) for mask in masks]
    firsts = np.cumsum([0, *(tree.shards for tree in forests)])

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(values), 2048):
                part = values[start:start + 2048]
                for tree, mask, first in zip(forests, masks, firsts):
                    at, where, home = route(tree, part & mask, near)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(_signed(part[at])), pa.array(where + first), pa.array(home)], ["_print", "_shard", "_home"],
                    )

    routed = prints.select("_print").mapInArrow(visits, "_print bigint, _shard bigint, _home boolean")
    # One row for each shard of the trees.
    sizes = routed.groupBy("_shard").agg(
        F.ceil(F.sum(F.col("_home").cast("int")) / block).alias("_rows"), F.ceil(F.count(F.lit(1)) / block).alias("_columns"),
    )
    blocks = routed.join(F.broadcast(sizes), "_shard").where("_rows > 0")
    own = F.pmod(F.xxhash64("_print"), F.col("_rows"))
    across = F.pmod(F.xxhash64(F.lit(1), "_print"), F.col("_columns"))
    left = blocks.where("_home").select(
        "_shard", own.alias("_row"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_columns") - 1)).alias("_column"),
        F.lit(True).alias("_left"), (F.col("_rows") + F.col("_columns") == 2).alias("_both"), "_print",
    )
    right = blocks.where("NOT _home OR _rows + _columns > 2").select(
        "_shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_rows") - 1)).alias("_row"), across.alias("_column"),
        F.lit(False).alias("_left"), F.lit(False).alias("_both"), "_print",
    )

    def search(task: pd.DataFrame) -> pd.DataFrame:
        values = task["_print"].to_numpy(np.int64).view(np.uint64)
        is_left, is_both = task["_left"].to_numpy(bool), task["_both"].to_numpy(bool)
        a, b = forest(*near_links(values[is_left], values[is_both | ~is_left], radius))
        return pd.DataFrame({"a": _signed(a), "b": _signed(b)})

    spread = left.unionByName(right)
    return spread.groupBy("_shard", "_row", "_column").applyInPandas(search, "a bigint, b bigint")


def near_groups(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints that differ in ``radius`` bits or fewer are linked; ``component_id`` is the smallest
    id that links reach. Texts without words, null and empty ones among them, have fingerprint zero,
    which is linked like any other; a text of fewer words than a shingle is one shingle. Null ids take
    part, but a component is named by its smallest id that is not null (null if it has none). Rows that
    repeat an id each give a row. An empty table gives an empty result; other columns are ignored.
    """
    found = _near_groups(documents, id_column, text_column, shingle_words, radius, sample, shard, block)
    return found.drop("_mark").withColumnRenamed("_id", id_column)


def _near_groups(
    documents: DataFrame, id_column: str, text_column: str, shingle_words: int, radius: int, sample: int, shard: int, block: int,
) -> DataFrame:
    hashed = staged(fingerprints(documents, id_column, text_column, shingle_words), "prints")
    prints = staged(hashed.groupBy("_print").agg(F.min("_id").alias("_low")), "distinct-prints")
    links = connected(near_edges(prints, radius, sample, shard, block))
    roots = links.select(F.col("node").alias("_print"), F.col("root").alias("_root")).union(
        links.select("root", "root").distinct()
    )
    linked = staged(roots.join(prints, "_print"), "linked-prints")
    lowest = linked.groupBy("_root").agg(F.min("_low").alias("_lowest"))
    names = linked.join(lowest, "_root").select("_print", "_lowest", F.lit(True).alias("_linked"))
    named = prints.join(names, "_print", "left").select(
        F.col("_print").alias("_key"), F.when(F.col("_linked"), F.col("_lowest")).otherwise(F.col("_low")).alias("_component"),
    )
    # Written first, so that both sides of the join come from exchanges of its own and a hot fingerprint can be split.
    return hashed.join(staged(named, "components"), F.col("_print") == F.col("_key")).select(
        "_id", "_mark", F.lower(F.lpad(F.hex("_print"), 16, "0")).alias("fingerprint"), F.col("_component").alias("component_id"),
    )


def drop_near_copies(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """``documents`` with one document of each group of near copies: the one with the smallest id.

    Rows that share an id are judged each by its own fingerprint. If several rows of a group carry its smallest
    id, those with different texts all stay.
    """
    groups = _near_groups(documents, id_column, text_column, shingle_words, radius, sample, shard, block)
    verdicts = groups.select("_id", "_mark", F.col("_id").eqNullSafe(F.col("component_id")).alias("_stays"))
    return retain(documents, verdicts, id_column, _mark_of(text_column), once=True)
