"""A Merkle manifest of a dataset, with proofs by octopus multiproofs.

Every row is a leaf; the leaves of a source, by id, form a tree of threes, and the roots of the sources
another. Leaves get their ranks from one range sort and the counts of its parts. Trees are raised in
rounds: a round turns each stretch of 3 ** 7 nodes that stand together into the node above them all, so a
few rounds reach the roots of any number of rows, and a hot source is as many stretches as it needs.

To prove its leaves, a group of them (a stretch of a large source, or whole small sources) works out which
nodes it cannot derive: going up level by level, those that share a parent with a node it has and are not
its own, each named once for all its leaves. These are fetched in one join; the group derives what lies
between, shared by its leaves, and expands each leaf's proof from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, running_before, staged

ARITY = 3
STRETCH_LEVELS = 7
PART_ROWS = 1 << 15     # leaves to a part of the range sort, about
TOP = -1                # the tree over the roots of the sources
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "_tree bigint, _level int, _index bigint, _nodes bigint, _digest binary"


def leaf_digest(fields: list[Column]) -> Column:
    """The SHA-256 in hex of each field in turn: ``-`` for null, else the bytes of its text in UTF-8, ``:`` and the text."""
    def spelled(field: Column) -> Column:
        text = field.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[spelled(field) for field in fields]), 256)


def combine(digests: list[str]) -> str:
    """The digest over digests, all as hex text; tables hold them as bytes."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def above(nodes: list[str]) -> list[str]:
    return [combine(nodes[at:at + ARITY]) for at in range(0, len(nodes), ARITY)]


def levels_up(count: int, most: int) -> int:
    """How many levels lie between ``count`` nodes and their root, ``most`` at most."""
    level = 0
    while count > 1 and level < most:
        count, level = -(-count // ARITY), level + 1
    return level


def missing(held: np.ndarray, count: int) -> list[tuple[int, int]]:
    """(levels above, index) of the nodes that the holder of ``held`` (indexes among ``count`` nodes) lacks to reach the root, each once.

    A run with one node that is held or derived needs its others; with them its parent is derived.
    """
    found, level, held = [], 0, np.unique(held)
    while count > 1:
        runs = np.unique(held // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        lacked = np.setdiff1d(members[members < count], held)
        found.extend((level, index) for index in lacked.tolist())
        held, count, level = runs, -(-count // ARITY), level + 1
    return found


@dataclass
class Manifest:
    """``leaves``: ``_id``, ``_leaf``, ``_claim``, ``_tree``, ``_rank``, ``_count`` and the group (``_one``, ``_two``) of every row.

    ``nodes``: what groups may have to fetch. ``wanted``: what each group does. ``sources``: their number.
    """

    leaves: DataFrame
    nodes: DataFrame
    wanted: DataFrame
    sources: int
    stretch_levels: int


def _ranked(rows: DataFrame, stretch: int, part_rows: int) -> tuple[DataFrame, int]:
    """``rows`` with the number of their source, rank in it, its count, and the group; and the number of sources."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // part_rows))
    order = [F.asc_nulls_first("_source"), F.asc_nulls_first("_id"), F.col("_leaf"), F.col("_salt")]
    # The running number holds the part above 33 bits of the row within it.
    ordered = staged(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()), "ordered-leaves")
    part = F.shiftright("_place", 33)
    cells = staged(ordered.groupBy(part.alias("_part"), F.col("_source").alias("_of")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"),
    ), "cells")
    # A source has a cell for each part that it reaches, and no more.
    earlier = Window.partitionBy("_of").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sources = staged(cells.groupBy("_of").agg(F.sum("_rows").alias("_count"), F.min("_part").alias("_begins")), "sources")
    begun = staged(sources.groupBy("_begins").agg(F.count(F.lit(1)).alias("_sources")), "begun-sources")
    before = running_before(begun, "_begins", "_sources", "_before").select("_begins", "_before")
    among = Window.partitionBy("_begins").orderBy(F.asc_nulls_first("_of"))
    numbered = sources.join(before, "_begins").select(
        F.col("_of").alias("_name"), "_count", "_begins", (F.col("_before") + F.row_number().over(among) - 1).alias("_tree"),
    )
    cells = cells.withColumn("_earlier", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    cells = staged(cells.join(numbered, F.col("_of").eqNullSafe(F.col("_name"))).select(
        "_part", "_of", "_first", "_earlier", "_count", "_begins", "_tree",
    ), "numbered-cells")
    rank = F.col("_place") - F.col("_first") + F.col("_earlier")
    large = F.col("_count") > stretch
    ranked = ordered.withColumn("_at", part).join(
        cells, (F.col("_at") == F.col("_part")) & F.col("_source").eqNullSafe(F.col("_of")),
    ).select(
        "_id", "_leaf", "_claim", "_tree", rank.alias("_rank"), "_count",
        # Small sources that begin in one part are one group, so there are no more groups than parts and stretches.
        F.when(large, F.col("_tree")).otherwise(F.lit(-1)).alias("_one"),
        F.when(large, F.floor(rank / stretch)).otherwise(F.col("_begins")).alias("_two"),
    )
    return staged(ranked, "ranked-leaves"), sources.count()


def _raise(nodes: DataFrame, level: int, levels: int, least: int) -> DataFrame:
    """The nodes above stretches of ``nodes`` of ``level`` (``_tree``, ``_index``, ``_nodes``, ``_digest``), roots and those from ``least`` levels above on."""
    stretch = ARITY ** levels

    def climb(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for tree, own in group.sort_values("_index").groupby("_tree"):
            count, first, digests = int(own["_nodes"].iloc[0]), int(own["_index"].iloc[0]), [digest.hex() for digest in own["_digest"]]
            for step in range(levels_up(count, levels) + 1):
                if step:
                    digests, first, count = above(digests), first // ARITY, -(-count // ARITY)
                if step >= least or count == 1:
                    out.extend((tree, level + step, first + at, count, bytes.fromhex(digest)) for at, digest in enumerate(digests))
        return pd.DataFrame(out, columns=["_tree", "_level", "_index", "_nodes", "_digest"])

    return nodes.groupBy("_one", "_two").applyInPandas(climb, NODE)


def _upper(nodes: DataFrame, level: int, most: int, levels: int) -> list[DataFrame]:
    """Tables of all nodes from ``level`` up to the roots, raised in rounds from those of ``level``; ``most`` is the largest tree's number of them."""
    found = []
    while most > 1:
        grouped = nodes.withColumns({"_one": F.col("_tree"), "_two": F.floor(F.col("_index") / ARITY ** levels)})
        # Nodes that a round begins with are in the table of the round before.
        found.append(staged(_raise(grouped, level, levels, min(len(found), 1)), "nodes"))
        level, most = level + levels, -(-most // ARITY ** levels)
        nodes = found[-1].where((F.col("_level") == level) & (F.col("_nodes") > 1))
    return found


def build(
    documents: DataFrame, id_column: str = "doc_id", source_column: str = "source", fields: tuple[str, ...] = FIELDS, *,
    claim: Column | None = None, stretch_levels: int = STRETCH_LEVELS, part_rows: int = PART_ROWS,
) -> Manifest:
    """The trees over every row of ``documents``. ``claim`` is a digest in hex that a row claims as its leaf, by default its own.

    A leaf is made of ``fields``; null counts as itself, unlike the empty text. Null ids come first in a source, and
    rows that repeat an id are ordered by their leaves, so rows that are the same in all ``fields`` are leaves each.
    Texts of any length are hashed whole and never move. Other columns are ignored, whatever their names.
    """
    ready(documents.sparkSession)
    leaf = leaf_digest([F.col(f"`{name}`") for name in fields])
    rows = documents.select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{source_column}`").cast("string").alias("_source"), F.unhex(leaf).alias("_leaf"),
        F.unhex(leaf if claim is None else F.coalesce(claim, leaf)).alias("_claim"), F.monotonically_increasing_id().alias("_salt"),
    )
    stretch = ARITY ** stretch_levels
    leaves, sources = _ranked(staged(rows, "leaves"), stretch, part_rows)
    first = staged(_raise(leaves.select(
        "_one", "_two", "_tree", F.col("_rank").alias("_index"), F.col("_count").alias("_nodes"), F.col("_leaf").alias("_digest"),
    ), 0, stretch_levels, stretch_levels), "first-nodes")
    most = leaves.agg(F.max("_count")).first()[0] or 0
    # Sources of more than one stretch go on; their nodes there are what their stretches fetch.
    large = first.where("_nodes > 1")
    tables = _upper(large, stretch_levels, -(-most // stretch), stretch_levels)
    roots = first.where("_nodes = 1")
    for table in tables:
        roots = roots.unionByName(table.where("_nodes = 1"))
    tops = roots.select(
        F.lit(TOP).cast("bigint").alias("_tree"), F.lit(0).alias("_level"), F.col("_tree").alias("_index"),
        F.lit(sources).cast("bigint").alias("_nodes"), "_digest",
    )
    tables += _upper(staged(tops, "source-roots"), 0, sources, stretch_levels)
    nodes = documents.sparkSession.createDataFrame([], NODE)
    for table in tables:
        nodes = nodes.unionByName(table)

    def lacks(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        count = -(-int(group["_count"].iloc[0]) // stretch)
        if count > 1:
            out = [(int(group["_tree"].iloc[0]), stretch_levels + up, index) for up, index in missing(group["_two"].unique(), count)]
        out += [(TOP, up, index) for up, index in missing(group["_tree"].to_numpy(np.int64), sources)]
        return pd.DataFrame([(group["_one"].iloc[0], group["_two"].iloc[0], *node) for node in out], columns=["_one", "_two", "_tree", "_level", "_index"])

    trees = leaves.groupBy("_one", "_two", "_tree").agg(F.first("_count").alias("_count"))
    wanted = staged(trees.groupBy("_one", "_two").applyInPandas(lacks, "_one bigint, _two bigint, _tree bigint, _level int, _index bigint"), "wanted-nodes")
    return Manifest(leaves, nodes, wanted, sources, stretch_levels)


class _Group:
    """What a group of leaves can derive once the nodes it lacks are there."""

    def __init__(self, leaves: pd.DataFrame, fetched: pd.DataFrame, sources: int, levels: int) -> None:
        self.sources, self.levels = sources, levels
        self.known = {(tree, level, index): digest.hex() for tree, level, index, digest in zip(fetched["_tree"], fetched["_level"], fetched["_index"], fetched["_digest"])}
        self.trees = {}
        for tree, own in leaves.sort_values("_rank", kind="stable").groupby("_tree"):
            count, first, digests = int(own["_count"].iloc[0]), int(own["_rank"].iloc[0]), [digest.hex() for digest in own["_leaf"]]
            for step in range(levels_up(count, levels) + 1):
                if step:
                    digests, first = above(digests), first // ARITY
                self.known.update(((tree, step, first + at), digest) for at, digest in enumerate(digests))
            self.trees[int(tree)] = own
        # What lies between is derived once for all leaves of the group.
        for tree, own in self.trees.items():
            count = int(own["_count"].iloc[0])
            index, level = int(own["_rank"].iloc[0]), levels_up(count, levels)
            for step in range(level):
                index, count = index // ARITY, -(-count // ARITY)
            while count > 1:
                index, count, level = index // ARITY, -(-count // ARITY), level + 1
                self.known[tree, level, index] = combine(self.run(tree, level - 1, index, -(-int(own["_count"].iloc[0]) // ARITY ** (level - 1))))
            self.known[TOP, 0, tree] = self.known[tree, level, 0]
        held, count, level = {tree for tree in self.trees}, sources, 0
        while count > 1:
            held = {index // ARITY for index in held}
            for index in held:
                self.known[TOP, level + 1, index] = combine(self.run(TOP, level, index, count))
            count, level = -(-count // ARITY), level + 1
        self.root = self.known[TOP, level, 0]

    def run(self, tree: int, level: int, parent: int, count: int) -> list[str]:
        return [self.known[tree, level, index] for index in range(parent * ARITY, min(parent * ARITY + ARITY, count))]

    def path(self, tree: int, index: int, level: int, count: int) -> list[tuple[list[str], list[str]]]:
        """The siblings to the left and right of a node and of all above it, up to the root of its tree."""
        found = []
        while count > 1:
            run, at = self.run(tree, level, index // ARITY, count), index % ARITY
            found.append((run[:at], run[at + 1:]))
            index, count, level = index // ARITY, -(-count // ARITY), level + 1
        return found

    def proofs(self) -> Iterator[tuple[pd.DataFrame, str, list]]:
        """The leaves of each tree, its root, and the path of each leaf. Steps above the first are made once for all leaves below."""
        for tree, own in self.trees.items():
            count = int(own["_count"].iloc[0])
            shared = self.path(TOP, tree, 0, self.sources)
            upper: dict[int, list] = {}
            paths = []
            for rank in own["_rank"].tolist():
                if count == 1:
                    paths.append(shared)
                    continue
                parent = rank // ARITY
                if parent not in upper:
                    upper = {parent: self.path(tree, parent, 1, -(-count // ARITY)) + shared}
                run, at = self.run(tree, 0, parent, count), rank % ARITY
                paths.append([(run[:at], run[at + 1:]), *upper[parent]])
            yield own, self.known[TOP, 0, tree], paths


def fold_path(digest: str, path: list[tuple[list[str], list[str]]]) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in path:
        digest = combine([*left, digest, *right])
    return digest


def proofs(manifest: Manifest, id_column: str = "doc_id", *, whole: bool = False) -> DataFrame:
    """One row per leaf: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``; ``proof`` too if ``whole``.

    ``proof`` holds the digests of all siblings, level by level from the leaf to the root, left to right, as one text in
    hex, and ``proof_sha256`` is its digest. ``folded_root`` is what the claimed leaf gives with them, and is verified if
    it is the root. A run of one node has no siblings, and its parent is the digest over it alone; one row in all is
    leaf, subroot and root with an empty proof. An empty table gives an empty result.
    """
    sources, levels = manifest.sources, manifest.stretch_levels
    asked = manifest.wanted.join(manifest.nodes.select("_tree", "_level", "_index", "_digest"), ["_tree", "_level", "_index"])
    fetched = staged(asked.select(F.col("_one").alias("_of"), F.col("_two").alias("_of_two"), "_tree", "_level", "_index", "_digest"), "fetched-nodes")

    def expand(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        group, out = _Group(leaves, nodes, sources, levels), []
        for own, subroot, paths in group.proofs():
            for key, leaf, claim, path in zip(own["_id"], own["_leaf"], own["_claim"], paths):
                proof, folded = "".join(["".join(left + right) for left, right in path]), fold_path(claim.hex(), path)
                out.append((
                    key, leaf.hex(), subroot, group.root, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == group.root,
                    proof if whole else None,
                ))
        return pd.DataFrame(out, columns=["_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "proof"])

    # Ids as text: pandas would turn longs into doubles where some are null.
    leaves = manifest.leaves.withColumn("_id", F.col("_id").cast("string"))
    found = leaves.groupBy("_one", "_two").cogroup(fetched.groupBy("_of", "_of_two")).applyInPandas(
        expand, "_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, proof string",
    )
    found = found.withColumn("_id", F.col("_id").cast(manifest.leaves.schema["_id"].dataType)).withColumnRenamed("_id", id_column)
    return found if whole else found.drop("proof")
