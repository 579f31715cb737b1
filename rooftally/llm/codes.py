"""Product quantization of vectors by dual-tree Lloyd rounds over whole numbers.

Vectors become integers and are cut into parts; each part position has a codebook. Rows are gathered
into blocks, and each block's parts are put into a tree of boxes with the sums of what lies below, written
once and used in every round. A round descends a block's tree and the tree of the codebook's entries
together: of the entry nodes that are left for a point node, those whose nearest corner is farther than
some other's farthest go. Where one entry is left the node's cached sum is assigned whole; leaves that
remain uncertain are compared in exact integers. Tasks send the sums of each entry, so all that moves in
a round is a codebook's size a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, staged

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK = 2_048           # rows to a block
LEAF = 32               # points of a leaf at least
LARGEST = 1 << 26       # magnitude of components, below which squared distances of up to 256 of them fit a long
EXACT = 1 << 52         # sums of products below this are exact in doubles


@dataclass
class BoxTree:
    """A tree of boxes over points. Level ``l`` has 2 ** l nodes; node ``i`` holds the places from ``n * i >> l`` of ``points``, which stand in its order."""

    order: np.ndarray       # the place of each point before the tree was made
    points: np.ndarray
    low: list[np.ndarray]   # by level
    high: list[np.ndarray]
    sums: list[np.ndarray]

    @property
    def depth(self) -> int:
        return len(self.low) - 1

    def starts(self, level: int) -> np.ndarray:
        """Where the nodes of ``level`` begin, and the end."""
        return len(self.points) * np.arange((1 << level) + 1) >> level


def grow(points: np.ndarray, leaf: int) -> BoxTree:
    """A tree whose nodes are halved along their widest side, down to ``leaf`` points at least."""
    order = np.arange(len(points))
    tree = BoxTree(order, points, [], [], [])
    for level in range(max(1, len(points) // leaf).bit_length()):
        bounds = tree.starts(level)
        tree.low.append(np.minimum.reduceat(tree.points, bounds[:-1]))
        tree.high.append(np.maximum.reduceat(tree.points, bounds[:-1]))
        if len(points) >> (level + 1) >= leaf:
            node = np.repeat(np.arange(1 << level), np.diff(bounds))
            widest = (tree.high[level] - tree.low[level]).argmax(axis=1)
            chosen = np.lexsort((tree.points[np.arange(len(points)), widest[node]], node))
            tree.order, tree.points = tree.order[chosen], tree.points[chosen]
    tree.sums = [np.add.reduceat(tree.points, tree.starts(level)[:-1]) for level in range(len(tree.low))]
    return tree


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, exact."""
    largest = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * largest * largest < EXACT:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    found = (points * points).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(axis=1)
    return found.astype(np.int64)


def descend(tree: BoxTree, book: BoxTree) -> tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Point nodes with one entry left, as (level, nodes, entries), and (leaf, entry node) pairs that stay uncertain."""
    done, at, under = [], 0, 0
    node, other = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        low, high = tree.low[at][node], tree.high[at][node]
        low_other, high_other = book.low[under][other], book.high[under][other]
        gap = np.maximum(0, np.maximum(low - high_other, low_other - high))
        reach = np.maximum(high - low_other, high_other - low)
        near, far = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        best = np.full(1 << at, np.iinfo(np.int64).max)
        np.minimum.at(best, node, far)
        # Entries at equal distances stay, since the lowest index must win.
        left = near <= best[node]
        node, other = node[left], other[left]
        single = np.bincount(node, minlength=1 << at)[node] == 1
        if under == book.depth:
            single &= np.diff(book.starts(under))[other] == 1
            if single.any():
                done.append((at, node[single], book.order[book.starts(under)[other[single]]]))
                node, other = node[~single], other[~single]
        if at == tree.depth and under == book.depth or not len(node):
            return done, node, other
        if at < tree.depth:
            at += 1
            node, other = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([other, other])
        if under < book.depth:
            under += 1
            node, other = np.concatenate([node, node]), np.concatenate([2 * other, 2 * other + 1])


def nearest(tree: BoxTree, book: BoxTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest entry of each point in the tree's order, ties to the lower index; and for each entry its points' sum and number."""
    codes = np.zeros(len(tree.points), np.int64)
    sums, counts = np.zeros_like(entries), np.zeros(len(entries), np.int64)
    done, node, other = descend(tree, book)
    for level, nodes, chosen in done:
        bounds = tree.starts(level)
        np.add.at(sums, chosen, tree.sums[level][nodes])
        np.add.at(counts, chosen, np.diff(bounds)[nodes])
        for one, entry in zip(nodes.tolist(), chosen.tolist()):
            codes[bounds[one]:bounds[one + 1]] = entry
    by_node = np.argsort(node, kind="stable")
    node, other = node[by_node], other[by_node]
    bounds, held = tree.starts(tree.depth), book.starts(book.depth)
    for one in np.unique(node).tolist():
        first, last = np.searchsorted(node, [one, one + 1])
        candidates = np.sort(np.concatenate([book.order[held[k]:held[k + 1]] for k in other[first:last].tolist()]))
        points = tree.points[bounds[one]:bounds[one + 1]]
        found = candidates[squared(points, entries[candidates]).argmin(axis=1)]
        codes[bounds[one]:bounds[one + 1]] = found
        np.add.at(sums, found, points)
        np.add.at(counts, found, 1)
    return codes, sums, counts


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, parts: int) -> DataFrame:
    """``_id``, ``_label`` and ``_vector`` (whole numbers) of the rows that can be coded."""
    vector = F.col(f"`{vector_column}`")
    held = vectors.where(vector.isNotNull()).select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label_column}`").alias("_label"), F.transform(vector, lambda x: x.cast("double") * SCALE).alias("_scaled"),
    )
    # Also false for null, infinities and what is not a number, which Spark orders above every other.
    fine = held.where(F.forall("_scaled", lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))).where(
        (F.size("_scaled") > 0) & (F.size("_scaled") % parts == 0)
    )
    return fine.select("_id", "_label", F.transform("_scaled", lambda x: F.floor(x)).alias("_vector"))


def _blocks(rows: DataFrame, parts: int, block: int) -> DataFrame:
    """``_ids``, ``_labels`` and ``_trees`` (a tree for each part, as bytes) of every block of rows."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                own = batch.slice(start, block)
                values = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(own.num_rows, -1)
                trees = [_packed(grow(np.ascontiguousarray(part), LEAF)) for part in np.split(values, parts, axis=1)]
                ends = pa.array([0, own.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(ends, own.column(0)), pa.ListArray.from_arrays(ends, own.column(1)),
                    pa.array([trees], pa.list_(pa.struct([(name, pa.binary()) for name in ("order", "points", "low", "high", "sums")]))),
                ], ["_ids", "_labels", "_trees"])

    types = {name: kind.simpleString() for name, kind in ((f.name, f.dataType) for f in rows.schema.fields)}
    schema = (
        f"_ids array<{types['_id']}>, _labels array<{types['_label']}>, "
        "_trees array<struct<order: binary, points: binary, low: binary, high: binary, sums: binary>>"
    )
    return staged(rows.select("_id", "_label", "_vector").mapInArrow(gather, schema), "vector-blocks")


def _packed(tree: BoxTree) -> dict[str, bytes]:
    levels = {name: np.concatenate(getattr(tree, name)) for name in ("low", "high", "sums")}
    return {
        "order": tree.order.astype("<i4").tobytes(), "points": tree.points.astype("<i4").tobytes(),
        **{name: values.astype("<i8" if name == "sums" else "<i4").tobytes() for name, values in levels.items()},
    }


def _unpacked(raw: dict[str, bytes], width: int) -> BoxTree:
    def table(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(raw[name], kind).astype(np.int64).reshape(-1, width)

    def levels(values: np.ndarray) -> list[np.ndarray]:
        return [values[(1 << level) - 1:(2 << level) - 1] for level in range((len(values) + 1).bit_length() - 1)]

    order = np.frombuffer(raw["order"], "<i4").astype(np.int64)
    return BoxTree(order, table("points", "<i4"), levels(table("low", "<i4")), levels(table("high", "<i4")), levels(table("sums", "<i8")))


def _round(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: the floors of the means of the points nearest to each entry, or the entry itself if it has none."""
    parts, entries, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [grow(book, 1) for book in books]
        sums, counts = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for raw in batch.column(0):
                for part, one in enumerate(raw):
                    _, more, times = nearest(_unpacked(one.as_py(), width), trees[part], books[part])
                    sums[part] += more
                    counts[part] += times
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(part), pa.array(entry), pa.array(np.column_stack([counts[part, entry], sums[part, entry]]).tolist(), pa.list_(pa.int64())),
        ], ["part", "entry", "sums"])

    # At most one row for each entry a task, and the size of the codebooks in all, whatever the number of rows.
    sent = blocks.select("_trees").mapInArrow(assign, "part bigint, entry bigint, sums array<bigint>")
    totals = sent.select("part", "entry", F.posexplode("sums").alias("place", "sum")).groupBy("part", "entry", "place").agg(F.sum("sum").alias("sum")).toPandas()
    table = np.zeros((parts, entries, width + 1), np.int64)
    table[totals["part"], totals["entry"], totals["place"]] = totals["sum"]
    counts = table[:, :, :1]
    return np.where(counts > 0, table[:, :, 1:] // np.maximum(counts, 1), books)


@dataclass
class Codebooks:
    """``entries``: whole numbers by part, entry and place within the part."""

    entries: np.ndarray

    def digest(self) -> str:
        """The SHA-256 of all numbers in decimal, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def learn(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", *,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
) -> tuple[Codebooks, DataFrame]:
    """Codebooks of ``parts`` times at most ``entries`` entries, and the blocks of rows they were made from, for :func:`encode`.

    A vector that is null, empty or holds a null, a component that is not finite, or one whose whole number
    reaches 2 ** 26 (squared distances might not fit a long) is left out; so is one whose length ``parts`` does not
    divide, or that differs from the most frequent such length (the smaller of equally frequent ones). Entries begin as the rows
    of the smallest ids; null ids come last, and rows of one id are ordered by their vectors. With fewer rows
    than ``entries`` there are as many entries. Repeated rows count each.
    """
    ready(vectors.sparkSession)
    rows = usable(vectors, id_column, vector_column, label_column, parts)
    most = rows.groupBy(F.size("_vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    length = most["length"] if most else parts
    rows = rows.where(F.size("_vector") == length)
    first = rows.orderBy(F.asc_nulls_last("_id"), "_vector").limit(entries).select("_vector").collect()
    books = np.array([row["_vector"] for row in first], np.int64).reshape(-1, parts, length // parts).transpose(1, 0, 2)
    blocks = _blocks(rows, parts, block)
    if first:
        for _ in range(rounds):
            books = _round(blocks, books)
    return Codebooks(np.ascontiguousarray(books)), blocks


def encode(blocks: DataFrame, books: Codebooks) -> DataFrame:
    """``_id``, ``_label``, ``_code`` (hex digits of each part's entry) and ``_error`` (squared distance) of every row of ``blocks``."""
    entries = books.entries
    width = entries.shape[2]
    digits = len(f"{max(1, entries.shape[1] - 1):x}") + 1 & ~1

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [grow(book, 1) for book in entries if len(book)]
        for batch in batches:
            for at in range(batch.num_rows):
                ids, labels = batch.column(0)[at].values, batch.column(1)[at].values
                codes, error = np.zeros((len(ids), len(entries)), np.int64), np.zeros(len(ids), np.int64)
                for part, one in enumerate(batch.column(2)[at]):
                    tree = _unpacked(one.as_py(), width)
                    found, _, _ = nearest(tree, trees[part], entries[part])
                    away = tree.points - entries[part][found]
                    codes[tree.order, part] = found
                    error[tree.order] += (away * away).sum(axis=1)
                code = ["".join(f"{entry:0{digits}x}" for entry in row) for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(code), pa.array(error)], ["_id", "_label", "_code", "_error"])

    types = {field.name: field.dataType.elementType.simpleString() for field in blocks.schema.fields[:2]}
    return blocks.mapInArrow(assign, f"_id {types['_ids']}, _label {types['_labels']}, _code string, _error bigint")


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", *,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK,
) -> DataFrame:
    """One row per vector that can be coded (see :func:`learn`): id, ``code``, ``error``, ``label_error`` and ``codebooks_sha256``.

    ``label_error`` sums the errors of rows with the same label, null labels together. An empty table gives an empty
    result. Other columns are ignored, whatever their names.
    """
    books, blocks = learn(vectors, id_column, vector_column, label_column, parts=parts, entries=entries, rounds=rounds, block=block)
    coded = staged(encode(blocks, books), "codes")
    # Summed before the shuffle and written, so that the join can split the rows of a frequent label.
    sums = staged(coded.groupBy("_label").agg(F.sum("_error").alias("_sum")).select(F.col("_label").alias("_of"), "_sum"), "label-errors")
    return coded.join(sums, F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_column), F.col("_code").alias("code"), F.col("_error").alias("error"),
        F.col("_sum").alias("label_error"), F.lit(books.digest()).alias("codebooks_sha256"),
    )
