"""Packing token sequences by non-negative least squares over length combinations.

Documents are cut into whole windows and a tail. Shallow combinations of two or three tail lengths
that fill a window exactly are enumerated, and their repeat counts solved for against the histogram
of tails, rounded down, and raised greedily while tails are left. Tails that no combination takes
follow one another in a stream that is cut at windows, so only its last sequence needs padding.

The histogram, the counts and the sums of each bucket are all that the driver sees; documents find
their sequence by their rank among tails of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ready, running_before, staged
from .tokenize import END_ID, as_bytes, batches_of, checksums_at, encoder, tokenizer_path

WINDOW_TOKENS = 1024
GRID = 32               # step of the shortest length in combinations of three
BUCKET_ROWS = 1 << 18   # documents to a bucket, about


def combinations(window: int, grid: int = GRID) -> np.ndarray:
    """Rows of up to three lengths, longest first and zero for none, that sum to ``window``."""
    pairs = [(window - short, short, 0) for short in range(1, window // 2 + 1)]
    triples = [
        (window - middle - short, middle, short)
        for short in range(grid, window // 3 + 1, grid) for middle in range(short, (window - short) // 2 + 1)
    ]
    return np.array(pairs + triples, dtype=np.int64).reshape(-1, 3)


def repeat_counts(histogram: np.ndarray, lengths: np.ndarray, sweeps: int = 400) -> np.ndarray:
    """Whole repeats of each combination that together use no length more often than ``histogram`` has it.

    Non-negative least squares by accelerated projected gradient, rounded down; then, most repeated
    first, each combination gives back what exceeds the histogram, and takes what is left of it.
    """
    bins = len(histogram)
    used = lengths.ravel()
    goal = histogram.astype(np.float64).copy()
    goal[0] = 0
    scale = max(goal.max(), 1.0)
    goal /= scale

    def uses(counts: np.ndarray) -> np.ndarray:
        total = np.bincount(used, np.repeat(counts, lengths.shape[1]), bins)
        total[0] = 0
        return total

    def pull(rest: np.ndarray) -> np.ndarray:
        return rest[lengths].sum(axis=1)

    probe = np.ones(len(lengths))
    for _ in range(30):
        probe = pull(uses(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    step = 1 / (1.05 * norm)
    counts = ahead = np.zeros(len(lengths))
    momentum = 1.0
    for _ in range(sweeps):
        rest = goal - uses(ahead)
        rest[0] = 0
        following = np.maximum(ahead + step * pull(rest), 0)
        grown = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        ahead = following + (momentum - 1) / grown * (following - counts)
        counts, momentum = following, grown
    wanted = np.floor(counts * scale + 1e-6).astype(np.int64)
    left = histogram.astype(np.int64).copy()
    whole = np.zeros(len(lengths), dtype=np.int64)
    order = np.argsort(-counts, kind="stable")
    for limit in (wanted, None):
        for at in order:
            parts, times = np.unique(lengths[at][lengths[at] > 0], return_counts=True)
            most = int((left[parts] // times).min())
            take = most if limit is None else min(most, int(limit[at]))
            if take > 0:
                whole[at] += take
                left[parts] -= take * times
    return whole


@dataclass
class Plan:
    """Where the tails of each length go. A slot takes ranks from ``first`` on of ``length``."""

    window: int
    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    taken: np.ndarray       # for each length, how many tails the combinations take
    combined: int           # sequences made by combinations


def plan_packing(histogram: np.ndarray, window: int) -> Plan:
    lengths = combinations(window)
    counts = repeat_counts(histogram, lengths)
    chosen = np.flatnonzero(counts)
    taken = np.zeros(window, dtype=np.int64)
    slots, sequence = [], 0
    for at in chosen:
        offset = 0
        for length in lengths[at][lengths[at] > 0].tolist():
            slots.append((length, taken[length], sequence, offset))
            taken[length] += counts[at]
            offset += length
        sequence += int(counts[at])
    columns = np.array(sorted(slots), dtype=np.int64).reshape(-1, 4).T
    return Plan(window, *columns, taken, sequence)


def cut_texts(documents: DataFrame, id_column: str, text_column: str, window: int, tokenizer: str | None) -> DataFrame:
    """``_id``, ``_tokens``, ``_chunks`` (checksums of the whole windows), ``_tail`` (ids after them) and ``_length`` of it."""
    path = tokenizer or tokenizer_path()
    rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        width = 2 if own.vocabulary <= 1 << 16 else 4
        for whole in batches:
            for start, length in batches_of(whole.column(1)):
                batch = whole.slice(start, length)
                ids, bounds = own.encode(batch.column(1), END_ID)
                first, sizes = bounds[:-1], np.diff(bounds)
                windows, tails = sizes // window, sizes % window
                # Where whole windows begin and end, then where tails do, document after document.
                edges = np.repeat(first - window * (np.cumsum(windows) - windows), windows) + window * np.arange(windows.sum())
                sums = checksums_at(ids, edges, edges + window)
                kept = np.repeat(first + windows * window - (np.cumsum(tails) - tails), tails) + np.arange(tails.sum())
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(windows)]), pa.int32()), pa.array(sums, pa.int64()))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0), pa.array(sizes), lists, as_bytes(ids[kept], np.concatenate([[0], np.cumsum(tails)]), width), pa.array(tails),
                ], ["_id", "_tokens", "_chunks", "_tail", "_length"])

    ready(documents.sparkSession)
    schema = rows.selectExpr("_id", "0L _tokens", "cast(array() as array<bigint>) _chunks", "cast('' as binary) _tail", "0L _length").schema
    return rows.mapInArrow(cut, schema)


def pack(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, window: int = WINDOW_TOKENS, tokenizer: str | None = None,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``padded_length``.

    A document is its text's ids and the end id; null texts count as empty, so they are one id. Each id lies
    in one piece; sequences are filled from 0 without a gap, and all but one to the end. ``padded_length`` is
    ``window``, or what the last sequence holds where that is a power of two. Rows that repeat are packed each.
    Very long texts become many pieces, and an empty table gives none. Other columns are ignored, whatever their names.
    """
    spark = documents.sparkSession
    cut = staged(cut_texts(documents, id_column, text_column, window, tokenizer), "tails")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cut.count() // BUCKET_ROWS))
    # A length that a third of all rows share still comes in as many cells as there are buckets.
    rows = cut.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_tokens", "_tail"), F.lit(buckets)))
    cells = rows.groupBy("_bucket", "_length").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.size("_chunks")).alias("_windows"))
    cells = staged(cells, "cells")
    histogram = np.zeros(window, dtype=np.int64)
    for row in cells.groupBy("_length").agg(F.sum("_rows").alias("rows")).collect():
        histogram[row["_length"]] = row["rows"]
    plan = plan_packing(histogram, window)

    # Lengths that combinations take, as a column: at most one entry for each length.
    taken = F.element_at(F.array(*[F.lit(int(count)) for count in plan.taken]), (F.col("_length") + 1).cast("int"))
    before = F.coalesce(F.sum("_rows").over(Window.partitionBy("_length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("_before", before).withColumn("_first_left", F.greatest(F.col("_before"), taken)).withColumn(
        "_left", F.greatest(F.lit(0), F.col("_before") + F.col("_rows") - F.col("_first_left")) * F.col("_length"),
    )
    totals = staged(cells.groupBy("_bucket").agg(F.sum("_left").alias("_sum"), F.sum("_windows").alias("_whole")), "bucket-sums")
    streamed = int(totals.agg(F.sum("_sum")).first()[0] or 0)
    sums = running_before(running_before(totals, "_bucket", "_sum", "_bucket_left"), "_bucket", "_whole", "_bucket_windows")
    sums = sums.select("_bucket", "_bucket_left", "_bucket_windows")
    inside = Window.partitionBy("_bucket").orderBy("_length").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumns({
        "_cell_left": F.coalesce(F.sum("_left").over(inside), F.lit(0)), "_cell_windows": F.coalesce(F.sum("_windows").over(inside), F.lit(0)),
    }).join(sums, "_bucket").select(
        "_bucket", "_length", "_before", "_first_left",
        (F.col("_cell_left") + F.col("_bucket_left")).alias("_stream"), (F.col("_cell_windows") + F.col("_bucket_windows")).alias("_window"),
    )
    within = Window.partitionBy("_bucket", "_length").orderBy("_id", "_tokens", "_tail")
    placed = rows.join(staged(cells, "cells"), ["_bucket", "_length"]).select(
        "_id", "_tokens", "_chunks", "_tail", "_length",
        (F.row_number().over(within) - 1 + F.col("_before")).alias("_rank"), "_first_left", "_stream",
        (F.col("_window") + F.sum(F.size("_chunks")).over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.size("_chunks")).alias("_window"),
    )
    width = 2 if encoder(tokenizer or tokenizer_path()).vocabulary <= 1 << 16 else 4
    emit = _Emit(plan, streamed, width)
    ready(spark)
    schema = cut.selectExpr(
        "_id", "0L start", "0L length", "0L ids_crc32", "0L doc_tokens", "0L sequence_id", "0L offset", "0L padded_length",
    ).schema
    return placed.mapInArrow(emit, schema).withColumnRenamed("_id", id_column)


@dataclass
class _Emit:
    """Turns documents with their ranks into pieces."""

    plan: Plan
    streamed: int
    width: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, window = self.plan, self.plan.window
        # Slots by length and rank: the last that begins at or before a tail's rank is its slot.
        step = int(plan.first.max(initial=0)) + 2
        keys = plan.length * step + plan.first
        stream_at, window_at = plan.combined, plan.combined + -(-self.streamed // window)
        last, rest = window_at - 1, self.streamed % window
        short = rest if rest and rest & (rest - 1) == 0 else window
        for batch in batches:
            ids = batch.column(0)
            tokens, chunks, tails, lengths, ranks, first_left, streams, windows = (batch.column(k).to_pylist() for k in range(1, 9))
            slots = np.searchsorted(keys, np.array(lengths, np.int64) * step + np.minimum(np.array(ranks, np.int64), step - 1), "right") - 1
            source, out = [], []
            for row, slot in enumerate(slots.tolist()):
                start = 0
                for crc in chunks[row]:
                    out.append((start, window, crc, tokens[row], window_at + windows[row] + start // window, 0, window))
                    start += window
                length, rank = lengths[row], ranks[row]
                if length:
                    raw = np.frombuffer(tails[row], f"<u{self.width}").astype("<u4").tobytes()
                    if rank < plan.taken[length]:
                        sequence = int(plan.sequence[slot] + rank - plan.first[slot])
                        out.append((start, length, zlib.crc32(raw), tokens[row], sequence, int(plan.offset[slot]), window))
                    else:
                        at, cut = streams[row] + (rank - first_left[row]) * length, 0
                        while cut < length:
                            size = min(length - cut, window - at % window)
                            sequence = stream_at + at // window
                            out.append((
                                start + cut, size, zlib.crc32(raw[4 * cut:4 * (cut + size)]), tokens[row], sequence, at % window,
                                short if sequence == last else window,
                            ))
                            at, cut = at + size, cut + size
                source.extend([row] * (len(out) - len(source)))
            columns = list(zip(*out)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(source, pa.int64())), *[pa.array(list(column), pa.int64()) for column in columns]],
                ["_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_length"],
            )
