"""Document sink: listings committed in batches of at most 400."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batches import (
    BATCH_COLUMN, INDEX_COLUMN, assign_batches, batch_count, number_written, write_in_order,
)
from ..schema import DOCUMENT_BATCH_LIMIT, SEQ_COLUMN
from ..staging import discard, run_folder
from .slices import replace_slice


class DocumentWriter(Protocol):
    """A client for a document store. One is opened per task, on the executor.

    Batch ids start at 1 in every run, so a batch is known by its run and its id.
    """

    def commit(self, run_id: str, batch_id: int, documents: list[dict]) -> None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class LoaderStats:
    total_loaded: int
    batch_count: int
    duration_seconds: float

    @property
    def average_batch(self) -> float:
        return self.total_loaded / self.batch_count if self.batch_count else 0.0


def guard_batch(batch_id: int, size: int, limit: int) -> None:
    if size > limit:
        raise RuntimeError(f"batch {batch_id} has {size} documents, more than the limit of {limit}")


def guard_size(batch_size: int, limit: int = DOCUMENT_BATCH_LIMIT) -> None:
    """Refuse batches that no target may take, before anything is written."""
    if not 1 <= batch_size <= limit:
        raise ValueError(f"batches of {batch_size} documents are outside 1 to the limit of {limit}")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Consecutive rows of equal batch id, across Arrow batch boundaries."""
    current, pending = None, []
    for rows in batches:
        for document in rows.to_pylist():
            batch_id = document.pop(BATCH_COLUMN)
            if batch_id != current and pending:
                yield current, pending
                pending = []
            current = batch_id
            pending.append(document)
    if pending:
        yield current, pending


def _committer(open_writer: Callable[[], DocumentWriter], run_id: str, limit: int):
    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, committed = None, []
        try:
            for batch_id, documents in _runs(batches):
                guard_batch(batch_id, len(documents), limit)
                writer = writer or open_writer()
                writer.commit(run_id, batch_id, documents)
                committed.append((batch_id, len(documents)))
        finally:
            if writer is not None:
                writer.close()
        yield pa.RecordBatch.from_pydict(
            {"batch_id": pa.array([b for b, _ in committed], pa.int64()),
             "n_documents": pa.array([n for _, n in committed], pa.int64())}
        )
    return commit


def _whole_batches(batched: DataFrame) -> DataFrame:
    """All rows of a batch in one task, in order. Batches are small, so tasks are even."""
    return batched.repartition(BATCH_COLUMN).sortWithinPartitions(BATCH_COLUMN, INDEX_COLUMN)


def load_documents(
    df: DataFrame, target: str | Callable[[], DocumentWriter], run_id: str,
    order: str = SEQ_COLUMN, batch_size: int = DOCUMENT_BATCH_LIMIT, folder: str | None = None,
    written: bool = False,
) -> LoaderStats:
    """Commit all rows in batches of ``batch_size``, consecutive in ``order``.

    ``target`` is a function opening a writer, or a path for offline use, where
    the documents land as JSON lines with their ``batch_id``, in a slice for each
    ``run_id``: other runs stay, and repeating a run replaces its own slice, an
    empty repeat included. A retried task commits its batches again under the same
    run and batch ids, so a writer should upsert. ``folder`` holds the sorted copy;
    by default a fresh one in the shared folder, removed at the end. With ``written``,
    ``df`` is itself a table that ``write_in_order`` wrote in this order, and is not copied.
    """
    started = time.monotonic()
    guard_size(batch_size)
    spark = df.sparkSession
    scratch = None if written else folder or run_folder(spark, "documents")
    numbered = number_written(df if written else write_in_order(df, order, scratch))
    batched = assign_batches(numbered.rows, batch_size)
    if isinstance(target, str):
        replace_slice(batched.drop(INDEX_COLUMN, order), target, run_id, "json")
        total, batches = numbered.total, batch_count(numbered.total, batch_size)
    elif numbered.total:
        commits = _whole_batches(batched).drop(INDEX_COLUMN, order).mapInArrow(
            _committer(target, run_id, DOCUMENT_BATCH_LIMIT), "batch_id bigint, n_documents bigint"
        )
        total, batches = commits.agg(F.sum("n_documents"), F.count(F.lit(1))).first()
    else:
        total, batches = 0, 0
    if folder is None and scratch is not None:
        discard(spark, scratch)
    return LoaderStats(total, batches, round(time.monotonic() - started, 3) if total else 0.0)
