"""The nightly run: sources, normalize, validate, deduplicate, two sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.batches import write_in_order
from ..operators.dedup import FINGERPRINT_COLUMN, keep_first, later_copies, with_fingerprint
from ..operators.metrics import rejects_by_kind
from ..operators.normalize import Normalized, split_normalized, tag_normalized
from ..operators.sigma import reported
from ..operators.validate import REASON_COLUMN, SPAM_COLUMN, judge, price_stats, screen, split_judged
from ..schema import DOCUMENT_BATCH_LIMIT, ERROR_COLUMN, SEQ_COLUMN
from ..sinks.documents import DocumentWriter, LoaderStats, guard_size, load_documents
from ..sinks.warehouse import WarehouseStats, append_to_warehouse
from ..sources.landing import ordered_union, source_counts
from ..staging import discard, run_folder, stage


class NightlyStages:
    """The run up to its sinks, through stage tables in ``folder``.

    ``screened`` holds every input row, cleaned and spam-checked: the sources are
    parsed once, and statistics, verdicts and counts read only the columns they
    need from it. ``stats`` are written too, so those reported are those that
    judged. ``unique`` holds the survivors, and is written when first asked for,
    with ``in_order`` by :func:`write_in_order`, so that batches need no second copy.
    """

    def __init__(self, sources: Sequence[DataFrame], folder: str, in_order: bool = False) -> None:
        self.folder, self.in_order = folder, in_order
        # Normalizing is row by row, so each source is cleaned under its own column types and the union is of clean rows.
        self.screened = stage(screen(ordered_union(*map(tag_normalized, sources))), f"{folder}/screened")
        self.normalized: Normalized = split_normalized(self.screened)
        self.stats = stage(price_stats(self.screened), f"{folder}/stats")
        self.judged = judge(self.screened, self.stats)
        self.valid, self.rejected = split_judged(self.judged)
        self.fingerprinted = with_fingerprint(self.valid)

    @cached_property
    def unique(self) -> DataFrame:
        first, path = keep_first(self.fingerprinted, FINGERPRINT_COLUMN, SEQ_COLUMN), f"{self.folder}/unique"
        return write_in_order(first, SEQ_COLUMN, path) if self.in_order else stage(first, path)

    @property
    def duplicates(self) -> DataFrame:
        return later_copies(self.fingerprinted, FINGERPRINT_COLUMN, SEQ_COLUMN)


@dataclass(frozen=True)
class NightlyResult:
    folder: str                # holds the stage tables that the DataFrames below read
    quarantine: DataFrame
    stats: DataFrame           # n, μ, σ per deal type, the ones that judged the rows
    valid: DataFrame
    rejected: DataFrame
    unique: DataFrame
    duplicates: DataFrame      # evaluated only if used
    sources: DataFrame         # rows per source
    rejects: DataFrame         # rejects per kind of reason
    counts: dict[str, int]
    documents: LoaderStats | None
    warehouse: WarehouseStats | None

    def close(self) -> None:
        """Remove the stage tables. The DataFrames cannot be read after that; counts and sinks stay."""
        discard(self.unique.sparkSession, self.folder)


def nightly_stages(sources: Sequence[DataFrame], folder: str | None = None, in_order: bool = False) -> NightlyStages:
    return NightlyStages(sources, folder or run_folder(sources[0].sparkSession, "nightly"), in_order)


def run_nightly(
    sources: Sequence[DataFrame], run_id: str, folder: str | None = None,
    documents: str | Callable[[], DocumentWriter] | None = None,
    warehouse_path: str | None = None, warehouse_table: bool = False,
    batch_size: int = DOCUMENT_BATCH_LIMIT,
) -> NightlyResult:
    """Run everything. Both sinks read the written survivors, at the same time."""
    guard_size(batch_size)
    spark = sources[0].sparkSession
    stages = nightly_stages(sources, folder, in_order=documents is not None)
    folder, unique = stages.folder, stages.unique

    def to_documents() -> LoaderStats | None:
        if documents is None:
            return None
        return load_documents(unique, documents, run_id, batch_size=batch_size, written=True)

    def to_warehouse() -> WarehouseStats | None:
        if warehouse_path is None and not warehouse_table:
            return None
        return append_to_warehouse(unique.drop(SEQ_COLUMN), run_id, warehouse_path)

    # The sinks do not wait for each other; both read the same stage table.
    with ThreadPoolExecutor(2) as sinks:
        document_load = sinks.submit(inheritable_thread_target(spark)(to_documents))
        warehouse_load = sinks.submit(inheritable_thread_target(spark)(to_warehouse))
        counts = _counts(stages.judged, unique)

    return NightlyResult(
        folder=folder,
        quarantine=stages.normalized.quarantine,
        stats=reported(stages.stats),
        valid=stages.valid,
        rejected=stages.rejected,
        unique=unique.drop(SEQ_COLUMN),
        duplicates=stages.duplicates,
        sources=source_counts(stages.screened),
        rejects=rejects_by_kind(stages.rejected),
        counts=counts,
        documents=document_load.result(),
        warehouse=warehouse_load.result(),
    )


def _counts(judged: DataFrame, unique: DataFrame) -> dict[str, int]:
    """Counts of all stages: one pass over a few narrow columns, and one over file footers."""
    failed, spam = F.col(ERROR_COLUMN).isNotNull(), F.col(SPAM_COLUMN).isNotNull()
    rejected = F.col(REASON_COLUMN).isNotNull()
    counts = judged.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(~failed).alias("normalized"),
        F.count_if(failed).alias("quarantined"),
        F.count_if(spam).alias("spam_rejected"),
        F.count_if(~failed & ~spam).alias("spam_passed"),
        F.count_if(~failed & ~rejected).alias("valid"),
        F.count_if(rejected).alias("rejected"),
    ).first().asDict()
    survivors = unique.count()
    return {**counts, "unique": survivors, "duplicates": counts["valid"] - survivors}
