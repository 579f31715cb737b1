from .batches import BATCH_COLUMN, NumberedRows, assign_batches, batch_sizes, number_in_order, number_written, write_in_order
from .dedup import copy_counts, deduplicate, keep_first, later_copies, with_fingerprint
from .metrics import (
    dedup_counts, normalizer_counts, rejects_by_kind, reason_kind, spam_counts, validator_counts,
)
from .normalize import Normalized, normalize, tag_normalized
from .sigma import attach_stats, sigma_stats, sigma_thresholds, tag_outliers
from .validate import Validated, judge, screen, validate

__all__ = [
    "BATCH_COLUMN", "NumberedRows", "assign_batches", "batch_sizes", "number_in_order", "number_written", "write_in_order",
    "copy_counts", "deduplicate", "keep_first", "later_copies", "with_fingerprint",
    "dedup_counts", "normalizer_counts", "rejects_by_kind", "reason_kind", "spam_counts", "validator_counts",
    "Normalized", "normalize", "tag_normalized",
    "attach_stats", "sigma_stats", "sigma_thresholds", "tag_outliers",
    "Validated", "judge", "screen", "validate",
]
