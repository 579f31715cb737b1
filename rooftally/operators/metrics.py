"""Row counts per stage, as one-row DataFrames. Each is a single two-step aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ERROR_COLUMN
from .dedup import FINGERPRINT_COLUMN, copy_counts
from .validate import REASON_COLUMN, SPAM_COLUMN


def normalizer_counts(tagged: DataFrame) -> DataFrame:
    return tagged.agg(
        F.count(F.lit(1)).alias("input_count"),
        F.count_if(F.col(ERROR_COLUMN).isNull()).alias("output_count"),
    )


def spam_counts(screened: DataFrame) -> DataFrame:
    return screened.agg(
        F.count_if(F.col(SPAM_COLUMN).isNull()).alias("passed"),
        F.count_if(F.col(SPAM_COLUMN).isNotNull()).alias("rejected"),
    )


def validator_counts(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count(F.lit(1)).alias("input_count"),
        F.count_if(F.col(REASON_COLUMN).isNull()).alias("valid_count"),
        F.count_if(F.col(REASON_COLUMN).isNotNull()).alias("rejected_count"),
    )


def dedup_counts(fingerprinted: DataFrame) -> DataFrame:
    return copy_counts(fingerprinted, FINGERPRINT_COLUMN)


def reason_kind(reason: Column) -> Column:
    """The reason without its details: what comes before ``(`` or ``:``."""
    return F.trim(F.regexp_extract(reason, r"^[^(:]*", 0))


def rejects_by_kind(rejected: DataFrame) -> DataFrame:
    return (
        rejected.groupBy(reason_kind(F.col(REASON_COLUMN)).alias("reason_kind"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
