"""Screening of clean listings: spam first, then price outliers among the rest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.screening import outlier_reason, spam_reason
from ..schema import ERROR_COLUMN, LISTING_COLUMNS, OUTLIER_SIGMA, RAW_COLUMN
from ..staging import run_folder, stage
from .sigma import STAT_COLUMNS, attach_stats, group_stats, is_outlier

SPAM_COLUMN = "_spam"
REASON_COLUMN = "reason"


@dataclass(frozen=True)
class Validated:
    judged: DataFrame     # every input row with `_spam` and `reason`
    stats: DataFrame      # rows, n, μ, σ per deal type over the spam survivors, as written
    valid: DataFrame      # rows without a reason
    rejected: DataFrame   # listing struct, reason, and any carried columns


def _accepted(df: DataFrame) -> Column:
    """Rows that normalized; frames without an error column hold no others."""
    return F.col(ERROR_COLUMN).isNull() if ERROR_COLUMN in df.columns else F.lit(True)


def screen(df: DataFrame) -> DataFrame:
    """Rows with ``_spam``: the spam reason, null when there is none."""
    lowered = df.withColumn("_lowered", F.lower("description"))
    reason = spam_reason(F.col("city"), F.col("price"), F.col("_lowered"))
    return lowered.withColumn(SPAM_COLUMN, F.when(_accepted(df), reason)).drop("_lowered")


def price_stats(screened: DataFrame) -> DataFrame:
    """Statistics over the rows that passed the spam checks, outliers included."""
    return group_stats(screened, "price", "deal_type", among=_accepted(screened) & F.col(SPAM_COLUMN).isNull())


def judge(screened: DataFrame, stats: DataFrame, n_sigma: float = OUTLIER_SIGMA) -> DataFrame:
    """Rows with the final ``reason``. One pass: spam rows keep theirs, the rest are fenced."""
    fenced = attach_stats(screened, stats, "deal_type")
    outlier = F.when(
        _accepted(screened) & is_outlier("price", n_sigma),
        outlier_reason(F.col("price"), F.col("mu"), F.col("sigma"), n_sigma),
    )
    return fenced.withColumn(REASON_COLUMN, F.coalesce(F.col(SPAM_COLUMN), outlier)).drop(*STAT_COLUMNS)


def split_judged(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected ones; rows that failed to normalize are neither.

    The condition is kept in one piece: split up, its parts would be evaluated
    a second time below the statistics join.
    """
    failed = [ERROR_COLUMN] if ERROR_COLUMN in judged.columns else []
    internal = (*LISTING_COLUMNS, SPAM_COLUMN, REASON_COLUMN, ERROR_COLUMN, RAW_COLUMN)
    carried = [c for c in judged.columns if c not in internal]
    valid = F.coalesce(*map(F.col, [*failed, REASON_COLUMN])).isNull()
    return (
        judged.where(valid).select(*LISTING_COLUMNS, *carried),
        judged.where(F.col(REASON_COLUMN).isNotNull())
        .select(F.struct(*LISTING_COLUMNS).alias("listing"), REASON_COLUMN, *carried),
    )


def validate(df: DataFrame) -> Validated:
    screened = screen(df)
    stats = stage(price_stats(screened), run_folder(df.sparkSession, "stats"))
    judged = judge(screened, stats)
    valid, rejected = split_judged(judged)
    return Validated(judged=judged, stats=stats, valid=valid, rejected=rejected)
