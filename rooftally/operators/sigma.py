"""Grouped mean ± nσ fences.

A group may hold a third of all rows, so nothing here moves a large group's rows
together: the statistics are a two-step aggregate, those of large groups go back to
the rows by broadcast, and only rows of small groups are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import OUTLIER_SIGMA
from ..staging import run_folder, stage

# A group with more than this share of the rows counts as heavy.
HEAVY_SHARE = 0.001

STAT_COLUMNS = ("n", "mu", "sigma")
# All rows of a group, whether their value counts or not.
ROWS_COLUMN = "_rows"


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def group_stats(
    df: DataFrame, value: str, by: str | Sequence[str], among: Column | None = None,
) -> DataFrame:
    """All rows, counted rows, mean and population deviation of ``value`` per group; ``among`` says which rows count.

    ``among`` is applied inside the aggregates: as a filter it would be pushed
    below the projections that compute it and be evaluated twice. Groups without
    a counted value are kept, as their rows must be placed as well.
    """
    counted = F.col(value) if among is None else F.when(among, F.col(value))
    return df.groupBy(*_keys(by)).agg(
        F.count(F.lit(1)).alias(ROWS_COLUMN),
        F.count(counted).alias("n"),
        F.avg(counted).alias("mu"),
        F.stddev_pop(counted).alias("sigma"),
    )


def reported(stats: DataFrame) -> DataFrame:
    """The statistics of groups that have any, without the count of all rows."""
    return stats.where("n > 0").drop(ROWS_COLUMN)


def sigma_stats(
    df: DataFrame, value: str, by: str | Sequence[str], among: Column | None = None,
) -> DataFrame:
    """Row count, mean and population deviation of ``value`` per group, over rows with ``among``."""
    return reported(group_stats(df, value, by, among))


def sigma_thresholds(stats: DataFrame, n_sigma: float = OUTLIER_SIGMA) -> DataFrame:
    """The statistics with the fence half-width, as reported after each run."""
    return stats.withColumn("threshold", F.lit(n_sigma) * F.col("sigma"))


def _renamed(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics under names that do not clash with the rows'; those of no counted value as null."""
    some = F.col("n") > 0
    return stats.select(
        *[F.col(key).alias(f"_stat_{key}") for key in keys],
        *[F.when(some, F.col(name)).alias(name) for name in STAT_COLUMNS],
    )


def _same_group(keys: list[str]) -> Column:
    """Null-safe equality: a null key is a group like any other."""
    return reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_stat_{key}")) for key in keys])


def attach_stats(df: DataFrame, stats: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Every row of ``df`` with its group's ``n``, ``mu``, ``sigma`` (null if no value of the group counts).

    ``stats`` is a table of :func:`group_stats`, best one that is written, since it is
    read for either half. Groups with more than ``HEAVY_SHARE`` of all rows, fewer
    than ``1 / HEAVY_SHARE`` by arithmetic, are broadcast. The others are small, so
    a shuffle join on the group key is even. Where ``stats`` has no small group, all
    groups are broadcast and the rows are read once.
    """
    keys = _keys(by)
    total, least = stats.agg(F.sum(ROWS_COLUMN), F.min(ROWS_COLUMN)).first()
    total = total or 0
    is_heavy = F.col(ROWS_COLUMN) > F.lit(total * HEAVY_SHARE)
    heavy, light = _renamed(stats.where(is_heavy), keys), _renamed(stats.where(~is_heavy), keys)
    same = _same_group(keys)
    if least is not None and least > total * HEAVY_SHARE:
        return df.join(F.broadcast(heavy), same, "left").drop(*[f"_stat_{key}" for key in keys])
    in_heavy = df.join(F.broadcast(heavy), same, "inner")
    elsewhere = df.join(F.broadcast(heavy), same, "left_anti").join(light, same, "left")
    return in_heavy.unionByName(elsewhere).drop(*[f"_stat_{key}" for key in keys])


def is_outlier(value: str | Column, n_sigma: float = OUTLIER_SIGMA) -> Column:
    """Strictly further than nσ from the mean; never true for a constant group."""
    column = F.col(value) if isinstance(value, str) else value
    outside = (F.col("sigma") > 0) & (F.abs(column - F.col("mu")) > F.lit(n_sigma) * F.col("sigma"))
    return F.coalesce(outside, F.lit(False))


def tag_outliers(df: DataFrame, value: str, by: str | Sequence[str], n_sigma: float = OUTLIER_SIGMA) -> DataFrame:
    """``df`` with its group statistics and a boolean ``is_outlier``."""
    stats = stage(group_stats(df, value, by), run_folder(df.sparkSession, "stats"))
    return attach_stats(df, stats, by).withColumn("is_outlier", is_outlier(value, n_sigma))
