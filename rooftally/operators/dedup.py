"""Keep-first deduplication in a declared order.

A DataFrame has no order, so callers name the columns that define it. Together
they must be non-null and differ for any two rows; ``_seq`` from the sources
does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identity import fingerprint
from ..schema import SEQ_COLUMN

FINGERPRINT_COLUMN = "fingerprint"


def _names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def with_fingerprint(df: DataFrame) -> DataFrame:
    key: Column = fingerprint(*map(F.col, ("city", "street", "rooms", "price", "deal_type")))
    return df.withColumn(FINGERPRINT_COLUMN, key)


def keep_first(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """The first row per key.

    Spark plans the ``= 1`` filter as a group limit before the shuffle too, so
    each map task sends one row per key: a key holding a third of the table
    reaches its reducer as one row per map task.
    """
    first = Window.partitionBy(*_names(keys)).orderBy(*_names(order))
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def later_copies(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """Every row that is not the first of its key.

    Rows are matched against the survivors on the order columns, which are
    unique, so copies of one hot key spread evenly; a window over the key would
    put all of them in one task.
    """
    survivors = keep_first(df.select(*{*_names(keys), *_names(order)}), keys, order)
    return df.join(survivors.select(*_names(order)), _names(order), "left_anti")


def copy_counts(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """One row: how many rows came in, how many are first, how many are copies."""
    per_key = df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_count"),
        F.count(F.lit(1)).alias("unique_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(F.lit(1))).alias("duplicate_count"),
    )


def deduplicate(df: DataFrame, order: str | Sequence[str] = SEQ_COLUMN) -> DataFrame:
    """Listings with their fingerprint, first of each in input order."""
    return keep_first(with_fingerprint(df), FINGERPRINT_COLUMN, order)
