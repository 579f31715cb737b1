"""Dirty listings derived from the order tables.

The test tables hold no listings, so orders are dressed as such, with the
faults the feeds show: stray whitespace, decimal commas, currency signs,
missing and garbled prices, tenfold prices, test postings, bad floors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEAL_TYPES, SOURCES
from ..sources.landing import with_sequence
from ..tables import read_table


_SALE, _RENT = DEAL_TYPES

_AMOUNT = """
  CASE WHEN o_orderkey % 89 = 0 THEN 50L WHEN o_orderkey % 41 = 0 THEN base * 10 ELSE base END
"""

_COLUMNS = (
    "o_orderkey AS seq",
    "concat('L', o_orderkey) AS id",
    f"if(o_orderkey % 5 < 3, '{SOURCES[0]}', '{SOURCES[1]}') AS source",
    "if(o_orderkey % 97 = 0, '   ', concat('  ', r_name, '   ', n_name, ' ')) AS city",
    "c_mktsegment AS neighborhood",
    "concat('רחוב  ', o_custkey % 40) AS street",
    f"if(o_orderkey % 2 = 0, '{_SALE}', '{_RENT}') AS deal_type",
    "o_orderpriority AS property_type",
    "concat(1 + o_orderkey % 3, if(o_orderkey % 4 < 2, ',5', '')) AS rooms",
    """CASE WHEN o_orderkey % 157 = 0 THEN 'abc' WHEN o_orderkey % 19 = 0 THEN ''
            ELSE string(o_orderkey % 31) END AS floor""",
    "if(o_orderkey % 163 = 0, '80,5', string(35 + o_orderkey % 246)) AS size_sqm",
    """CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'N/A'
            WHEN amount >= 1000 THEN concat('₪', amount div 1000, ',', lpad(string(amount % 1000), 3, '0'))
            ELSE concat('₪', amount) END AS price""",
    """CASE WHEN o_orderkey % 83 = 0 THEN 'This is a TEST  listing'
            WHEN o_orderkey % 79 = 0 THEN 'מודעת בדיקה' ELSE 'דירה  יפה' END AS description""",
    "date_format(o_orderdate, 'yyyy-MM-dd') AS scraped_at",
    "'03-5550142' AS agent_phone",
)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw listing per order, all dirty fields as text, ``seq`` numbering them."""
    orders, customer, nation, region = (
        read_table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")
    )
    # One file of one row group would be one task for all that follows. Without a number, so few bytes would be put together again.
    priced = orders.repartition(spark.sparkContext.defaultParallelism, "o_orderkey").selectExpr(
        "*", "bigint(floor(if(o_orderkey % 2 = 0, 800000 + o_totalprice * 10, 3000 + o_totalprice / 60))) AS base"
    )
    return (
        priced.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr("*", f"{_AMOUNT} AS amount")
        .selectExpr(*_COLUMNS)
    )


def raw_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw listings as one DataFrame per source, in rank order, with ``_seq``."""
    rows = raw_listings(spark, sf_dir)
    return [
        with_sequence(rows.where(F.col("source") == source), rank, "seq")
        for rank, source in enumerate(SOURCES)
    ]


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows and order as the union of :func:`raw_sources`, in one scan."""
    second = (F.col("source") == SOURCES[1]).cast("int")
    return with_sequence(raw_listings(spark, sf_dir), second, "seq")
