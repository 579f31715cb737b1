"""Landing-zone scans and the ordered union of sources.

Every scan adds ``_seq``, the row's place in the ordered input, because later
stages keep the first of several copies and a DataFrame has no order of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import open_variants
from ..operators.normalize import MALFORMED_COLUMN
from ..schema import LISTING_COLUMNS, SEQ_COLUMN

# A landing record may hold any JSON type in any field, so all fields are VARIANT.
BRONZE = T.StructType(
    [T.StructField(name, T.VariantType()) for name in LISTING_COLUMNS]
    + [T.StructField(MALFORMED_COLUMN, T.StringType())]
)


def sequence_column(rank: int | Column, file: Column, block: Column, row: Column) -> Column:
    rank = F.lit(rank) if isinstance(rank, int) else rank
    return F.struct(
        rank.cast("int").alias("source_rank"),
        file.alias("file"),
        block.cast("bigint").alias("block"),
        row.cast("bigint").alias("row"),
    ).alias(SEQ_COLUMN)


def _tagged(df: DataFrame, source: str | None, sequence: Column) -> DataFrame:
    columns = [c for c in df.columns if not (source is not None and c == "source")]
    tag = [] if source is None else [F.lit(source).alias("source")]
    return df.select(*columns, *tag, sequence)


def scan_json(spark: SparkSession, path: str | list[str], rank: int, source: str | None = None) -> DataFrame:
    """Newline-delimited JSON, one record per line.

    Lines have no number, but a split is read front to back by one task. Its
    start offset orders splits within a file, and the running id, taken right
    on the scan, orders lines within a split; the ids of different splits are
    never compared. So the order is file order whatever the split size.

    ``source`` tags the rows; without it the records' own ``source`` is used.
    """
    lines = spark.read.schema(BRONZE).option("columnNameOfCorruptRecord", MALFORMED_COLUMN).json(path)
    placed = lines.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
    )
    rows = open_lines(placed, rank, "_file", "_block")
    return rows if source is None else rows.withColumn("source", F.lit(source))


def open_lines(lines: DataFrame, rank: int | Column, file: str, block: str) -> DataFrame:
    """Scanned lines with their fields opened and their order key.

    Both in one projection: the running id keeps later filters above it, which
    would otherwise be pushed to the scan and open every field a second time.
    """
    order = sequence_column(rank, F.col(file), F.col(block), F.monotonically_increasing_id())
    return open_variants(lines, order).select(*LISTING_COLUMNS, MALFORMED_COLUMN, SEQ_COLUMN)


def scan_table(
    spark: SparkSession, path: str | list[str], rank: int, source: str | None = None, format: str = "parquet",
) -> DataFrame:
    """A typed landing table; parquet knows each row's index in its file."""
    rows = spark.read.format(format).load(path)
    index = F.col("_metadata.row_index") if format == "parquet" else F.monotonically_increasing_id()
    block = F.lit(0) if format == "parquet" else F.col("_metadata.file_block_start")
    return _tagged(rows, source, sequence_column(rank, F.col("_metadata.file_path"), block, index))


def with_sequence(df: DataFrame, rank: int | Column, row: str, source: str | None = None) -> DataFrame:
    """Rows that carry their own ingest sequence in column ``row`` (dropped).

    Several sources in one table are ordered by giving ``rank`` as a column.
    """
    order = sequence_column(rank, F.lit(""), F.lit(0), F.col(row))
    return _tagged(df, source, order).drop(row)


def ordered_union(*sources: DataFrame) -> DataFrame:
    """All rows of all sources, copies included; ``_seq`` carries the order."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def source_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
