"""Fixed-size batches over a global order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DOCUMENT_BATCH_LIMIT

INDEX_COLUMN = "_index"
BATCH_COLUMN = "batch_id"


@dataclass(frozen=True)
class NumberedRows:
    rows: DataFrame   # the input with `_index`, its 0-based position
    total: int


def write_in_order(df: DataFrame, order: str | Sequence[str], folder: str) -> DataFrame:
    """``df`` sorted by ``order`` and written to ``folder``, a file for each range; returns the table read back."""
    order = [order] if isinstance(order, str) else list(order)
    df.sort(*order).write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def number_written(written: DataFrame) -> NumberedRows:
    """Number the rows of a table of :func:`write_in_order` by their place in it.

    A row's number is the count of rows in earlier files plus its place in its
    own. The per-file counts come from file footers, and there are at most
    ``spark.sql.shuffle.partitions`` of them.
    """
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    placed = written.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_place"))

    counts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("_part")
    starts, total = [], 0
    for n in counts["n"].to_pylist():
        starts.append(total)
        total += n
    offsets = written.sparkSession.createDataFrame(
        pa.table({"_file": counts["_part"].cast(pa.int32()), "_start": pa.array(starts, pa.int64())})
    )
    rows = (
        placed.join(F.broadcast(offsets), F.col("_part") == F.col("_file"))
        .withColumn(INDEX_COLUMN, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_file", "_start")
    )
    return NumberedRows(rows, total)


def number_in_order(df: DataFrame, order: str | Sequence[str], folder: str) -> NumberedRows:
    """Number all rows by their place in ``order``, using a sorted table written to ``folder``."""
    return number_written(write_in_order(df, order, folder))


def assign_batches(numbered: DataFrame, size: int = DOCUMENT_BATCH_LIMIT) -> DataFrame:
    """Rows with ``batch_id``, counted from 1: consecutive runs of ``size`` rows."""
    return numbered.withColumn(BATCH_COLUMN, F.expr(f"{INDEX_COLUMN} div {int(size)} + 1"))


def batch_sizes(batched: DataFrame) -> DataFrame:
    return batched.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1)).alias("n_documents"))


def batch_count(total: int, size: int = DOCUMENT_BATCH_LIMIT) -> int:
    return -(-total // size)
