"""The nightly run over what has landed since the last one.

A re-aim of the nightly schedule, not a continuous pipeline: a file stream
remembers which landing files were taken, and one trigger hands all new ones to
the batch run as a single micro-batch. σ and keep-first cover that batch, as
they cover one night. Nothing is kept between runs.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.nightly import nightly_stages
from ..schema import SEQ_COLUMN
from ..sinks.warehouse import append_to_warehouse
from ..sources.landing import ordered_union, scan_json
from ..staging import discard, run_folder


# The only schema that the source has; columns that nobody asks for are not read.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def _stream(spark: SparkSession, folder: str, rank: int) -> DataFrame:
    """The landing files of a folder, by path alone: their content is not read here."""
    files = spark.readStream.format("binaryFile").schema(_FILES).load(folder)
    return files.select(F.lit(rank).alias("_rank"), "path")


def _literal_path(path: str) -> str:
    """``path`` with the characters escaped that would make it a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _stream_id(batch: DataFrame) -> str:
    """The id of the stream that ``batch`` belongs to, which Spark sets on the thread that hands it over."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_available(spark: SparkSession, landing: Sequence[str], table: str, progress: str) -> None:
    """Process every landing file not seen yet and append the survivors to ``table``.

    ``landing`` holds one folder of JSON lines per source, in rank order;
    ``progress`` is the stream's checkpoint. The run id is the stream's id, which
    the checkpoint keeps, and the number of the micro-batch: a batch repeated after
    a failure replaces its own slice, and streams that share a table do not meet.
    """
    def load(batch: DataFrame, number: int) -> None:
        # Rows handed over by the stream come through an RDD, which copies every field once more and hides the
        # scan from the optimizer. So the stream hands over paths, and the files are scanned like any landing.
        arrived = defaultdict(list)
        for file in batch.collect():
            arrived[file["_rank"]].append(_literal_path(file["path"]))
        scans = [scan_json(spark, files, rank) for rank, files in sorted(arrived.items())]
        folder = run_folder(spark, "incremental-run")
        unique = nightly_stages([ordered_union(*scans)], folder).unique
        append_to_warehouse(unique.drop(SEQ_COLUMN), f"{_stream_id(batch)}-{number}", table)
        discard(spark, folder)

    arriving = reduce(DataFrame.unionByName, [_stream(spark, f, rank) for rank, f in enumerate(landing)])
    query = (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
