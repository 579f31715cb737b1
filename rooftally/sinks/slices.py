"""A folder with a slice of rows for each run."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

RUN_COLUMN = "run_id"


def slice_folder(path: str, run_id: str) -> str:
    """The folder of a run's slice, named as Spark names partitions."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run id {run_id!r} has characters other than letters, digits, '.', '_' and '-'")
    return f"{path.rstrip('/')}/{RUN_COLUMN}={run_id}"


def counting(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """``rows``, and a count of them that is taken by the job that writes them."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def replace_slice(rows: DataFrame, path: str, run_id: str, format: str) -> int:
    """Write ``rows`` as the slice of ``run_id``, an empty one included; other slices stay. Returns how many rows came in.

    The rows go to a folder that no reader sees, which takes the place of the old slice once it is whole, so a
    write that fails leaves the old slice as it was.
    """
    counted, seen = counting(rows)
    incoming, old = (f"{path.rstrip('/')}/_{name}-{uuid.uuid4().hex}" for name in ("incoming", "replaced"))
    counted.write.format(format).save(incoming)
    spark = rows.sparkSession
    new, aside, target = (spark._jvm.org.apache.hadoop.fs.Path(name) for name in (incoming, old, slice_folder(path, run_id)))
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(target) and not store.rename(target, aside):
        raise OSError(f"cannot replace {target.toString()}")
    if not store.rename(new, target):
        store.rename(aside, target)
        raise OSError(f"cannot put {incoming} in the place of {target.toString()}")
    store.delete(aside, True)
    return seen.get["rows"]
