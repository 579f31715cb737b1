"""Warehouse sink: append a run's listings to an analytics table."""

from __future__ import annotations

import os
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import RUN_COLUMN, counting, replace_slice, slice_folder

# --- Fixed values: environment variables naming the parts of the table id. ---
PROJECT_VARIABLE = "BQ_PROJECT_ID"
DATASET_VARIABLE = "BQ_DATASET_ID"
TABLE_VARIABLE = "BQ_TABLE_ID"
# --- End of fixed values. ---

DEFAULT_PROJECT = "listings-project"
DEFAULT_DATASET = "listings_analytics"
DEFAULT_TABLE = "listings"


@dataclass(frozen=True)
class WarehouseStats:
    total_loaded: int
    rows_inserted: int
    table_id: str
    duration_seconds: float


def _part(given: str | None, variable: str, default: str) -> str:
    value = given if given is not None else os.getenv(variable, default)
    if not value:
        raise ValueError(f"{variable} is set to an empty string")
    return value


def table_id(project: str | None = None, dataset: str | None = None, table: str | None = None) -> str:
    """``project.dataset.table``; arguments win over the environment, that over the defaults."""
    return ".".join([
        _part(project, PROJECT_VARIABLE, DEFAULT_PROJECT),
        _part(dataset, DATASET_VARIABLE, DEFAULT_DATASET),
        _part(table, TABLE_VARIABLE, DEFAULT_TABLE),
    ])


def append_to_warehouse(
    df: DataFrame, run_id: str, path: str | None = None, format: str = "parquet",
    project: str | None = None, dataset: str | None = None, table: str | None = None,
) -> WarehouseStats:
    """Append ``df`` as the slice ``run_id``; repeating a run replaces its own slice only, an empty repeat included.

    With ``path`` the slice is written there as files of ``format`` (``parquet``
    or ``json``). Otherwise it goes to the session catalog's ``dataset_table``,
    the project being part of the reported id only. ``total_loaded`` counts the
    rows that came in, ``rows_inserted`` those that the table then has of the run.
    """
    started = time.monotonic()
    target = table_id(project, dataset, table)
    spark = df.sparkSession
    if path is not None:
        came = replace_slice(df, path, run_id, format)
        stored = spark.read.schema(df.schema).format(format).load(slice_folder(path, run_id)).count()
    else:
        _, dataset_part, table_part = target.rsplit(".", 2)
        name = f"{dataset_part}_{table_part}"
        counted, seen = counting(df)
        if spark.catalog.tableExists(name):
            # The writer's insertInto ignores the overwrite mode; naming the partition does not.
            columns = [c for c in spark.table(name).columns if c != RUN_COLUMN]
            spark.sql(
                f"INSERT OVERWRITE TABLE {name} PARTITION ({RUN_COLUMN} = :run) SELECT * FROM {{rows}}",
                args={"run": run_id}, rows=counted.select(*columns),
            )
        else:
            counted.withColumn(RUN_COLUMN, F.lit(run_id)).write.partitionBy(RUN_COLUMN).format(format).saveAsTable(name)
        came = seen.get["rows"]
        stored = spark.table(name).where(F.col(RUN_COLUMN) == run_id).count()
    return WarehouseStats(came, stored, target, round(time.monotonic() - started, 3))
