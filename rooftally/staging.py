"""Stage tables in the cluster's shared folder.

A stage that several outputs read is written once and read back, so that
losing an executor never recomputes the stages before it and no output sees a
different version of the rows than another.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a temporary one. On a cluster
    a machine-local folder would be lost with its machine, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rooftally-"))
    return context.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path under the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` as parquet and return the table read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stage folder that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
