from __future__ import annotations

import glob
import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from rooftally.operators import assign_batches, batch_sizes, number_in_order
from rooftally.sinks import append_to_warehouse, load_documents, table_id
from rooftally.sinks.documents import guard_batch
from rooftally.sinks.slices import replace_slice
from rooftally.staging import shared_folder


def _rows(spark, n, parts=7):
    """``n`` documents whose order is not the order they are stored in."""
    return spark.range(n).repartition(parts).select(
        F.concat(F.lit("d"), "id").alias("id"), (F.col("id") * 1000.0).alias("price"),
        F.struct(F.lit(0).alias("source_rank"), F.lit("").alias("file"), F.lit(0).cast("long").alias("block"),
                 F.col("id").alias("row")).alias("_seq"),
    )


# Executors cannot import this module, so the writer travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FolderWriter:
    """Test double of a document store: one file per committed batch."""

    def __init__(self, folder):
        self.folder = folder

    def commit(self, run_id, batch_id, documents):
        with open(f"{self.folder}/{run_id}-{batch_id}.json", "x") as file:
            json.dump([d["id"] for d in documents], file)

    def close(self):
        open(f"{self.folder}/closed", "w").close()


@pytest.mark.parametrize("n,batches", [(0, 0), (1, 1), (399, 1), (400, 1), (401, 2), (450, 2), (2000, 5)])
def test_batch_counts(spark, tmp_path, n, batches):
    numbered = number_in_order(_rows(spark, n), "_seq", str(tmp_path / "sorted"))
    assert numbered.total == n
    sizes = {r.batch_id: r.n_documents for r in batch_sizes(assign_batches(numbered.rows)).collect()}
    assert sorted(sizes) == list(range(1, batches + 1))
    assert sum(sizes.values()) == n and all(size == 400 for b, size in sizes.items() if b < batches)


def test_numbers_follow_the_order(spark, tmp_path):
    rows = number_in_order(_rows(spark, 3000), "_seq", str(tmp_path / "sorted")).rows
    assert all(r.id == f"d{r._index}" for r in rows.collect())


def test_writer_commits_whole_batches_in_order(spark, tmp_path):
    folder = str(tmp_path / "store")
    os.mkdir(folder)
    stats = load_documents(_rows(spark, 1010), lambda: FolderWriter(folder), "r1", folder=str(tmp_path / "sorted"))
    assert (stats.total_loaded, stats.batch_count) == (1010, 3)
    assert round(stats.average_batch, 1) == 336.7 and stats.duration_seconds > 0
    for batch, size in ((1, 400), (2, 400), (3, 210)):
        with open(f"{folder}/r1-{batch}.json") as file:
            assert json.load(file) == [f"d{i}" for i in range((batch - 1) * 400, (batch - 1) * 400 + size)]
    assert os.path.exists(f"{folder}/closed")


def test_a_second_run_commits_beside_the_first(spark, tmp_path):
    folder = str(tmp_path / "store")
    os.mkdir(folder)
    for run, rows in (("r1", 450), ("r2", 100)):
        load_documents(_rows(spark, rows), lambda: FolderWriter(folder), run)
    assert sorted(name for name in os.listdir(folder) if name != "closed") == ["r1-1.json", "r1-2.json", "r2-1.json"]


def test_offline_documents(spark, tmp_path):
    stats = load_documents(_rows(spark, 450), str(tmp_path / "docs"), "r1", folder=str(tmp_path / "sorted"))
    assert (stats.total_loaded, stats.batch_count) == (450, 2)
    docs = spark.read.json(str(tmp_path / "docs" / "run_id=r1"))
    assert docs.count() == 450 and set(docs.columns) == {"id", "price", "batch_id"}
    assert docs.where("batch_id = 1").count() == 400


def test_offline_runs_are_kept_and_repeated_ones_replaced(spark, tmp_path):
    path = str(tmp_path / "docs")

    def counts():
        rows = spark.read.schema("id string, run_id string").json(path).groupBy("run_id").count().collect()
        return {r.run_id: r["count"] for r in rows}

    for run, rows in (("r1", 450), ("r2", 100), ("r1", 30)):
        load_documents(_rows(spark, rows), path, run)
    assert counts() == {"r1": 30, "r2": 100}
    load_documents(_rows(spark, 0), path, "r1")
    assert counts() == {"r2": 100}


def test_scratch_is_removed(spark, tmp_path):
    before = set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/documents-*"))
    load_documents(_rows(spark, 450), str(tmp_path / "docs"), "r1")
    assert set(glob.glob(f"{shared_folder(spark).removeprefix('file:')}/documents-*")) == before


def test_nothing_to_load(spark, tmp_path):
    opened = []
    stats = load_documents(_rows(spark, 0), lambda: opened.append(1), "r1", folder=str(tmp_path / "sorted"))
    assert (stats.total_loaded, stats.batch_count, stats.duration_seconds, stats.average_batch) == (0, 0, 0.0, 0.0)
    assert not opened
    load_documents(_rows(spark, 0), str(tmp_path / "docs"), "r1", folder=str(tmp_path / "sorted2"))
    assert spark.read.schema("id string").json(str(tmp_path / "docs")).count() == 0


@pytest.mark.parametrize("size", [0, 401, 500])
def test_batch_size_is_guarded_for_every_target(spark, tmp_path, size):
    opened = []
    for target in (str(tmp_path / "docs"), lambda: opened.append(1)):
        with pytest.raises(ValueError, match="limit of 400"):
            load_documents(_rows(spark, 500), target, "r1", batch_size=size)
    assert not opened and not os.path.exists(tmp_path / "docs")


def test_oversized_batch_is_refused():
    guard_batch(1, 400, 400)
    with pytest.raises(RuntimeError, match="batch 7 has 401"):
        guard_batch(7, 401, 400)


def test_run_ids_are_plain_names(spark, tmp_path):
    for run in ("", "a/b", "a=b", "a b"):
        with pytest.raises(ValueError, match="run id"):
            append_to_warehouse(_rows(spark, 1).drop("_seq"), run, str(tmp_path / "t"))


@pytest.mark.parametrize("n", [10, 500])
def test_warehouse_rows(spark, tmp_path, n):
    stats = append_to_warehouse(_rows(spark, n).drop("_seq"), "r1", str(tmp_path / "t"))
    assert stats.total_loaded == stats.rows_inserted == n and stats.duration_seconds > 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == n


def test_warehouse_appends_runs_and_replaces_a_repeated_one(spark, tmp_path):
    path = str(tmp_path / "t")
    append_to_warehouse(_rows(spark, 10).drop("_seq"), "r1", path)
    append_to_warehouse(_rows(spark, 20).drop("_seq"), "r2", path)
    stats = append_to_warehouse(_rows(spark, 12).drop("_seq"), "r1", path)
    assert stats.rows_inserted == 12
    counts = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"r1": 12, "r2": 20}


def test_warehouse_json_format(spark, tmp_path):
    append_to_warehouse(_rows(spark, 5).drop("_seq"), "r1", str(tmp_path / "t"), format="json")
    (line, *_), = [open(f).read().splitlines() for f in glob.glob(f"{tmp_path}/t/run_id=r1/*.json")][:1]
    assert set(json.loads(line)) == {"id", "price"}


def test_warehouse_catalog_table(spark):
    name = f"d{os.getpid()}_listings"
    try:
        for rows, run in ((10, "r1"), (20, "r2"), (15, "r1")):
            stats = append_to_warehouse(_rows(spark, rows).drop("_seq"), run, dataset=f"d{os.getpid()}", project="p")
            assert stats.rows_inserted == rows and stats.table_id == f"p.d{os.getpid()}.listings"
        assert spark.table(name).count() == 35
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_empty_warehouse_loads(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("BQ_TABLE_ID", "t")
    path = str(tmp_path / "t")
    for run, rows in (("r1", 0), ("r2", 7), ("r3", 5), ("r3", 0)):
        stats = append_to_warehouse(_rows(spark, rows).drop("_seq"), run, path)
        assert (stats.total_loaded, stats.rows_inserted, stats.table_id) == (rows, rows, table_id())
    rows = spark.read.schema("id string, run_id string").parquet(path).collect()
    assert {r.run_id for r in rows} == {"r2"} and len(rows) == 7


def test_empty_rerun_empties_the_catalog_slice(spark):
    name = f"e{os.getpid()}_listings"
    try:
        for rows, run in ((10, "r1"), (20, "r2"), (0, "r1")):
            stats = append_to_warehouse(_rows(spark, rows).drop("_seq"), run, dataset=f"e{os.getpid()}", project="p")
            assert stats.total_loaded == stats.rows_inserted == rows
        assert {r.run_id for r in spark.table(name).collect()} == {"r2"}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rows_that_do_not_arrive_show_in_the_statistics(spark, tmp_path, monkeypatch):
    """The two figures have sources of their own: what came in, and what the table holds."""
    from rooftally.sinks import warehouse
    monkeypatch.setattr(warehouse, "replace_slice", lambda df, *where: replace_slice(df.limit(6), *where) + 4)
    stats = append_to_warehouse(_rows(spark, 10).drop("_seq"), "r1", str(tmp_path / "t"))
    assert (stats.total_loaded, stats.rows_inserted) == (10, 6)


@pytest.mark.parametrize("variable,place", [("BQ_PROJECT_ID", 0), ("BQ_DATASET_ID", 1), ("BQ_TABLE_ID", 2)])
def test_table_id_parts(monkeypatch, variable, place):
    for name in ("BQ_PROJECT_ID", "BQ_DATASET_ID", "BQ_TABLE_ID"):
        monkeypatch.delenv(name, raising=False)
    default = table_id().split(".")
    assert len(default) == 3 and all(default)
    monkeypatch.setenv(variable, "mine")
    changed = table_id().split(".")
    assert changed[place] == "mine"
    assert [p for i, p in enumerate(changed) if i != place] == [p for i, p in enumerate(default) if i != place]
    assert table_id("a", "b", "c") == "a.b.c"
    monkeypatch.setenv(variable, "")
    with pytest.raises(ValueError, match=variable):
        table_id()


def test_a_failed_rerun_keeps_the_old_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_slice(_rows(spark, 10), path, "r1", "parquet") == 10
    broken = _rows(spark, 5).withColumn("id", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        replace_slice(broken, path, "r1", "parquet")
    assert spark.read.parquet(path).count() == 10
    assert replace_slice(_rows(spark, 3), path, "r1", "parquet") == 3
    assert spark.read.parquet(path).count() == 3
