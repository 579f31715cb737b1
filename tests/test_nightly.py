"""Whole runs: expected counts, invariants, plans, and the SQL oracles."""

from __future__ import annotations

import json
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rooftally.catalog import QUERIES
from rooftally.oracle import ORACLE
from rooftally.operators import keep_first, tag_normalized
from rooftally.plans import nightly, nightly_stages, raw_feed, raw_sources, run_nightly
from rooftally.schema import LISTING_COLUMNS
from rooftally.staging import run_folder, shared_folder
from rooftally.streaming import incremental, run_available
from tools.check_oracles import TABLES, rows_of


def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_counts_without_the_quarantine_faults(spark, sf_dir):
    """Known counts of this data set when every floor and size is usable."""
    sources = [s.drop("floor", "size_sqm") for s in raw_sources(spark, sf_dir)]
    stages = nightly_stages(sources)
    kinds = {r.kind: r.n for r in stages.rejected.groupBy(
        F.split("reason", "[(:]")[0].alias("kind")).agg(F.count("*").alias("n")).collect()}
    assert kinds == {"missing city": 16, "price too low ": 44, "spam keyword detected": 36, "price outlier": 31}
    assert stages.valid.count() == 1373
    assert stages.unique.count() == 1170


def test_single_scan_feed_equals_the_union(spark, sf_dir):
    one = raw_feed(spark, sf_dir)
    union = raw_sources(spark, sf_dir)[0].unionByName(raw_sources(spark, sf_dir)[1]).select(*one.columns)
    assert one.exceptAll(union).isEmpty() and union.exceptAll(one).isEmpty()


def test_staged_run(spark, sf_dir, tmp_path):
    result = run_nightly(
        raw_sources(spark, sf_dir), "r1", folder=str(tmp_path / "stages"),
        documents=str(tmp_path / "docs"), warehouse_path=str(tmp_path / "table"),
    )
    counts = result.counts
    assert counts["raw"] == 1500 == counts["normalized"] + counts["quarantined"]
    assert counts["normalized"] == counts["valid"] + counts["rejected"] == counts["spam_passed"] + counts["spam_rejected"]
    assert counts["valid"] == counts["unique"] + counts["duplicates"]
    assert (result.quarantine.count(), result.rejected.count(), result.valid.count()) == (
        counts["quarantined"], counts["rejected"], counts["valid"])
    assert result.duplicates.count() == counts["duplicates"]
    assert result.unique.select("fingerprint").distinct().count() == result.unique.count() == counts["unique"]
    assert result.documents.total_loaded == result.warehouse.rows_inserted == counts["unique"]
    assert result.documents.batch_count == -(-counts["unique"] // 400)
    assert sum(r.n for r in result.rejects.collect()) == counts["rejected"]
    assert sum(r.n for r in result.sources.collect()) == 1500
    assert _ids(result.unique) == _ids(nightly_stages(raw_sources(spark, sf_dir)).unique)
    assert _ids(spark.read.json(str(tmp_path / "docs"))) == _ids(spark.read.parquet(str(tmp_path / "table")))
    stats = {r.deal_type: r.n for r in result.stats.collect()}
    assert sum(stats.values()) == counts["spam_passed"]
    result.close()
    assert not (tmp_path / "stages").exists()
    assert spark.read.parquet(str(tmp_path / "table")).count() == counts["unique"]


def test_sources_are_scanned_once_a_run(spark, sf_dir, tmp_path):
    """Every job of a run but one reads stage tables."""
    group = "scan-once"
    feed = raw_feed(spark, sf_dir)
    scans = []
    stage_of = nightly.stage

    def watched(df, path):
        scans.append(df._jdf.queryExecution().optimizedPlan().toString().count("orders"))
        return stage_of(df, path)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(nightly, "stage", watched)
        result = run_nightly([feed], group, folder=str(tmp_path / "stages"), warehouse_path=str(tmp_path / "table"))
    assert [found > 0 for found in scans] == [True, False, False]
    for df in (result.valid, result.rejected, result.duplicates, result.quarantine, result.rejects):
        assert "orders.parquet" not in df._jdf.queryExecution().executedPlan().toString()


def test_survivors_for_documents_are_written_once(spark, sf_dir, tmp_path):
    """In input order, so that the batches follow it and no sorted copy is made."""
    folder = tmp_path / "stages"
    result = run_nightly([raw_feed(spark, sf_dir)], "r1", folder=str(folder), documents=str(tmp_path / "docs"))
    assert sorted(path.name for path in folder.iterdir()) == ["screened", "stats", "unique"]
    in_order = [r.id for r in spark.read.parquet(str(folder / "unique")).orderBy("_seq").select("id").collect()]
    batches = {r.id: r.batch_id for r in spark.read.json(str(tmp_path / "docs")).collect()}
    assert [batches[id] for id in in_order] == [1 + at // 400 for at in range(result.counts["unique"])]


def test_result_does_not_depend_on_partitioning(spark, sf_dir):
    feed = raw_feed(spark, sf_dir)
    assert _ids(nightly_stages([feed.repartition(1)]).unique) == _ids(nightly_stages([feed.repartition(13)]).unique)


def test_empty_run(spark, sf_dir, tmp_path):
    result = run_nightly(
        [s.where("false") for s in raw_sources(spark, sf_dir)], "r0", folder=str(tmp_path / "stages"),
        documents=str(tmp_path / "docs"), warehouse_path=str(tmp_path / "table"),
    )
    assert set(result.counts.values()) == {0}
    assert result.documents.batch_count == 0 and result.warehouse.rows_inserted == 0


def _land(folder, name, ids):
    folder.mkdir(parents=True, exist_ok=True)
    base = {"source": "yad2", "city": "חיפה", "deal_type": "למכירה", "property_type": "דירה", "price": 2_000_000}
    lines = [json.dumps({**base, "id": i, "street": f"רחוב {i[1:]}"}) for i in ids]
    (folder / name).write_text("\n".join(lines), encoding="utf-8")


def test_streams_that_share_a_table_keep_their_rows(spark, tmp_path):
    table = str(tmp_path / "table")
    _land(tmp_path / "a", "1.json", ["a1", "a2"])
    _land(tmp_path / "b", "1.json", ["b3"])
    run_available(spark, [str(tmp_path / "a")], table, str(tmp_path / "progress-a"))
    run_available(spark, [str(tmp_path / "b")], table, str(tmp_path / "progress-b"))
    assert _ids(spark.read.parquet(table)) == ["a1", "a2", "b3"]
    _land(tmp_path / "b", "2.json", ["b4"])
    run_available(spark, [str(tmp_path / "b")], table, str(tmp_path / "progress-b"))
    assert _ids(spark.read.parquet(table)) == ["a1", "a2", "b3", "b4"]


def test_incremental_run_takes_only_new_files(spark, tmp_path):
    folders = [str(tmp_path / "a"), str(tmp_path / "b")]
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    _land(tmp_path / "a", "1.json", ["a1", "a2"])
    _land(tmp_path / "b", "1.json", ["b2", "b3"])
    run_available(spark, folders, table, progress)
    assert _ids(spark.read.parquet(table)) == ["a1", "a2", "b3"]   # b2 is a copy of a2
    _land(tmp_path / "a", "2.json", ["a9"])
    run_available(spark, folders, table, progress)
    run_available(spark, folders, table, progress)
    assert _ids(spark.read.parquet(table)) == ["a1", "a2", "a9", "b3"]


def test_incremental_run_scans_files_and_not_the_streams_rows(spark, tmp_path, monkeypatch):
    """Names that look like patterns are taken as they are, and the scan is in the plan, so that it can be optimized."""
    plans = []
    monkeypatch.setattr(incremental, "nightly_stages", lambda scans, folder: plans.extend(map(_plan, scans)) or nightly_stages(scans, folder))
    table, progress = str(tmp_path / "table"), str(tmp_path / "progress")
    _land(tmp_path / "a", "1[x]{y}.json", ["a1", "a2"])
    _land(tmp_path / "a", "1x.json", ["a3"])
    run_available(spark, [str(tmp_path / "a")], table, progress)
    assert _ids(spark.read.parquet(table)) == ["a1", "a2", "a3"]
    assert len(plans) == 1 and "FileScan json" in plans[0] and "ExistingRDD" not in plans[0]


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    assert run_folder(spark, "x").startswith(shared_folder(spark))
    assert run_folder(spark, "x") != run_folder(spark, "x")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_of_the_run(spark, sf_dir):
    stages = nightly_stages([raw_feed(spark, sf_dir)])
    plan = _plan(keep_first(stages.fingerprinted, "fingerprint", "_seq"))
    assert plan.count("WindowGroupLimit") >= 2
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("SinglePartition") == 0
    assert plan.count("hashpartitioning(fingerprint") == 1
    scan = next(line for line in _plan(tag_normalized(raw_feed(spark, sf_dir))).splitlines() if "orders.parquet" in line)
    assert "o_orderstatus" not in scan and "PushedFilters: [IsNotNull(o_custkey)]" in scan


@pytest.mark.parametrize("name", ["normalize_listings", "normalize_quarantine", "json_landing_listings"])
def test_filters_hold_no_cleaning(spark, sf_dir, name):
    """A verdict pushed below the cleaning would work every field out twice."""
    filters = [line for line in _plan(QUERIES[name](spark, sf_dir)).splitlines() if re.search(r"\bFilter\b|PushedFilters", line)]
    assert filters
    assert not [line for line in filters if re.search("regexp|try_cast|translate|cast\\(", line)]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in relation.description], relation.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_listing_columns_are_the_survivors_columns(spark, sf_dir):
    assert QUERIES["nightly_survivors"](spark, sf_dir).columns == [*LISTING_COLUMNS, "fingerprint"]
