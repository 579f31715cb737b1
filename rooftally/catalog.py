"""The registered queries: each operator over the test tables, whole."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.cells import cell_of
from .functions.coerce import clean_floor, clean_price, clean_rooms, clean_size, clean_text
from .functions.identity import price_bucket
from .functions.screening import keyword_hit
from .operators.batches import BATCH_COLUMN, assign_batches, batch_sizes, number_written
from .operators.dedup import copy_counts, keep_first, later_copies
from .operators.metrics import (
    dedup_counts, normalizer_counts, reason_kind, rejects_by_kind, spam_counts, validator_counts,
)
from .operators.normalize import Normalized, normalize, split_normalized, tag_normalized
from .operators.sigma import attach_stats, reported, sigma_stats, sigma_thresholds, tag_outliers
from .operators.validate import judge, price_stats, screen, split_judged
from .plans.analyst import CITY_SHARE, DEAREST_PER_CITY, ROLLUP
from .plans.landing_zone import write_faulty_landing, write_json_landing, write_parquet_landing
from .plans.nightly import NightlyStages, nightly_stages, run_nightly
from .plans.rawview import raw_feed, raw_sources
from .schema import ERROR_COLUMN, LISTING_COLUMNS, RAW_COLUMN, SEQ_COLUMN, SOURCES
from .sinks.documents import load_documents
from .sinks.slices import RUN_COLUMN, slice_folder
from .sinks.warehouse import DATASET_VARIABLE, PROJECT_VARIABLE, TABLE_VARIABLE, append_to_warehouse
from .sources.landing import ordered_union, scan_json, scan_table, source_counts
from .session import importable, tune
from .staging import run_folder, stage
from .streaming.incremental import run_available
from .tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
_RUN = "nightly"


def _normalized(spark: SparkSession, sf_dir: str) -> Normalized:
    return normalize(raw_feed(spark, sf_dir))


def _stages(spark: SparkSession, sf_dir: str) -> NightlyStages:
    return nightly_stages([raw_feed(spark, sf_dir)])


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors, written in input order."""
    return nightly_stages([raw_feed(spark, sf_dir)], in_order=True).unique


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 4) for name in names})


# Sources and union

def raw_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordered_union(*raw_sources(spark, sf_dir))
    return rows.select(
        "id", "source", "city", "price", F.col("_seq.source_rank").alias("source_rank"), F.col("_seq.row").alias("row"),
    )


def count_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_counts(ordered_union(*raw_sources(spark, sf_dir)))


def _from_json(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    folders = write_json_landing(spark, sf_dir, run_folder(spark, "landing"))
    return [scan_json(spark, folder, rank) for rank, folder in enumerate(folders)]


def json_landing_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    scans = _from_json(spark, sf_dir)
    return ordered_union(*[normalize(scan).clean for scan in scans]).select(*LISTING_COLUMNS)


def _faulty(spark: SparkSession, sf_dir: str) -> Normalized:
    """The landing with broken records, cleaned once and written."""
    folder = run_folder(spark, "faulty")
    scans = [scan_json(spark, path, rank) for rank, path in enumerate(write_faulty_landing(spark, sf_dir, f"{folder}/landing"))]
    return split_normalized(stage(ordered_union(*map(tag_normalized, scans)), f"{folder}/tagged"))


def json_landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty(spark, sf_dir).quarantine.select(
        F.get_json_object(RAW_COLUMN, "$.id").alias("id"), F.col(ERROR_COLUMN).alias("error"),
    )


def json_landing_faulty_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _faulty(spark, sf_dir).clean.select(*LISTING_COLUMNS)


def json_landing_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    screened = screen(_faulty(spark, sf_dir).clean)
    return screened.where("_spam IS NOT NULL").select("id", F.col("_spam").alias("reason"))


def json_landing_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nightly_stages(_from_json(spark, sf_dir)).unique.select("id", "fingerprint")


def parquet_landing_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = write_parquet_landing(spark, sf_dir, run_folder(spark, "landing"))
    scans = [
        scan_table(spark, folder, rank, source) for rank, (folder, source) in enumerate(zip(folders, SOURCES))
    ]
    return nightly_stages(scans).unique.select("id", "fingerprint")


# Field rules and normalization

def _field(rule: Callable, name: str, *also: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_feed(spark, sf_dir)
        return raw.select("id", *also, rule(cell_of(raw, name)).alias(name))
    return query


def text_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_feed(spark, sf_dir)
    names = ("city", "neighborhood", "street", "description")
    return raw.select("id", *[clean_text(cell_of(raw, name)).alias(name) for name in names])


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return documents.select("doc_id", clean_text(cell_of(documents, "text")).alias("text"))


def normalized_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).clean.select(*LISTING_COLUMNS)


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).quarantine.select(
        F.get_json_object(RAW_COLUMN, "$.id").alias("id"), F.col(ERROR_COLUMN).alias("error"),
    )


def count_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalizer_counts(_normalized(spark, sf_dir).tagged)


# Screening

def spam_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    screened = screen(_normalized(spark, sf_dir).clean)
    return screened.select("id", F.col("_spam").alias("reason"))


def count_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam_counts(screen(_normalized(spark, sf_dir).clean))


def _keyword_rows(table: str, *ids: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read_table(spark, sf_dir, table).select(*ids, "text")
        lowered = rows.select(*ids, F.lower("text").alias("_lowered"))
        return lowered.select(*ids, keyword_hit(F.col("_lowered")).alias("keyword")).where("keyword IS NOT NULL")
    return query


# Fences

def _screened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screen(_normalized(spark, sf_dir).tagged)


def deal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(reported(price_stats(_screened(spark, sf_dir))), "mu", "sigma")


def deal_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sigma_thresholds(reported(price_stats(_screened(spark, sf_dir)))), "mu", "sigma", "threshold")


def stats_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    screened = _screened(spark, sf_dir)
    stats = stage(price_stats(screened), run_folder(spark, "stats"))
    fenced = attach_stats(screened, stats, "deal_type")
    return _rounded(fenced.where("_error IS NULL").select("id", "deal_type", "price", "mu", "sigma"), "mu", "sigma")


def price_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _stages(spark, sf_dir).rejected
    return (
        rejected.where(reason_kind(F.col("reason")) == "price outlier")
        .select("listing.id", "listing.deal_type", "listing.price", "reason")
    )


def _outlier_rows(table: str, value: str, by: str, *ids: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read_table(spark, sf_dir, table).select(*ids, by, value)
        return tag_outliers(rows, value, by).where("is_outlier").select(*ids, by, value)
    return query


def lineitem_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices against those of the same part, with a fault put in: tenfold prices in some orders."""
    rows = read_table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "if(l_orderkey % 41 = 0, l_extendedprice * 10, l_extendedprice) AS l_extendedprice",
    )
    return tag_outliers(rows, "l_extendedprice", "l_partkey").where("is_outlier").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
    )


def event_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = sigma_stats(read_table(spark, sf_dir, "events"), "value", "event_type")
    return _rounded(sigma_thresholds(stats), "mu", "sigma", "threshold")


def valid_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).valid.select(*LISTING_COLUMNS)


def rejected_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).rejected.select("listing.*", "reason")


def count_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = screen(_normalized(spark, sf_dir).clean)
    return validator_counts(judge(clean, stage(price_stats(clean), run_folder(spark, "stats"))))


def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects_by_kind(_stages(spark, sf_dir).rejected)


# Identity and deduplication

def price_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", price_bucket(F.col("o_totalprice")).alias("bucket"))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).fingerprinted.select("id", "fingerprint")


def survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).unique.select("id", "fingerprint")


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stages(spark, sf_dir).duplicates.select("id", "fingerprint")


def count_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_counts(_stages(spark, sf_dir).fingerprinted)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").withColumn("digest", F.md5(F.col("text").cast("binary")))


def unique_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_first(_documents(spark, sf_dir), "digest", "doc_id").select("doc_id", "lang", "source", "text")


def document_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return later_copies(_documents(spark, sf_dir), "digest", "doc_id").select("doc_id", "lang", "source", "text")


def count_document_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_counts(_documents(spark, sf_dir), "digest")


# Whole runs and sinks

def nightly_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = nightly_stages(raw_sources(spark, sf_dir))
    return stages.unique.select(*LISTING_COLUMNS, "fingerprint")


def nightly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = run_nightly([raw_feed(spark, sf_dir)], _RUN)
    counts = spark.createDataFrame([tuple(result.counts.values())], ", ".join(f"{name} bigint" for name in result.counts))
    result.close()
    return counts


def nightly_both_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run into both sinks, and what each has of a listing."""
    folder = run_folder(spark, "both")
    result = run_nightly([raw_feed(spark, sf_dir)], _RUN, documents=f"{folder}/documents", warehouse_path=f"{folder}/table")
    result.close()
    documents = spark.read.schema("id string, batch_id bigint").json(slice_folder(f"{folder}/documents", _RUN))
    stored = spark.read.parquet(f"{folder}/table").select("id", "fingerprint", RUN_COLUMN)
    return documents.join(stored, "id", "full")


def incremental_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "incremental")
    landing = write_json_landing(spark, sf_dir, f"{folder}/landing")
    run_available(spark, landing, f"{folder}/listings", f"{folder}/progress")
    return spark.read.parquet(f"{folder}/listings").select("id", "fingerprint")


def incremental_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream for each source into one table; the first finds nothing new the second time."""
    folder = run_folder(spark, "incremental")
    landing = write_json_landing(spark, sf_dir, f"{folder}/landing")
    for at in (0, 1, 0):
        run_available(spark, [landing[at]], f"{folder}/listings", f"{folder}/progress-{at}")
    return spark.read.parquet(f"{folder}/listings").select("id", "fingerprint")


def _batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_batches(number_written(_ordered(spark, sf_dir)).rows)


def document_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batched(spark, sf_dir).select("id", BATCH_COLUMN)


def document_batch_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_sizes(_batched(spark, sf_dir))


def _document_schema(unique: DataFrame) -> T.StructType:
    return unique.drop(SEQ_COLUMN).withColumn(BATCH_COLUMN, F.lit(0).cast("bigint")).schema


def loaded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = run_folder(spark, "documents")
    unique = _ordered(spark, sf_dir)
    load_documents(unique, target, _RUN, written=True)
    return spark.read.schema(_document_schema(unique)).json(slice_folder(target, _RUN))


def document_sink_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each source, and the first one once more: the folder has both, once."""
    target = run_folder(spark, "documents")
    unique = _stages(spark, sf_dir).unique
    for source in (*SOURCES, SOURCES[0]):
        load_documents(unique.where(F.col("source") == source), target, source)
    return spark.read.schema(f"id string, {BATCH_COLUMN} bigint, {RUN_COLUMN} string").json(target)


class _FolderWriter:
    """A document store for queries: a file for each batch in the shared folder."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def commit(self, run_id: str, batch_id: int, documents: list[dict]) -> None:
        store, path = fs.FileSystem.from_uri(self.folder if ":" in self.folder else f"file://{self.folder}")
        store.create_dir(path, recursive=True)
        lines = [json.dumps({"run_id": run_id, "batch_id": batch_id, "id": document["id"]}) for document in documents]
        with store.open_output_stream(f"{path}/{run_id}-{batch_id}.json") as file:
            file.write("\n".join(lines).encode())

    def close(self) -> None:
        pass


def document_writer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches as a writer on the executors commits them."""
    folder = run_folder(spark, "committed")
    load_documents(_ordered(spark, sf_dir), partial(_FolderWriter, folder), _RUN, written=True)
    return spark.read.schema("run_id string, batch_id bigint, id string").json(folder)


def document_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = load_documents(_stages(spark, sf_dir).unique, run_folder(spark, "documents"), _RUN)
    return spark.createDataFrame(
        [(stats.total_loaded, stats.batch_count, round(stats.average_batch, 4))],
        "total_loaded bigint, batch_count bigint, average_batch double",
    )


def warehouse_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each source, the first one repeated, and a third run that is empty when repeated."""
    path = run_folder(spark, "warehouse")
    unique = _stages(spark, sf_dir).unique.drop(SEQ_COLUMN)
    for source in (*SOURCES, SOURCES[0]):
        append_to_warehouse(unique.where(F.col("source") == source), source, path)
    for rows in (unique, unique.where("false")):
        append_to_warehouse(rows, "third", path)
    return spark.read.schema(f"id string, fingerprint string, {RUN_COLUMN} string").parquet(path)


def _loaded_table(spark: SparkSession, sf_dir: str) -> str:
    path = run_folder(spark, "warehouse")
    append_to_warehouse(_stages(spark, sf_dir).unique.drop(SEQ_COLUMN), _RUN, path)
    return path


def warehouse_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_loaded_table(spark, sf_dir))


def warehouse_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = append_to_warehouse(
        _stages(spark, sf_dir).unique.drop(SEQ_COLUMN), _RUN, run_folder(spark, "warehouse"),
        project="p", dataset="d", table="t",
    )
    return spark.createDataFrame(
        [(stats.total_loaded, stats.rows_inserted, stats.table_id)],
        "total_loaded bigint, rows_inserted bigint, table_id string",
    )


@contextmanager
def _environment(**values: str) -> Iterator[None]:
    """The environment with ``values``, and as it was afterwards."""
    before = {name: os.environ.get(name) for name in values}
    os.environ.update(values)
    try:
        yield
    finally:
        for name, value in before.items():
            os.environ.pop(name, None) if value is None else os.environ.__setitem__(name, value)


def warehouse_table_from_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads whose table id comes from the environment, part by part; an argument wins over it."""
    unique = _stages(spark, sf_dir).unique.drop(SEQ_COLUMN)
    with _environment(**{PROJECT_VARIABLE: "env-project", DATASET_VARIABLE: "env_dataset", TABLE_VARIABLE: "env_table"}):
        loads = [append_to_warehouse(unique, _RUN, run_folder(spark, "warehouse"), **given) for given in ({}, {"dataset": "own"})]
    return spark.createDataFrame([(load.table_id, load.rows_inserted) for load in loads], "table_id string, rows_inserted bigint")


def warehouse_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run for each source and the first one repeated, in a table of the session catalog that the environment names."""
    name = f"listings_{uuid.uuid4().hex}"
    unique = _stages(spark, sf_dir).unique.drop(SEQ_COLUMN)
    with _environment(**{DATASET_VARIABLE: "analytics", TABLE_VARIABLE: name}):
        for source in (*SOURCES, SOURCES[0]):
            append_to_warehouse(unique.where(F.col("source") == source), source)
    return spark.table(f"analytics_{name}").select("id", "fingerprint", RUN_COLUMN)


def _analyst(sql: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(sql.format(table=f"parquet.`{_loaded_table(spark, sf_dir)}`"))
    return query


_QUERIES: dict[str, Query] = {
    "raw_union": raw_union,
    "source_counts": count_sources,
    "json_landing_listings": json_landing_listings,
    "json_landing_survivors": json_landing_survivors,
    "json_landing_quarantine": json_landing_quarantine,
    "json_landing_faulty_listings": json_landing_faulty_listings,
    "json_landing_spam": json_landing_spam,
    "parquet_landing_survivors": parquet_landing_survivors,
    "normalize_price": _field(clean_price, "price"),
    "normalize_rooms": _field(clean_rooms, "rooms"),
    "normalize_floor": _field(clean_floor, "floor"),
    "normalize_size": _field(clean_size, "size_sqm"),
    "normalize_text": text_fields,
    "normalize_documents": document_texts,
    "normalize_listings": normalized_listings,
    "normalize_quarantine": quarantined,
    "normalizer_counts": count_normalized,
    "spam_reason": spam_reasons,
    "spam_counts": count_spam,
    "spam_documents": _keyword_rows("documents", "doc_id"),
    "spam_conversations": _keyword_rows("conversations", "conv_id", "turn"),
    "sigma_stats": deal_stats,
    "sigma_thresholds": deal_thresholds,
    "stats_lookup": stats_lookup,
    "sigma_outliers": price_outliers,
    "sigma_events": _outlier_rows("events", "value", "event_type", "event_id"),
    "sigma_event_thresholds": event_stats,
    "sigma_event_users": _outlier_rows("events", "value", "user_id", "event_id"),
    "sigma_lineitem_parts": lineitem_outliers,
    "valid_listings": valid_listings,
    "rejected_listings": rejected_listings,
    "validator_counts": count_valid,
    "rejects_by_reason": rejects_by_reason,
    "price_bucket": price_buckets,
    "fingerprint": fingerprints,
    "dedup_first": survivors,
    "dedup_duplicates": duplicates,
    "dedup_counts": count_copies,
    "dedup_documents": unique_documents,
    "duplicate_documents": document_copies,
    "document_copy_counts": count_document_copies,
    "nightly_survivors": nightly_survivors,
    "nightly_counts": nightly_counts,
    "nightly_both_sinks": nightly_both_sinks,
    "incremental_survivors": incremental_survivors,
    "incremental_two_streams": incremental_two_streams,
    "document_batches": document_batches,
    "document_batch_sizes": document_batch_sizes,
    "document_sink": loaded_documents,
    "document_sink_two_runs": document_sink_two_runs,
    "document_writer_batches": document_writer_batches,
    "document_load_stats": document_load_stats,
    "warehouse_append": warehouse_append,
    "warehouse_two_runs": warehouse_two_runs,
    "warehouse_load_stats": warehouse_load_stats,
    "warehouse_table_from_environment": warehouse_table_from_environment,
    "warehouse_catalog_table": warehouse_catalog_table,
    "analyst_rollup": _analyst(ROLLUP),
    "analyst_dearest_per_city": _analyst(DEAREST_PER_CITY),
    "analyst_city_share": _analyst(CITY_SHARE),
}


def _tuned(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(importable(tune(spark)), sf_dir)
    return run


QUERIES: dict[str, Query] = {name: _tuned(query) for name, query in _QUERIES.items()}
