"""The registered queries: SQL where there is some, and the columns that each must have."""

from __future__ import annotations

import duckdb
import pytest

from rooftally.llm.queries import ORACLE, QUERIES
from tools.check_oracles import TABLES, rows_of

COLUMNS = {
    "op1_exact_dedup": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op2_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op3_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op4_license_scan": "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double",
    "op5_warc": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op6_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op8_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op9_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op10_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op11_vector_codes": "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string",
    "op12_line_dedup": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
    "op13_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_queries_named():
    assert set(QUERIES) == set(COLUMNS) and set(ORACLE) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    relation = duck.execute(ORACLE[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in relation.description], relation.fetchall())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_columns(spark, sf_dir, name):
    found = dict(QUERIES[name](spark, sf_dir).dtypes)
    for column in COLUMNS[name].split(", "):
        column, kind = column.split(" ")
        assert found[column] == kind
