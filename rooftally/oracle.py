"""The registered queries as SQL for an independent engine (DuckDB) over the same tables."""

from __future__ import annotations

_WS = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def _text(column: str) -> str:
    collapsed = f"regexp_replace({column}, '{_WS}{{2,}}', ' ', 'g')"
    return f"coalesce(regexp_replace({collapsed}, '^{_WS}+|{_WS}+$', '', 'g'), '')"


_PRICE = "coalesce(try_cast(nullif(regexp_replace(price, '[^0-9.]', '', 'g'), '') AS DOUBLE), 0)"
_ROOMS = "coalesce(try_cast(replace(rooms, ',', '.') AS DOUBLE), 0)"
_FLOOR = (
    "CASE WHEN floor IS NULL OR floor = '' THEN 0 "
    "WHEN regexp_full_match(floor, '[+-]?[0-9]+') THEN try_cast(floor AS INTEGER) END"
)
_SIZE = "CASE WHEN size_sqm IS NULL OR size_sqm = '' THEN 0 ELSE try_cast(size_sqm AS DOUBLE) END"

# --- Fixed values: the spam keywords, in the order they are tried. ---
_KEYWORDS = ("test", "בדיקה", "lorem ipsum", "dummy", "fake", "placeholder")
# --- End of fixed values. ---


def _keyword(column: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({column}), '{k}') THEN '{k}'" for k in _KEYWORDS) + " END"


_LISTING = (
    "id, source, city, neighborhood, street, deal_type, property_type, rooms, floor, size_sqm, "
    "price, description, scraped_at, agent_phone"
)

# Each step builds on the ones before it; a query takes the steps up to the one it reads.
_STEPS = {
    "amounts": """
SELECT o_orderkey AS k, o_custkey AS ck, o_orderdate, o_orderpriority,
       CASE WHEN o_orderkey % 89 = 0 THEN 50 WHEN o_orderkey % 41 = 0 THEN base * 10 ELSE base END AS amt
FROM (SELECT *, CAST(floor(CASE WHEN o_orderkey % 2 = 0 THEN 800000 + o_totalprice * 10
                                ELSE 3000 + o_totalprice / 60 END) AS BIGINT) AS base FROM orders)""",
    "raw": """
SELECT k AS seq, 'L' || k AS id,
       CASE WHEN k % 5 < 3 THEN 'yad2' ELSE 'facebook' END AS source,
       CASE WHEN k % 5 < 3 THEN 0 ELSE 1 END AS source_rank,
       CASE WHEN k % 97 = 0 THEN '   ' ELSE '  ' || r_name || '   ' || n_name || ' ' END AS city,
       c_mktsegment AS neighborhood,
       'רחוב  ' || (ck % 40) AS street,
       CASE WHEN k % 2 = 0 THEN 'למכירה' ELSE 'להשכרה' END AS deal_type,
       o_orderpriority AS property_type,
       (1 + k % 3) || (CASE WHEN k % 4 < 2 THEN ',5' ELSE '' END) AS rooms,
       CASE WHEN k % 157 = 0 THEN 'abc' WHEN k % 19 = 0 THEN '' ELSE CAST(k % 31 AS VARCHAR) END AS floor,
       CASE WHEN k % 163 = 0 THEN '80,5' ELSE CAST(35 + k % 246 AS VARCHAR) END AS size_sqm,
       CASE WHEN k % 101 = 0 THEN NULL WHEN k % 103 = 0 THEN 'N/A'
            WHEN amt >= 1000 THEN '₪' || (amt // 1000) || ',' || lpad(CAST(amt % 1000 AS VARCHAR), 3, '0')
            ELSE '₪' || amt END AS price,
       CASE WHEN k % 83 = 0 THEN 'This is a TEST  listing' WHEN k % 79 = 0 THEN 'מודעת בדיקה'
            ELSE 'דירה  יפה' END AS description,
       strftime(o_orderdate, '%Y-%m-%d') AS scraped_at,
       '03-5550142' AS agent_phone
FROM amounts JOIN customer ON ck = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey""",
    "tagged": f"""
SELECT seq, source_rank, id, source, {_text('city')} AS city, {_text('neighborhood')} AS neighborhood,
       {_text('street')} AS street, deal_type, property_type, {_ROOMS} AS rooms, {_FLOOR} AS floor,
       {_SIZE} AS size_sqm, {_PRICE} AS price, {_text('description')} AS description, scraped_at, agent_phone,
       CASE WHEN ({_FLOOR}) IS NULL THEN 'bad floor' WHEN ({_SIZE}) IS NULL THEN 'bad size_sqm' END AS error
FROM raw""",
    "clean": "SELECT * FROM tagged WHERE error IS NULL",
    "screened": f"""
SELECT *, CASE WHEN city = '' THEN 'missing city'
               WHEN price < 100 THEN 'price too low (' || CAST(price AS VARCHAR) || ')'
               WHEN ({_keyword('description')}) IS NOT NULL
               THEN 'spam keyword detected: ''' || ({_keyword('description')}) || '''' END AS spam
FROM clean""",
    "stats": """
SELECT deal_type, count(*) AS n, avg(price) AS mu, stddev_pop(price) AS sigma
FROM screened WHERE spam IS NULL GROUP BY deal_type""",
    "judged": """
SELECT s.*, mu, sigma, CASE
         WHEN spam IS NOT NULL THEN spam
         WHEN sigma > 0 AND abs(price - mu) > 3 * sigma
         THEN printf('price outlier: %.0f is outside μ±3.0σ = [%.0f, %.0f]', price, mu - 3 * sigma, mu + 3 * sigma)
       END AS reason
FROM screened s LEFT JOIN stats t ON s.deal_type = t.deal_type""",
    "fingerprinted": """
SELECT *, md5(lower(city) || '|' || lower(street) || '|' || CAST(rooms AS VARCHAR) || '|' ||
              CAST(CAST(round_even(price / 100000, 0) AS BIGINT) * 100000 AS VARCHAR) || '|' || deal_type) AS fingerprint
FROM judged WHERE reason IS NULL""",
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY source_rank, seq) AS copy FROM fingerprinted""",
    "survivors": "SELECT * FROM ranked WHERE copy = 1",
    "batched": """
SELECT *, (row_number() OVER (ORDER BY source_rank, seq) - 1) // 400 + 1 AS batch_id FROM survivors""",
}


def _after(step: str, select: str, **changed: str) -> str:
    """``select`` over the steps up to ``step``, some of them ``changed``."""
    names = list(_STEPS)
    used = names[: names.index(step) + 1]
    return "WITH " + ", ".join(f"{name} AS ({changed.get(name, _STEPS[name])})" for name in used) + " " + select


def _by_source(step: str) -> str:
    """The step as it is when every source runs by itself."""
    return (
        _STEPS[step].replace("GROUP BY deal_type", "GROUP BY source, deal_type").replace("SELECT deal_type,", "SELECT source, deal_type,")
        .replace("ON s.deal_type = t.deal_type", "ON s.deal_type = t.deal_type AND s.source = t.source")
        .replace("PARTITION BY fingerprint", "PARTITION BY source, fingerprint")
        .replace("OVER (ORDER BY source_rank, seq)", "OVER (PARTITION BY source ORDER BY seq)")
    )


# Faults of the faulty landing by order key, the first that fits.
_FAULTS = {
    211: "missing source", 223: "missing deal_type", 227: "missing property_type", 229: "malformed record", 233: "bad price",
    239: "no id", 241: "null phone", 251: "number for id", 257: "lorem ipsum dolor", 263: "a Dummy flat", 269: "FAKE listing",
    271: "placeholder text", 277: "fake and lorem ipsum",
}
_LOST = "('missing source', 'missing deal_type', 'missing property_type', 'malformed record')"
_FAULTY = f"""
SELECT * REPLACE (
         CASE fault WHEN 'no id' THEN '' WHEN 'number for id' THEN '12345678901' ELSE id END AS id,
         CASE fault WHEN 'null phone' THEN '' ELSE agent_phone END AS agent_phone,
         CASE WHEN seq_fault > 251 THEN fault ELSE description END AS description,
         CASE WHEN fault IN {_LOST} THEN fault WHEN error IS NOT NULL THEN error
              WHEN fault = 'bad price' THEN 'price not finite' END AS error)
FROM (SELECT *, CASE {' '.join(f"WHEN seq % {key} = 0 THEN '{fault}'" for key, fault in _FAULTS.items())} END AS fault,
             CASE {' '.join(f"WHEN seq % {key} = 0 THEN {key}" for key in _FAULTS)} ELSE 0 END AS seq_fault
      FROM ({_STEPS['tagged']}))"""

_SURVIVORS = _after("survivors", "SELECT id, fingerprint FROM survivors")

_DOCUMENT_RANKS = (
    "WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS copy FROM documents) "
)


def _outliers(table: str, value: str, by: str, ids: str) -> str:
    return (
        f"WITH stats AS (SELECT {by} AS g, avg({value}) AS mu, stddev_pop({value}) AS sigma FROM {table} GROUP BY 1) "
        f"SELECT {ids}, {by}, {value} FROM {table} LEFT JOIN stats ON {by} IS NOT DISTINCT FROM g "
        f"WHERE sigma > 0 AND abs({value} - mu) > 3 * sigma"
    )


ORACLE: dict[str, str] = {
    "raw_union": _after("raw", "SELECT id, source, city, price, source_rank, seq AS row FROM raw"),
    "source_counts": _after("raw", "SELECT source, count(*) AS n FROM raw GROUP BY source"),
    "json_landing_listings": _after("clean", f"SELECT {_LISTING} FROM clean"),
    "json_landing_survivors": _SURVIVORS,
    "json_landing_quarantine": _after(
        "tagged",
        "SELECT CASE WHEN fault = 'malformed record' OR (fault = 'no id') THEN NULL ELSE id END AS id, error "
        "FROM tagged WHERE error IS NOT NULL",
        tagged=_FAULTY,
    ),
    "json_landing_faulty_listings": _after("clean", f"SELECT {_LISTING} FROM clean", tagged=_FAULTY),
    "json_landing_spam": _after("screened", "SELECT id, spam AS reason FROM screened WHERE spam IS NOT NULL", tagged=_FAULTY),
    "parquet_landing_survivors": _SURVIVORS,
    "normalize_price": _after("raw", f"SELECT id, {_PRICE} AS price FROM raw"),
    "normalize_rooms": _after("raw", f"SELECT id, {_ROOMS} AS rooms FROM raw"),
    "normalize_floor": _after("raw", f"SELECT id, {_FLOOR} AS floor FROM raw"),
    "normalize_size": _after("raw", f"SELECT id, {_SIZE} AS size_sqm FROM raw"),
    "normalize_text": _after(
        "tagged", "SELECT id, city, neighborhood, street, description FROM tagged"
    ),
    "normalize_documents": f"SELECT doc_id, {_text('text')} AS text FROM documents",
    "normalize_listings": _after("clean", f"SELECT {_LISTING} FROM clean"),
    "normalize_quarantine": _after("tagged", "SELECT id, error FROM tagged WHERE error IS NOT NULL"),
    "normalizer_counts": _after(
        "tagged", "SELECT count(*) AS input_count, count(*) FILTER (error IS NULL) AS output_count FROM tagged"
    ),
    "spam_reason": _after("screened", "SELECT id, spam AS reason FROM screened"),
    "spam_counts": _after(
        "screened",
        "SELECT count(*) FILTER (spam IS NULL) AS passed, count(*) FILTER (spam IS NOT NULL) AS rejected FROM screened",
    ),
    "spam_documents": f"SELECT doc_id, keyword FROM (SELECT doc_id, {_keyword('text')} AS keyword FROM documents) "
                      "WHERE keyword IS NOT NULL",
    "spam_conversations": "SELECT conv_id, turn, keyword FROM "
                          f"(SELECT conv_id, turn, {_keyword('text')} AS keyword FROM conversations) "
                          "WHERE keyword IS NOT NULL",
    "sigma_stats": _after("stats", "SELECT deal_type, n, round(mu, 4) AS mu, round(sigma, 4) AS sigma FROM stats"),
    "sigma_thresholds": _after(
        "stats",
        "SELECT deal_type, n, round(mu, 4) AS mu, round(sigma, 4) AS sigma, round(3 * sigma, 4) AS threshold FROM stats",
    ),
    "stats_lookup": _after(
        "judged", "SELECT id, deal_type, price, round(mu, 4) AS mu, round(sigma, 4) AS sigma FROM judged"
    ),
    "sigma_outliers": _after(
        "judged", "SELECT id, deal_type, price, reason FROM judged WHERE reason LIKE 'price outlier%'"
    ),
    "sigma_events": _outliers("events", "value", "event_type", "event_id"),
    "sigma_event_thresholds": "SELECT event_type, count(value) AS n, round(avg(value), 4) AS mu, "
                              "round(stddev_pop(value), 4) AS sigma, round(3 * stddev_pop(value), 4) AS threshold "
                              "FROM events GROUP BY event_type",
    "sigma_event_users": _outliers("events", "value", "user_id", "event_id"),
    "sigma_lineitem_parts": _outliers(
        "(SELECT * REPLACE (CASE WHEN l_orderkey % 41 = 0 THEN l_extendedprice * 10 ELSE l_extendedprice END "
        "AS l_extendedprice) FROM lineitem)",
        "l_extendedprice", "l_partkey", "l_orderkey, l_linenumber",
    ),
    "valid_listings": _after("judged", f"SELECT {_LISTING} FROM judged WHERE reason IS NULL"),
    "rejected_listings": _after("judged", f"SELECT {_LISTING}, reason FROM judged WHERE reason IS NOT NULL"),
    "validator_counts": _after(
        "judged",
        "SELECT count(*) AS input_count, count(*) FILTER (reason IS NULL) AS valid_count, "
        "count(*) FILTER (reason IS NOT NULL) AS rejected_count FROM judged",
    ),
    "rejects_by_reason": _after(
        "judged",
        "SELECT CASE WHEN reason LIKE 'price too low%' THEN 'price too low' "
        "WHEN reason LIKE 'spam keyword%' THEN 'spam keyword detected' "
        "WHEN reason LIKE 'price outlier%' THEN 'price outlier' ELSE reason END AS reason_kind, count(*) AS n "
        "FROM judged WHERE reason IS NOT NULL GROUP BY 1",
    ),
    "price_bucket": "SELECT o_orderkey, CAST(round_even(o_totalprice / 100000, 0) AS BIGINT) * 100000 AS bucket FROM orders",
    "fingerprint": _after("fingerprinted", "SELECT id, fingerprint FROM fingerprinted"),
    "dedup_first": _SURVIVORS,
    "dedup_duplicates": _after("ranked", "SELECT id, fingerprint FROM ranked WHERE copy > 1"),
    "dedup_counts": _after(
        "ranked",
        "SELECT count(*) AS input_count, count(*) FILTER (copy = 1) AS unique_count, "
        "count(*) FILTER (copy > 1) AS duplicate_count FROM ranked",
    ),
    "dedup_documents": _DOCUMENT_RANKS + "SELECT doc_id, lang, source, text FROM ranked WHERE copy = 1",
    "duplicate_documents": _DOCUMENT_RANKS + "SELECT doc_id, lang, source, text FROM ranked WHERE copy > 1",
    "document_copy_counts": "SELECT count(*) AS input_count, count(DISTINCT text) AS unique_count, "
                            "count(*) - count(DISTINCT text) AS duplicate_count FROM documents",
    "nightly_survivors": _after("survivors", f"SELECT {_LISTING}, fingerprint FROM survivors"),
    "nightly_counts": _after(
        "ranked",
        """
SELECT (SELECT count(*) FROM tagged) AS raw,
       (SELECT count(*) FROM clean) AS normalized,
       (SELECT count(*) FROM tagged WHERE error IS NOT NULL) AS quarantined,
       (SELECT count(*) FROM screened WHERE spam IS NOT NULL) AS spam_rejected,
       (SELECT count(*) FROM screened WHERE spam IS NULL) AS spam_passed,
       (SELECT count(*) FROM judged WHERE reason IS NULL) AS valid,
       (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS rejected,
       (SELECT count(*) FROM ranked WHERE copy = 1) AS "unique",
       (SELECT count(*) FROM ranked WHERE copy > 1) AS duplicates""",
    ),
    "nightly_both_sinks": _after("batched", "SELECT id, batch_id, fingerprint, 'nightly' AS run_id FROM batched"),
    "incremental_survivors": _SURVIVORS,
    "incremental_two_streams": _after(
        "survivors", "SELECT id, fingerprint FROM survivors",
        stats=_by_source("stats"), judged=_by_source("judged"), ranked=_by_source("ranked"),
    ),
    "document_batches": _after("batched", "SELECT id, batch_id FROM batched"),
    "document_batch_sizes": _after(
        "batched", "SELECT batch_id, count(*) AS n_documents FROM batched GROUP BY batch_id"
    ),
    "document_sink": _after("batched", f"SELECT {_LISTING}, fingerprint, batch_id FROM batched"),
    "document_sink_two_runs": _after(
        "batched", "SELECT id, batch_id, source AS run_id FROM batched", batched=_by_source("batched")
    ),
    "document_writer_batches": _after("batched", "SELECT 'nightly' AS run_id, batch_id, id FROM batched"),
    "document_load_stats": _after(
        "batched",
        "SELECT count(*) AS total_loaded, count(DISTINCT batch_id) AS batch_count, "
        "round(count(*) / CAST(count(DISTINCT batch_id) AS DOUBLE), 4) AS average_batch FROM batched",
    ),
    "warehouse_append": _after("survivors", f"SELECT {_LISTING}, fingerprint, 'nightly' AS run_id FROM survivors"),
    "warehouse_two_runs": _after("survivors", "SELECT id, fingerprint, source AS run_id FROM survivors"),
    "warehouse_load_stats": _after(
        "survivors", "SELECT count(*) AS total_loaded, count(*) AS rows_inserted, 'p.d.t' AS table_id FROM survivors"
    ),
    "warehouse_table_from_environment": _after(
        "survivors",
        "SELECT table_id, count(*) AS rows_inserted FROM survivors, "
        "(VALUES ('env-project.env_dataset.env_table'), ('env-project.own.env_table')) AS ids(table_id) GROUP BY table_id",
    ),
    "warehouse_catalog_table": _after("survivors", "SELECT id, fingerprint, source AS run_id FROM survivors"),
    "analyst_rollup": _after(
        "survivors",
        "SELECT city, deal_type, count(*) AS n_listings, round(avg(price), 4) AS avg_price, "
        "min(price) AS min_price, max(price) AS max_price FROM survivors GROUP BY city, deal_type",
    ),
    "analyst_dearest_per_city": _after(
        "survivors",
        "SELECT * FROM (SELECT city, deal_type, row_number() OVER (PARTITION BY city, deal_type "
        "ORDER BY price DESC, id) AS place, id, price FROM survivors) WHERE place <= 3",
    ),
    "analyst_city_share": _after(
        "survivors",
        "SELECT deal_type, city, count(*) AS n_listings, "
        "round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY deal_type) AS DOUBLE), 6) AS share "
        "FROM survivors GROUP BY deal_type, city",
    ),
}
