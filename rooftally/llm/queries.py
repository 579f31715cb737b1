"""The registered queries of the operators, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, ready, staged
from . import licenses, manifest, pii, warc
from .codes import compress
from .decontaminate import contamination
from .exact_dedup import copy_groups
from .lines import line_report
from .packing import pack
from .quality import learn as learn_quality, measured
from .simhash import near_groups
from .token_files import round_trip
from .toxicity import REJECT_AT, is_held_out, learn as learn_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = copy_groups(read(spark, sf_dir, "documents"), digest_all=True)
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(read(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("notices")


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(measured(read(spark, sf_dir, "documents")), "statistics")
    forest = learn_quality(rows, read(spark, sf_dir, "labels"), allowed=~is_held_out(F.col("_id"), 3, 1))
    scored = rows.select(F.col("_id").alias("doc_id"), is_held_out(F.col("_id"), 3, 1).alias("held_out"), forest.score(F.col("_values")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    model = learn_toxicity(documents, read(spark, sf_dir, "labels"), allowed=~is_held_out(F.col("_id"), 4, 2))
    scored = documents.select("doc_id", is_held_out(F.col("doc_id"), 4, 2).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT_AT).cast("int"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

    def ordered(spans):
        order = F.array(*[F.lit(kind) for kind in (*pii.KINDS, *pii.ADDED)])
        keyed = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("_place"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")))
        return F.array_sort(keyed)

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(ordered(F.concat("base", "added"))).alias("spans"),
    )


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_report(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of an even checksum claims the leaf of its text without line feeds."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    joined = manifest.leaf_digest([F.replace("text", F.lit("\n"), F.lit("")) if name == "text" else F.col(name) for name in manifest.FIELDS])
    return manifest.proofs(manifest.build(read(spark, sf_dir, "documents"), claim=F.when(even, joined)))


FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH hashed AS (SELECT doc_id, sha256({FOLD}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)
"""

WORDS = rf"regexp_extract_all({FOLD}, '{WORD}')"

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[s:s + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM windows),
placed AS (
  SELECT doc_id, size, s, array_to_string(w[s:s + size - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM docs, sizes WHERE len(w) >= size)
),
found AS (SELECT DISTINCT doc_id, s, size, item_id FROM placed JOIN windows USING (size, phrase)),
hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS place FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

# Base32 of a digest: its hex digits as bits, five at a time.
ARCHIVES = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM payloads),
spelled AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(strpos('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits
  FROM hashed
),
digests AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum(list_transform(range(1, 6), lambda b:
      CAST(substr(bits, 5 * k + b, 1) AS INTEGER) * power(2, 5 - b))) AS INTEGER) + 1, 1)), '') AS payload_digest
  FROM spelled
),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
FROM kept
"""

BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
placed AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM placed
),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
judged AS (SELECT keyed.*, common.key IS NOT NULL AS goes FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Lloyd rounds one after another; distances are summed over the places of a part."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS p FROM kept, range({parts}) AS t(part)
),
books0 AS MATERIALIZED (
  SELECT part, entry, p FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
  ) USING (vec_id) WHERE entry < {entries}
)"""]
    for number in range(rounds + 1):
        steps.append(f"""
near{number} AS MATERIALIZED (
  SELECT vec_id, part, min({{'away': list_sum(list_transform(range(1, len(a.p) + 1), lambda i: (a.p[i] - b.p[i]) * (a.p[i] - b.p[i]))), 'entry': entry}}) AS best
  FROM parts a JOIN books{number} b USING (part) GROUP BY vec_id, part
)""")
        if number < rounds:
            steps.append(f"""
means{number} AS (
  SELECT part, entry, list(mean ORDER BY place) AS p FROM (
    SELECT part, best.entry AS entry, place, CAST(floor(sum(x) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS mean
    FROM (SELECT vec_id, part, unnest(p) AS x, generate_subscripts(p, 1) AS place FROM parts) JOIN near{number} USING (vec_id, part)
    GROUP BY part, best.entry, place
  ) GROUP BY part, entry
),
books{number + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(m.p, b.p) AS p FROM books{number} b LEFT JOIN means{number} m USING (part, entry)
)""")
    return f"""WITH {",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best.away) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(p, ','), ',' ORDER BY part, entry)) FROM books{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def _leaf_sql(text: str) -> str:
    def spelled(field: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({field} AS VARCHAR))) AS VARCHAR) || ':' || CAST({field} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(spelled(text if name == "text" else name) for name in manifest.FIELDS) + ")"


# The checksum takes eight steps for each digit. Trees are raised a level at a time, those of the sources and then the one above.
MANIFEST = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS joined,
         xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT)), lambda c, d:
           list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(c, d)), 4294967295), 4294967295) % 2 = 0 AS even
  FROM documents
),
ranked AS MATERIALIZED (
  SELECT doc_id, leaf, CASE WHEN even THEN joined ELSE leaf END AS claim, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS cnt
  FROM rows
),
nodes AS (
  SELECT tree, 0 AS level, idx, cnt, leaf AS digest FROM ranked
  UNION ALL
  SELECT tree, level + 1, idx // 3, (cnt + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE cnt > 1 GROUP BY tree, level, cnt, idx // 3
),
tops AS (
  SELECT 0 AS level, tree AS idx, (SELECT count(DISTINCT tree) FROM ranked) AS cnt, digest FROM nodes WHERE cnt = 1
  UNION ALL
  SELECT level + 1, idx // 3, (cnt + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE cnt > 1 GROUP BY level, cnt, idx // 3
),
every AS MATERIALIZED (
  SELECT tree, level, idx, cnt, digest FROM nodes UNION ALL SELECT -1, level, idx, cnt, digest FROM tops
),
levels AS (SELECT DISTINCT tree, level, cnt FROM every WHERE cnt > 1),
path AS (
  SELECT doc_id, l.tree, l.level, idx // CAST(power(3, l.level) AS BIGINT) AS own, l.level AS step FROM ranked JOIN levels l USING (tree)
  UNION ALL
  SELECT doc_id, -1, l.level, r.tree // CAST(power(3, l.level) AS BIGINT), 1000 + l.level FROM ranked r JOIN levels l ON l.tree = -1
),
siblings AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY step) AS step,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx < own), '') AS lefts,
         coalesce(string_agg(digest, '' ORDER BY idx) FILTER (idx > own), '') AS rights
  FROM path JOIN every ON path.tree = every.tree AND path.level = every.level AND idx // 3 = own // 3
  GROUP BY doc_id, step
),
folded AS (
  SELECT doc_id, 1 AS step, claim AS digest FROM ranked
  UNION ALL
  SELECT folded.doc_id, folded.step + 1, sha256(lefts || digest || rights) FROM folded JOIN siblings USING (doc_id, step)
),
ends AS (SELECT doc_id, arg_max(digest, step) AS folded_root FROM folded GROUP BY doc_id),
proven AS (SELECT doc_id, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof_sha256 FROM siblings GROUP BY doc_id)
SELECT doc_id, leaf, nodes.digest AS subroot, tops.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256,
       folded_root, folded_root = tops.digest AS verified
FROM ranked JOIN nodes ON nodes.tree = ranked.tree AND nodes.cnt = 1 JOIN tops ON tops.cnt = 1
JOIN ends USING (doc_id) LEFT JOIN proven USING (doc_id)
"""

QUERIES: dict[str, Query] = {
    "op1_exact_dedup": exact_dedup,
    "op2_simhash": simhash,
    "op3_decontamination": decontamination,
    "op4_license_scan": license_scan,
    "op5_warc": archives,
    "op6_quality": quality,
    "op7_toxicity": toxicity,
    "op8_token_files": token_files,
    "op9_packing": packing,
    "op10_pii": personal_data,
    "op11_vector_codes": vector_codes,
    "op12_line_dedup": line_dedup,
    "op13_manifest": dataset_manifest,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op3_decontamination": DECONTAMINATION,
    "op5_warc": ARCHIVES,
    "op11_vector_codes": _codes_sql(),
    "op12_line_dedup": LINE_DEDUP,
    "op13_manifest": MANIFEST,
}
