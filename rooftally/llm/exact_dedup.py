"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

The first pass reads lengths and hashes of prefixes. Groups of one length are split by prefix
hash, and what still collides goes into a filter of fixed size. The second pass hashes whole
texts, and groups only those that the filter lets through: texts never move, only digests do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bit_table, fold, retain, staged, with_bit

PREFIX_CHARS = 256
FILTER_BITS = 1 << 23


def copy_groups(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    prefix_chars: int = PREFIX_CHARS, filter_bits: int = FILTER_BITS, digest_all: bool = False,
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``digest``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays. ``digest`` is the SHA-256 of the folded text; it is
    null for rows that were told apart earlier, unless ``digest_all``.

    A null id ranks below every other; a group of null ids alone keeps them all, with a null
    ``keep_id``. Rows that repeat the id that stays are all marked kept (:func:`drop_copies` leaves
    one). An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"))
    length = F.octet_length(F.coalesce("_text", F.lit("")))
    prefix = F.xxhash64(fold(F.substring("_text", 1, prefix_chars)))
    key = F.struct(F.col("_length"), F.col("_prefix"))
    traits = rows.select("_id", "_text", length.alias("_length"), prefix.alias("_prefix"))

    pairs = staged(traits.groupBy("_length", "_prefix").agg(F.count(F.lit(1)).alias("_rows")), "prefixes")
    shared_lengths = pairs.groupBy("_length").agg(F.sum("_rows").alias("_same")).where("_same > 1").select("_length")
    colliding = pairs.where("_rows > 1").join(shared_lengths, "_length", "left_semi")
    table = bit_table(colliding, key, filter_bits)

    digest = F.sha2(fold(F.col("_text")), 256)
    surviving = with_bit(traits, table, key, filter_bits, "_open")
    hashed = staged(surviving.select(
        "_id", "_open", (digest if digest_all else F.when(F.col("_open"), digest)).alias("_digest"),
    ), "digests")
    groups = hashed.where("_open").groupBy("_digest").agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"),
    ).where("_size > 1").withColumnRenamed("_digest", "_group")
    # Written first, so that the join below reads both sides from exchanges of its own and can split a hot group.
    groups = staged(groups, "copy-groups")
    # Rows without a group are spread by their id, not gathered under a null.
    by = F.coalesce(F.when(F.col("_open"), F.col("_digest")), F.col("_id").cast("string"), F.lit(""))
    joined = hashed.withColumn("_by", by).join(groups, F.col("_by") == F.col("_group"), "left")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    return joined.select(
        F.col("_id").alias(id_column), keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        keep.eqNullSafe(F.col("_id")).alias("kept"), F.col("_digest").alias("digest"),
    )


def drop_copies(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``documents`` without exact copies; the row with the largest id of each group stays, once. Rows of one id are judged each by its own text."""
    groups = copy_groups(documents, id_column, text_column)
    verdicts = groups.select(F.col(f"`{id_column}`").alias("_id"), F.col("digest").alias("_mark"), F.col("kept").alias("_stays"))
    return retain(documents, verdicts, id_column, F.sha2(fold(F.col(f"`{text_column}`")), 256), once=True)
