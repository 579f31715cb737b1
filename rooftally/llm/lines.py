"""Line deduplication: lines that many documents hold lose all their places.

Lines are exploded under a hash of their key (stripped of ASCII white space, A-Z folded), the
documents of each hash are counted, and hashes over the threshold are written. A second reading sends
the places of lines that may be among them to be joined, and every text is put together again, by
position, from the lines that are left. Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_table, filter_size, fold, staged, with_bit

LEAST_DOCUMENTS = 10
LEAST_CHARS = 1
BLANK = " \t\n\x0b\f\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(text: Column, least_chars: int) -> Column:
    """A hash of 128 bits for each line's key, in order; null for keys of fewer than ``least_chars`` code points."""
    def hashed(line: Column) -> Column:
        key = F.btrim(line, F.lit(BLANK))
        return F.when(F.char_length(key) >= least_chars, F.md5(key))

    # Folded as one text, which moves no line break.
    return F.transform(_lines(fold(text)), hashed)


def _keyed(id_column: str, text_column: str) -> list[Column]:
    """Rows go by id and a hash of their text: rows that agree in both have the same lines, so they may share results."""
    text = F.col(f"`{text_column}`")
    return [F.col(f"`{id_column}`").alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_mark"), text.alias("_text")]


def common_lines(
    documents: DataFrame, text_column: str = "text", *, least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """``_hash`` and ``n_documents`` of every line key that at least ``least_documents`` rows hold. A row that repeats a line counts once for it."""
    own = F.array_distinct(_hashes(F.col(f"`{text_column}`"), least_chars))
    # Counted before the shuffle: a task sends one row for each hash, however many of its documents hold the line.
    counts = documents.select(F.explode(own).alias("_hash")).where("_hash IS NOT NULL").groupBy("_hash").agg(F.count(F.lit(1)).alias("n_documents"))
    return counts.where(F.col("n_documents") >= least_documents)


def _dropped(rows: DataFrame, common: DataFrame, least_chars: int) -> DataFrame:
    """``_of``, ``_of_mark`` and ``_places`` (from 0) of the lines that go, a row for each document that has any."""
    bits = filter_size(common)
    placed = rows.select("_id", "_mark", F.posexplode(_hashes(F.col("_text"), least_chars)).alias("_place", "_hash")).where("_hash IS NOT NULL")
    maybe = with_bit(placed, bit_table(common, F.col("_hash"), bits), F.col("_hash"), bits, "_maybe").where("_maybe")
    # Both sides come from exchanges of the join's own, so that a line that a third of all rows hold can be split.
    found = maybe.select("_id", "_mark", "_place", "_hash").join(common.select("_hash"), "_hash", "left_semi")
    places = found.groupBy("_id", "_mark").agg(F.collect_set("_place").alias("_places"))
    return staged(places.select(F.col("_id").alias("_of"), F.col("_mark").alias("_of_mark"), "_places"), "dropped-lines")


def _reassembled(rows: DataFrame, common: DataFrame, least_chars: int) -> DataFrame:
    """``rows`` with ``_n_lines``, ``_n_dropped`` and ``_kept``, the text of the lines that stay."""
    dropped = _dropped(rows, common, least_chars)
    same = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_of_mark"))
    lines = _lines(F.col("_text"))
    # Set difference by hashing, so that a document of very many lines takes time in proportion.
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_places"))
    kept = F.array_join(F.transform(left, lambda place: F.get(lines, place)), "\n")
    # Places are few beside texts, so they are what is hashed; the same join at every size, and no sorting of texts.
    return rows.join(dropped.hint("shuffle_hash"), same, "left").withColumns({
        "_n_lines": F.size(lines).cast("bigint"),
        "_n_dropped": F.coalesce(F.size("_places"), F.lit(0)).cast("bigint"),
        "_kept": F.when(F.col("_places").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept),
    })


def line_report(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """One row per document: id, ``n_lines`` (before dropping), ``n_dropped`` and ``kept_text``.

    Texts are split at line feeds alone, so a null or empty text is one empty line; a carriage return
    belongs to the white space around a line. Each row is a document, rows that repeat an id or an id and a text
    included. Keys shorter than ``least_chars`` never go. A text all of whose lines go is empty. A text or line of
    any length counts whole; ties at the threshold go. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    common = staged(common_lines(documents, text_column, least_documents=least_documents, least_chars=least_chars), "common-lines")
    found = _reassembled(documents.select(*_keyed(id_column, text_column)), common, least_chars)
    return found.select(
        F.col("_id").alias(id_column), F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.col("_kept").alias("kept_text"),
    )


def drop_common_lines(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    least_documents: int = LEAST_DOCUMENTS, least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """``documents`` with the lines that stay as their texts, as :func:`line_report` has them; a null text becomes empty. Other columns stay as they are."""
    common = staged(common_lines(documents, text_column, least_documents=least_documents, least_chars=least_chars), "common-lines")
    kept = _reassembled(documents.select(*_keyed(id_column, text_column), F.struct("*").alias("_row")), common, least_chars)
    return kept.select(*[
        (F.col("_kept") if name == text_column else F.col(f"_row.`{name}`")).alias(name) for name in documents.columns
    ])
