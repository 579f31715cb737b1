"""What the operators share: letter folding, filters of bounded size, running sums, row retention, imports on workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import importable
from ..staging import run_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

# Words of letters and digits, every other code point beyond ASCII included.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when it is not installed on them."""
    return importable(spark)


def fold(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is; null counts as empty.

    A text of ASCII alone takes the fast built-in; only others are translated letter by letter.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The folded words of ``text`` in order; none for null."""
    return F.regexp_extract_all(fold(text), F.lit(WORD), F.lit(0))


def staged(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """``df`` written to the shared folder, or ``folder`` in it, and read back: computed once, safe when executors are lost."""
    path = f"{folder}/{label}" if folder else run_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def filter_size(keys: DataFrame, least: int = 1 << 16, most: int = 1 << 26) -> int:
    """Bits for a filter over ``keys``, some 16 for each as far as 8 MB go. ``keys`` are counted, so they should be written."""
    return min(most, max(least, 1 << (16 * keys.count()).bit_length()))


def running_before(rows: DataFrame, key: str, value: str, name: str, width: int = 4096) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over rows of a smaller ``key``, whole numbers that are not repeated.

    Keys are summed in stretches of ``width`` first, so one task sees a row for each stretch, and no task more than
    ``width`` rows of one. ``rows`` are read twice, so they should be written.
    """
    own = rows.withColumn("_stretch", F.floor(F.col(key) / width))
    earlier = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = own.groupBy("_stretch").agg(F.sum(value).alias("_sum")).select(
        "_stretch", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_earlier"),
    )
    inside = Window.partitionBy("_stretch").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return own.join(stretches, "_stretch").withColumn(
        name, F.col("_earlier") + F.coalesce(F.sum(value).over(inside), F.lit(0)),
    ).drop("_stretch", "_earlier")


def bit_table(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """A filter of at most ``bits`` / 8 bytes over ``key``: rows of 4 KB, so it may always be broadcast.

    Keys beyond its room make it let more rows through, never fewer.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return keys.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap"),
    )


def with_bit(rows: DataFrame, table: DataFrame, key: Column, bits: int, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: false only for keys that the filter has not seen."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), position % 8).cast("int")) > 0, F.lit(False))
    joined = rows.join(F.broadcast(table), F.bitmap_bucket_number(slot) == table["_bucket"], "left")
    return joined.withColumn(name, is_set).drop("_bucket", "_bitmap")


def retain(documents: DataFrame, verdicts: DataFrame, id_column: str, mark: Column, *, once: bool) -> DataFrame:
    """The rows of ``documents`` that stay under ``verdicts``: ``_id``, ``_mark`` and ``_stays`` for each row.

    ``mark`` gives the ``_mark`` of a row from its columns. It tells rows of one id apart, so each is judged by
    itself; a verdict without a mark always stays. With ``once``, rows that repeat both id and mark stay once.
    Only ids that go or repeat are joined, so the texts of the rest need not be grouped, and marks are worked
    out for repeated ids alone. Columns keep their names and values, whatever they are called.
    """
    changes = verdicts.groupBy("_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_stays").alias("_all"), F.max("_stays").alias("_any"),
    ).where("NOT _all OR _rows > 1" if once else "NOT _all")
    changes = staged(changes, "verdicts")
    of_row = F.col(f"d.`{id_column}`").eqNullSafe(F.col("v._id"))
    rows, marks = documents.alias("d"), changes.alias("v")
    plain = rows.join(marks, of_row, "left_anti")
    # Of an id with several rows, some of which stay, each row is looked up by its mark.
    mixed = changes.where("_rows > 1 AND _any").alias("v")
    again = rows.join(mixed, of_row, "left_semi").select(F.col(f"`{id_column}`").alias("_id"), mark.alias("_mark"), F.struct("*").alias("row"))
    gone = staged(verdicts.where("NOT _stays").join(mixed.select("_id"), verdicts["_id"].eqNullSafe(F.col("v._id")), "left_semi").select(
        F.col("_id").alias("_gone"), F.col("_mark").alias("_gone_mark"),
    ).distinct(), "gone")
    again = again.join(gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_mark") == F.col("_gone_mark")), "left_anti")
    if once:
        again = again.groupBy("_id", "_mark").agg(F.min(F.struct(F.to_json("row").alias("_order"), F.col("row"))).getField("row").alias("row"))
    return plain.unionByName(again.select("row.*"))
