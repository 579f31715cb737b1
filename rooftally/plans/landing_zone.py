"""The derived raw listings written out as landing files, to be scanned back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LISTING_COLUMNS, SOURCES
from .rawview import raw_listings


def _record() -> Column:
    """The row as JSON. Every seventh carries numbers where the others carry text."""
    as_text = F.struct(*LISTING_COLUMNS)
    numeric = {
        "rooms": F.replace("rooms", F.lit(","), F.lit(".")).try_cast("double"),
        "floor": F.col("floor").try_cast("int"),
        "price": F.regexp_replace("price", "[^0-9]", "").try_cast("double"),
    }
    # A number that cannot be had stays text, so that it still fails.
    as_numbers = F.struct(*[
        numeric[name].alias(name) if name in numeric else F.col(name) for name in LISTING_COLUMNS
    ])
    usable = (F.col("seq") % 7 == 0) & (F.col("floor") != "abc")
    return F.when(usable, F.to_json(as_numbers)).otherwise(F.to_json(as_text))


def write_json_landing(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """One folder of JSON lines per source, lines in ingest order. Returns the folders."""
    rows = raw_listings(spark, sf_dir)
    folders = [f"{folder}/{source}" for source in SOURCES]
    for source, path in zip(SOURCES, folders):
        lines = rows.where(F.col("source") == source).sort("seq")
        lines.select(_record().alias("value")).write.mode("overwrite").text(path)
    return folders


# Faults by order key: what happens to the record's line. Keys that several would take have the first.
FAULTS = (
    ("seq % 211 = 0", "missing source", lambda: _without("source")),
    ("seq % 223 = 0", "missing deal_type", lambda: _without("deal_type")),
    ("seq % 227 = 0", "missing property_type", lambda: _without("property_type")),
    ("seq % 229 = 0", "malformed record", lambda: F.concat(F.lit("{broken "), F.col("id"))),
    ("seq % 233 = 0", "bad price", lambda: _with("price", '"1' + "0" * 320 + '"')),
    ("seq % 239 = 0", "no id", lambda: _without("id")),
    ("seq % 241 = 0", "null phone", lambda: F.to_json(F.struct(*LISTING_COLUMNS[:-1], F.lit(None).cast("string").alias("agent_phone")), {"ignoreNullFields": "false"})),
    ("seq % 251 = 0", "number for id", lambda: _with("id", "12345678901")),
    ("seq % 257 = 0", "lorem ipsum", lambda: _described("lorem ipsum dolor")),
    ("seq % 263 = 0", "dummy", lambda: _described("a Dummy flat")),
    ("seq % 269 = 0", "fake", lambda: _described("FAKE listing")),
    ("seq % 271 = 0", "placeholder", lambda: _described("placeholder text")),
    ("seq % 277 = 0", "two keywords", lambda: _described("fake and lorem ipsum")),
)


def _without(name: str) -> Column:
    return F.to_json(F.struct(*[other for other in LISTING_COLUMNS if other != name]))


def _with(name: str, value: str) -> Column:
    """The record with a value put into a field as it is written."""
    rest = F.to_json(F.struct(*[other for other in LISTING_COLUMNS if other != name]))
    return F.concat(F.lit(f'{{"{name}":{value},'), F.substring(rest, F.lit(2), F.length(rest)))


def _described(text: str) -> Column:
    return F.to_json(F.struct(*[F.lit(text).alias(name) if name == "description" else F.col(name) for name in LISTING_COLUMNS]))


def write_faulty_landing(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """The JSON landing with records that miss keys, hold other types, or are not JSON at all."""
    rows = raw_listings(spark, sf_dir)
    line = _record()
    for condition, _, faulty in reversed(FAULTS):
        line = F.when(F.expr(condition), faulty()).otherwise(line)
    folders = [f"{folder}/{source}" for source in SOURCES]
    for source, path in zip(SOURCES, folders):
        rows.where(F.col("source") == source).sort("seq").select(line.alias("value")).write.mode("overwrite").text(path)
    return folders


def write_parquet_landing(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    rows: DataFrame = raw_listings(spark, sf_dir)
    folders = [f"{folder}/{source}" for source in SOURCES]
    for source, path in zip(SOURCES, folders):
        ordered = rows.where(F.col("source") == source).sort("seq")
        ordered.select(*LISTING_COLUMNS).write.mode("overwrite").parquet(path)
    return folders
