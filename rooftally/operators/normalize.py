"""Raw records to clean listings, with unusable records set aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import cell_of, is_opened, open_variants
from ..functions.coerce import clean_floor, clean_price, clean_rooms, clean_size, clean_text, scalar_text
from ..schema import ERROR_COLUMN, LISTING_COLUMNS, RAW_COLUMN, REQUIRED_KEYS, SEQ_COLUMN

# Set by the JSON source on lines that do not parse; holds the line.
MALFORMED_COLUMN = "_malformed"

_CLEANERS = {
    "city": clean_text, "neighborhood": clean_text, "street": clean_text, "description": clean_text,
    "rooms": clean_rooms, "floor": clean_floor, "size_sqm": clean_size, "price": clean_price,
}


@dataclass(frozen=True)
class Normalized:
    tagged: DataFrame       # every input row: listing, order key, error, raw record if failed
    clean: DataFrame        # rows without error: listing, order key
    quarantine: DataFrame   # rows with one: order key, error, raw record as JSON text


def _cleaned(df: DataFrame, name: str) -> Column:
    cell = cell_of(df, name)
    if name in _CLEANERS:
        return _CLEANERS[name](cell)
    if name in REQUIRED_KEYS:
        return scalar_text(cell)
    return F.coalesce(scalar_text(cell), F.lit(""))


def _has_key(df: DataFrame, key: str) -> Column:
    present = cell_of(df, key).present
    return F.lit(False) if present is None else present


def _error(df: DataFrame) -> Column:
    """First thing wrong with the record, from the raw keys and the cleaned values."""
    checks = []
    if MALFORMED_COLUMN in df.columns:
        checks.append(F.when(F.col(MALFORMED_COLUMN).isNotNull(), "malformed record"))
    checks += [F.when(~F.col(f"_has_{key}"), f"missing {key}") for key in REQUIRED_KEYS]
    checks += [
        F.when(F.col("floor").isNull(), "bad floor"),
        F.when(F.col("size_sqm").isNull(), "bad size_sqm"),
        F.when(~(F.col("price") < float("inf")), "price not finite"),
    ]
    return F.coalesce(*checks)


def _raw_member(df: DataFrame, name: str) -> Column:
    """One ``"name":value`` of the record as it came; null if the key was absent."""
    def written(value: Column) -> Column:
        return F.nullif(F.regexp_extract(F.to_json(F.struct(value.alias(name))), r"(?s)^\{(.*)\}\z", 1), F.lit(""))

    value = F.col(f"_in_{name}")
    if not is_opened(df.schema[name].dataType):
        return written(value)
    bare = F.concat(F.lit(f'"{name}":'), F.coalesce(value["spelled"], F.lit("null")))
    return F.when(value["kind"] == "STR", written(value["spelled"])).when(value["kind"].isNotNull(), bare)


def _raw_record(df: DataFrame, fields: list[str], has_line: bool) -> Column:
    """The record as it came: the unparsed line, or its fields as JSON."""
    record = F.concat(F.lit("{"), F.concat_ws(",", *[_raw_member(df, name) for name in fields]), F.lit("}"))
    return F.coalesce(F.col(MALFORMED_COLUMN), record) if has_line else record


def _kept_above(verdict: Column) -> Column:
    """``verdict`` as a value that filters are not pushed through.

    Pushed below the cleaning, a filter on it would work out every field a second
    time. The running id is never below zero, but Spark may not look behind it.
    """
    return F.coalesce(verdict, F.when(F.monotonically_increasing_id() < 0, ""))


def tag_normalized(df: DataFrame) -> DataFrame:
    """Cleaned listing columns, order key, and ``_error``/``_raw`` for failing rows.

    Steps are separate projections so that each value is worked out once, and
    the raw record is only spelled out for rows that failed.
    """
    carried = [SEQ_COLUMN] if SEQ_COLUMN in df.columns else []
    line = [MALFORMED_COLUMN] if MALFORMED_COLUMN in df.columns else []
    fields = [name for name in df.columns if not name.startswith("_")]
    dirty = open_variants(df)
    cleaned = dirty.select(
        *[_cleaned(dirty, name).alias(name) for name in LISTING_COLUMNS],
        *carried, *line,
        *[_has_key(dirty, key).alias(f"_has_{key}") for key in REQUIRED_KEYS],
        *[F.col(name).alias(f"_in_{name}") for name in fields],
    )
    flagged = cleaned.withColumn(ERROR_COLUMN, _kept_above(_error(cleaned)))
    raw = F.when(F.col(ERROR_COLUMN).isNotNull(), _raw_record(dirty, fields, bool(line)))
    return flagged.select(*LISTING_COLUMNS, *carried, ERROR_COLUMN, raw.alias(RAW_COLUMN))


def split_normalized(tagged: DataFrame) -> Normalized:
    carried = [SEQ_COLUMN] if SEQ_COLUMN in tagged.columns else []
    failed = F.col(ERROR_COLUMN).isNotNull()
    return Normalized(
        tagged=tagged,
        clean=tagged.where(~failed).select(*LISTING_COLUMNS, *carried),
        quarantine=tagged.where(failed).select(*carried, ERROR_COLUMN, RAW_COLUMN),
    )


def normalize(df: DataFrame) -> Normalized:
    return split_normalized(tag_normalized(df))
