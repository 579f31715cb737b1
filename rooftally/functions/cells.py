"""One dirty field, split by the kind of value it holds.

Landing JSON is read with VARIANT fields, so a field may hold text, a number, a
boolean, a nested value, JSON null, or be absent; :func:`open_variants` tells them apart. Typed tables hold one kind.
Cleaning rules are written once against :class:`Cell` and work on both.

Numbers never pass through Spark's double-to-string cast: ``25000000.0`` would
become ``2.5E7`` and lose its exponent when digits are filtered.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pytext import float_text


@dataclass(frozen=True)
class Cell:
    """A field's value by kind; ``None`` for kinds its column cannot hold."""

    present: Column | None = None   # key exists (JSON null counts as present)
    text: Column | None = None      # STRING, when the value is text
    number: Column | None = None    # DOUBLE, when the value is a number
    flag: Column | None = None      # BOOLEAN, when the value is a boolean
    nested: Column | None = None    # JSON text, when the value is an array or object
    literal: Column | None = None   # STRING spelling of a number, date or timestamp


def missing_cell() -> Cell:
    return Cell()


def by_kind(cell: Cell, default: object, **rules: Callable[[Column], Column]) -> Column:
    """The rule for the kind of value at hand; ``default`` when there is none (null or absent)."""
    branches = [(getattr(cell, kind), rule) for kind, rule in rules.items() if getattr(cell, kind) is not None]
    result = F.lit(default)
    for value, rule in reversed(branches):
        result = F.when(value.isNotNull(), rule(value)).otherwise(result)
    return result


# A VARIANT field taken apart. Both null if the key is absent.
#   kind: the beginning of STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, ARRAY, OBJECT or VOID (JSON null)
#   spelled: the value's text, whatever its kind
# Cells tell the kinds apart where a rule asks for them. Every mention of a variant copies it, so there are but two.
OPENED = ("kind", "spelled")

_READ = "named_struct('kind', left(schema_of_variant({0}), 3), 'spelled', cast({0} AS STRING)) AS {0}"
_NUMBERS = ("BIG", "DEC", "DOU", "FLO")


def open_variants(df: DataFrame, *also: Column) -> DataFrame:
    """``df`` with its VARIANT columns as ``OPENED`` structs, plus the columns ``also``."""
    dirty = {f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)}
    if not dirty:
        return df.select("*", *also)
    return df.select(*[F.expr(_READ.format(name)) if name in dirty else name for name in df.columns], *also)


def is_opened(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) and tuple(kind.names) == OPENED


def _opened_cell(value: Column) -> Cell:
    kind, spelled = value["kind"], value["spelled"]
    parsed, is_number = spelled.try_cast("double"), kind.isin(*_NUMBERS)
    # A JSON integer beyond 64 bits arrives as a DECIMAL; it keeps its digits too.
    whole = (kind == "BIG") | ((kind == "DEC") & (F.abs(parsed) >= 2.0**63))
    return Cell(
        present=kind.isNotNull(),
        text=F.when(kind == "STR", spelled),
        number=F.when(is_number, parsed),
        flag=F.when(kind == "BOO", spelled == "true"),
        nested=F.when(kind.isin("ARR", "OBJ"), spelled),
        literal=F.when(whole, spelled).when(is_number, float_text(parsed)),
    )


def cell_of(df: DataFrame, name: str) -> Cell:
    """The cell for column ``name``; an absent column is a key no record has."""
    if name not in df.columns:
        return missing_cell()
    value, kind = F.col(name), df.schema[name].dataType
    present = value.isNotNull()
    if is_opened(kind):
        return _opened_cell(value)
    if isinstance(kind, T.StringType):
        return Cell(present, text=value)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return Cell(present, number=value.cast("double"), literal=float_text(value.cast("double")))
    if isinstance(kind, T.NumericType):
        return Cell(present, number=value.cast("double"), literal=value.cast("string"))
    if isinstance(kind, T.BooleanType):
        return Cell(present, flag=value)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return Cell(present, nested=F.to_json(value))
    return Cell(present, literal=value.cast("string"))  # dates and timestamps
