"""Field cleaning rules, each a Cell-to-Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import pytext
from .cells import Cell, by_kind


def _digits(text: Column) -> Column:
    """The number spelled by the digits and dots of a text."""
    return F.regexp_replace(pytext.ascii_digits(text), r"[^0-9.]", "").try_cast("double")


def clean_price(cell: Cell) -> Column:
    """Digits and dots of the text, as a number; anything unusable is 0.

    The sign and thousands separators go with the other characters, so numbers
    are taken by absolute value.
    """
    parsed = by_kind(
        cell, 0.0,
        text=_digits,
        number=lambda n: F.when(F.abs(n) < float("inf"), F.abs(n)),
        nested=_digits,
    )
    return F.coalesce(parsed, F.lit(0.0))


def clean_rooms(cell: Cell) -> Column:
    """A number whose decimal mark may be a comma; anything unusable is 0."""
    parsed = by_kind(
        cell, 0.0,
        text=lambda t: pytext.parse_float(F.replace(t, F.lit(","), F.lit("."))),
        number=lambda n: n,
    )
    return F.coalesce(parsed, F.lit(0.0))


def clean_text(cell: Cell) -> Column:
    """Collapse whitespace runs and strip; a value that is not text becomes empty."""
    if cell.text is None:
        return F.lit("")
    return F.coalesce(pytext.strip(pytext.collapse_runs(cell.text)), F.lit(""))


def _empty_as(value: object):
    """An empty array or object counts as empty; any other nested value is an error."""
    return lambda nested: F.when(nested.isin("[]", "{}"), value)


def clean_floor(cell: Cell) -> Column:
    """Whole floor number, 0 when empty; null marks a value that is not one."""
    return by_kind(
        cell, 0,
        text=lambda t: F.when(t == "", 0).otherwise(pytext.parse_integer(t)),
        number=lambda n: n.try_cast("int"),
        flag=lambda f: f.cast("int"),
        nested=_empty_as(0),
    )


def clean_size(cell: Cell) -> Column:
    """Size as a number, 0 when empty; null marks a value that is not one."""
    return by_kind(
        cell, 0.0,
        text=lambda t: F.when(t == "", 0.0).otherwise(pytext.parse_float(t)),
        number=lambda n: n,
        flag=lambda f: f.cast("double"),
        nested=_empty_as(0.0),
    )


def scalar_text(cell: Cell) -> Column:
    """The value spelled out; null when it is null or absent."""
    flag = None if cell.flag is None else F.initcap(cell.flag.cast("string"))
    spelled = [part for part in (cell.text, cell.literal, flag, cell.nested) if part is not None]
    return F.coalesce(*spelled) if spelled else F.lit(None).cast("string")
