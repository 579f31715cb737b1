"""Text and number parsing with the semantics of Python's str/int/float.

The feeds were cleaned with Python rules before; Java's ``\\s`` and Spark's
string-to-double cast differ from them, so the rules are spelled out here as
built-in expressions.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's Unicode whitespace: as the inside of a regex character class, and spelled out.
WHITESPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
_WHITESPACE_CHARACTERS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Python's float and int literals between optional whitespace; group 1 is the literal.
_FLOAT = (
    rf"(?i)^[{WHITESPACE}]*+([+-]?(?:"
    r"(?:[0-9]++(?:_[0-9]++)*+\.?(?:[0-9]++(?:_[0-9]++)*+)?|\.[0-9]++(?:_[0-9]++)*+)"
    r"(?:e[+-]?[0-9]++(?:_[0-9]++)*+)?"
    rf"|inf(?:inity)?|nan))[{WHITESPACE}]*+\z"
)
_INTEGER = rf"^[{WHITESPACE}]*+([+-]?[0-9]++(?:_[0-9]++)*+)[{WHITESPACE}]*+\z"


@lru_cache(maxsize=1)
def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit, and the ASCII digit it stands for."""
    found = [(ch, unicodedata.decimal(ch, None)) for ch in map(chr, range(0x80, sys.maxunicode + 1))]
    pairs = [(ch, str(value)) for ch, value in found if value is not None]
    return "".join(ch for ch, _ in pairs), "".join(digit for _, digit in pairs)


# The functions below mention their input once wherever they can. Spark inlines
# expressions, so a chain of steps that each mention theirs twice would double
# in size, and in work, with every step.


def ascii_digits(text: Column) -> Column:
    """Rewrite digits of other scripts as 0-9. ASCII text, which has as many bytes as characters, is passed on."""
    foreign, plain = _decimal_digits()
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(text, foreign, plain))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_WHITESPACE_CHARACTERS))


def collapse_runs(text: Column) -> Column:
    """Runs of two or more whitespace characters become one space; single ones stay."""
    return F.regexp_replace(text, rf"[{WHITESPACE}]{{2,}}", " ")


def _literal(text: Column, pattern: str) -> Column:
    """The literal in ``text`` without digit separators; empty if there is none."""
    return F.replace(F.regexp_extract(ascii_digits(text), pattern, 1), F.lit("_"), F.lit(""))


def parse_float(text: Column) -> Column:
    """``float(text)``, or null where Python would raise."""
    return _literal(text, _FLOAT).try_cast("double")


def parse_integer(text: Column) -> Column:
    """``int(text)`` as INT, or null where Python would raise (or beyond 32 bits)."""
    return _literal(text, _INTEGER).try_cast("int")


def float_text(number: Column) -> Column:
    """``str(float)``: like Spark's cast, but with Python's exponent thresholds.

    Java switches to exponents at 1e7 and 1e-3, Python at 1e16 and 1e-4.
    """
    text = number.cast("string")
    size = F.abs(number)
    # 2.5E7 as 25000000.0
    plain = F.regexp_replace(
        F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), r"0+\z", ""), r"\.\z", ".0"
    )
    # 1.0E-5 as 1e-05
    exponent = F.regexp_replace(F.regexp_replace(text, r"(?:\.0)?E", "e"), r"e([0-9])", "e+$1")
    scientific = F.regexp_replace(exponent, r"([+-])([0-9])\z", "$10$2")
    return (
        F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(F.isnan(number), "nan")
        .when(size == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .otherwise(scientific)
    )
