"""Field rules, on text columns and on VARIANT values, against literals and against Python itself."""

from __future__ import annotations

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from rooftally.functions.cells import open_variants
from rooftally.functions import (
    cell_of, clean_floor, clean_price, clean_rooms, clean_size, clean_text, fingerprint, float_text, price_bucket,
    scalar_text,
)

NBSP = "\u00a0"

PRICE = [
    ("1500000", 1500000.0), ("₪2,500,000", 2500000.0), (3500.5, 3500.5), (None, 0.0), ("N/A", 0.0), ("$500", 500.0),
    ("-500", 500.0), ("1.2.3", 0.0), (".", 0.0), ("", 0.0), ("3,5", 35.0), ("2.5E7", 2.57), (25000000.0, 25000000.0),
    (-500, 500.0), ("2 rooms, 900", 2900.0), ("٣٥٠٠", 3500.0), (True, 0.0), ([1, 2], 12.0), (1e16, 1e16),
]
ROOMS = [
    ("3", 3.0), ("3.5", 3.5), ("3,5", 3.5), (4.5, 4.5), (None, 0.0), ("חמש", 0.0), ("3d", 0.0), ("3f", 0.0),
    ("0x1p3", 0.0), ("1_000", 1000.0), ("1__0", 0.0), ("1,234.5", 0.0), ("-3", -3.0), (NBSP + "3.5", 3.5),
    ("1e1", 10.0), ("", 0.0), ("٣", 3.0), (True, 0.0), ([3], 0.0), ("3.", 3.0), (".5", 0.5), ("_1", 0.0),
]
TEXT = [
    ("תל   אביב", "תל אביב"), ("  ירושלים  ", "ירושלים"), (None, ""), (42, ""), ("רמת גן", "רמת גן"),
    ("a\tb", "a\tb"), ("a\t\tb", "a b"), (NBSP + "x" + NBSP, "x"), ("a\x1c\x1cb", "a b"), ("", ""), (" \n ", ""),
    ("a" + NBSP + "b", "a" + NBSP + "b"), (["x"], ""), (True, ""),
]
FLOOR = [
    ("5", 5), (2.7, 2), (-2.7, -2), (None, 0), ("", 0), ("abc", None), ("2.7", None), (" 7 ", 7), ("1_0", 10),
    ("  ", None), ("-3", -3), (True, 1), (0, 0), ([], 0), ({}, 0), ([1], None), (99999999999, None),
    ("99999999999", None), ("+4", 4),
]
SIZE = [
    ("80.5", 80.5), (None, 0.0), ("80,5", None), ("", 0.0), (75, 75.0), (False, 0.0), ("1e2", 100.0), ({}, 0.0),
    ({"a": 1}, None), (" ", None),
]
SCALAR = [("x", "x"), (5, "5"), (5.5, "5.5"), (True, "True"), (False, "False"), (None, None), ("", ""), (1e20, "1e+20")]

RULES = [
    (clean_price, PRICE), (clean_rooms, ROOMS), (clean_text, TEXT), (clean_floor, FLOOR), (clean_size, SIZE),
    (scalar_text, SCALAR),
]


def _values(df, rule):
    rows = df.withColumn("out", rule(cell_of(df, "v"))).orderBy("i").collect()
    return [row["out"] for row in rows]


@pytest.mark.parametrize("rule,cases", RULES, ids=lambda x: getattr(x, "__name__", ""))
def test_variant_values(spark, rule, cases):
    lines = [(i, json.dumps(value)) for i, (value, _) in enumerate(cases)]
    df = spark.createDataFrame(lines, "i int, j string").select("i", F.parse_json("j").alias("v"))
    assert _values(open_variants(df), rule) == [want for _, want in cases]


@pytest.mark.parametrize("rule,cases", RULES, ids=lambda x: getattr(x, "__name__", ""))
def test_text_columns(spark, rule, cases):
    texts = [(value, want) for value, want in cases if value is None or isinstance(value, str)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(texts)], "i int, v string")
    assert _values(df, rule) == [want for _, want in texts]


def test_number_columns(spark):
    df = spark.createDataFrame([(0, 2.5e7), (1, -3.9), (2, None), (3, float("nan")), (4, float("inf"))], "i int, v double")
    assert _values(df, clean_price) == [2.5e7, 3.9, 0.0, 0.0, 0.0]
    assert _values(df, clean_floor) == [25000000, -3, 0, None, None]
    assert _values(df, clean_text) == [""] * 5
    assert _values(df, clean_rooms)[:3] == [2.5e7, -3.9, 0.0]


def test_absent_column(spark):
    df = spark.range(1)
    row = df.select(
        clean_price(cell_of(df, "v")), clean_rooms(cell_of(df, "v")), clean_text(cell_of(df, "v")),
        clean_floor(cell_of(df, "v")), clean_size(cell_of(df, "v")), scalar_text(cell_of(df, "v")),
    ).first()
    assert tuple(row) == (0.0, 0.0, "", 0, 0.0, None)


def _python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def _python_int(text):
    try:
        value = int(text)
    except ValueError:
        return None
    return value if -(2**31) <= value < 2**31 else None


def _same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_fuzz_against_python(spark):
    random.seed(7)
    alphabet = "0123456789" * 3 + "..,,__+-eE \t₪$xdfnaNiI" + NBSP + "٣"
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 9))) for _ in range(20000)]
    texts += ["inf", "-Infinity", "nan", "+inf", "1e400", "9" * 310, "infinit", "1e", "e1", "1_e1", "1._5", "1.5_0"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    prices, rooms = _values(df, clean_price), _values(df, clean_rooms)
    floors, sizes = _values(df, clean_floor), _values(df, clean_size)
    for text, price, room, floor, size in zip(texts, prices, rooms, floors, sizes):
        kept = "".join(ch for ch in text if ch.isdecimal() or ch == ".")
        assert _same(price, _python_float(kept) or 0.0), text
        assert _same(room, _python_float(text.replace(",", ".")) or 0.0), text
        assert floor == (_python_int(text) if text else 0), text
        assert _same(size, _python_float(text) if text else 0.0), text


def test_fuzz_text_against_python(spark):
    import re
    random.seed(8)
    spaces = [ch for ch in map(chr, range(0x3001)) if ch.isspace()]
    alphabet = ["a", "ב", "\u200b", "\ufeff", *spaces]
    texts = ["".join(random.choices(alphabet, k=random.randint(0, 12))) for _ in range(5000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    assert _values(df, clean_text) == [re.sub(r"\s{2,}", " ", t).strip() for t in texts]


def test_float_text_against_python(spark):
    random.seed(9)
    values = [0.0, -0.0, 3.0, 3.5, 1e7, 2.5e7, 1e15, 1e16, 1.5e16, 1e22, 1e-3, 1e-4, 1e-5, -2.5e7, -1e-4, 1e100, 1.5e300]
    values += [float("nan"), float("inf"), float("-inf")]
    values += [round(random.uniform(0, 50), 1) for _ in range(300)]
    values += [random.randint(1, 10**12) / 4 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for value, text in df.select("x", float_text(F.col("x"))).collect():
        assert text == str(value)


def test_price_bucket_rounds_half_to_even(spark):
    prices = [1_950_000.0, 2_050_000.0, 50_000.0, 150_000.0, 50_000.01, 0.0, 12_000.0, 2_449_999.0]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in prices], "p double").select(price_bucket(F.col("p"))).collect()]
    assert got == [round(p / 100_000) * 100_000 for p in prices]
    assert got[0] == got[1] == 2_000_000


def test_fingerprint_is_md5_of_the_parts(spark):
    import hashlib
    cases = [("נתניה", "סמטת הגפן 4", 2.5, 2_250_000.0, "למכירה"), ("HAIFA", "Main St", 3.5, 9_000.0, "להשכרה"),
             ("", "", 0.0, 0.0, ""), ("a|b", "İ", 12.0, 3.25e7, "x")]
    df = spark.createDataFrame(cases, "c string, s string, r double, p double, d string")
    got = [r[0] for r in df.select(fingerprint(*map(F.col, "csrpd"))).collect()]
    for (city, street, rooms, price, deal), digest in zip(cases, got):
        parts = [city.lower(), street.lower(), str(rooms), str(round(price / 100_000) * 100_000), deal]
        assert digest == hashlib.md5("|".join(parts).encode()).hexdigest()


def test_fingerprint_of_nulls_keeps_the_parts_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None)], "c string, s string")
    a, b = (r[0] for r in df.select(fingerprint(F.col("c"), F.col("s"), F.lit(1.0), F.lit(1.0), F.lit("d"))).collect())
    assert a != b
