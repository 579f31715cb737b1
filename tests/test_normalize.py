from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from rooftally.operators import normalize, normalizer_counts
from rooftally.schema import LISTING, LISTING_COLUMNS
from rooftally.sources import ordered_union, scan_json, scan_table, source_counts, with_sequence

GOOD = {
    "id": "a", "source": "yad2", "city": " חיפה  ", "neighborhood": "הדר", "street": "הרצל  1", "deal_type": "למכירה",
    "property_type": "דירה", "rooms": "3,5", "floor": 2.7, "size_sqm": "80.5", "price": "₪2,500,000",
    "description": "דירה", "scraped_at": "2030-05-06T07:08:09", "agent_phone": "08-5550000",
}


def _without(*keys):
    return {k: v for k, v in GOOD.items() if k not in keys}


def _write(folder, name, records):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_json_records(spark, tmp_path):
    _write(tmp_path / "in", "a.json", [
        GOOD,
        {**GOOD, "id": "no-deal-type"} | {"deal_type": None},
        {**_without("deal_type"), "id": "missing"},
        {**GOOD, "id": "floor", "floor": "abc"},
        {**GOOD, "id": "size", "size_sqm": "80,5"},
        {**GOOD, "id": "huge", "price": "9" * 400},
        "{not json",
        _without("id", "scraped_at", "agent_phone", "floor", "size_sqm"),
        {**GOOD, "id": None, "agent_phone": 501234567},
    ])
    result = normalize(scan_json(spark, str(tmp_path / "in"), 0))
    clean = [r.asDict() for r in result.clean.orderBy("_seq").collect()]
    assert [r["id"] for r in clean] == ["a", "no-deal-type", "", ""]
    assert {k: clean[0][k] for k in ("city", "street", "rooms", "floor", "size_sqm", "price")} == {
        "city": "חיפה", "street": "הרצל 1", "rooms": 3.5, "floor": 2, "size_sqm": 80.5, "price": 2500000.0,
    }
    assert clean[1]["deal_type"] is None            # present but null is kept
    assert clean[2]["floor"] == 0 and clean[2]["size_sqm"] == 0.0 and clean[2]["agent_phone"] == ""
    assert clean[3]["id"] == "" and clean[3]["agent_phone"] == "501234567"

    failed = result.quarantine.orderBy("_seq").collect()
    assert [r["_error"] for r in failed] == [
        "missing deal_type", "bad floor", "bad size_sqm", "price not finite", "malformed record",
    ]
    assert json.loads(failed[0]["_raw"])["id"] == "missing"
    assert failed[4]["_raw"] == "{not json"
    counts = normalizer_counts(result.tagged).first()
    assert (counts.input_count, counts.output_count) == (9, 4)


def test_records_of_every_kind(spark, tmp_path):
    """Kinds are told apart by what is kept of a field: absent, null, text, numbers, booleans, nested values."""
    values = [None, "5", "", 5, -2.5, 2**70, 1e300, True, [1, "a"], {"b": None}]
    _write(tmp_path / "in", "a.json", [{**GOOD, "id": v, "size_sqm": "bad"} for v in values] + [{**_without("id"), "size_sqm": "bad"}])
    scanned = scan_json(spark, str(tmp_path / "in"), 0)
    tagged = normalize(scanned).tagged.orderBy("_seq").collect()
    assert [r["id"] for r in tagged] == [
        "", "5", "", "5", "-2.5", str(2**70), "1e+300", "True", '[1,"a"]', '{"b":null}', "",
    ]
    raws = [json.loads(r["_raw"]) for r in tagged]
    assert [raw["id"] for raw in raws[:-1]] == values and "id" not in raws[-1]


def test_fields_are_opened_in_one_step(spark, tmp_path):
    """Each mention of a VARIANT copies it, and each further step copies all that was opened."""
    _write(tmp_path / "in", "a.json", [GOOD])
    plan = scan_json(spark, str(tmp_path / "in"), 0)._jdf.queryExecution().executedPlan().toString()
    opening = [line for line in plan.splitlines() if ".spelled" in line or "SchemaOfVariant" in line]
    assert len(opening) == 1
    assert opening[0].count("SchemaOfVariant.schemaOfVariant(") == len(LISTING_COLUMNS)
    assert "regexp" not in opening[0] and "isnull" not in opening[0]


def test_cleaning_of_records_is_not_fused(spark, tmp_path):
    """Fused into one method the cleaning of opened fields would be beyond what the JVM takes; see ``session.RUNTIME``."""
    _write(tmp_path / "in", "a.json", [GOOD])
    tagged = normalize(scan_json(spark, str(tmp_path / "in"), 0)).tagged
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    cleaning = re.findall(r"(\*\(\d+\) )?Project \[coalesce\(.*\.kind = STR", plan)
    assert cleaning == [""]


def test_output_schema(spark, tmp_path):
    _write(tmp_path / "in", "a.json", [GOOD])
    clean = normalize(scan_json(spark, str(tmp_path / "in"), 0)).clean.select(*LISTING_COLUMNS)
    assert [(f.name, f.dataType) for f in clean.schema] == [(f.name, f.dataType) for f in LISTING]


def test_typed_null_in_required_field_is_quarantined(spark):
    df = spark.createDataFrame([("a", "yad2", None, "דירה")], "id string, source string, deal_type string, property_type string")
    assert [r["_error"] for r in normalize(df).quarantine.collect()] == ["missing deal_type"]


def test_json_order_is_file_order_whatever_the_splits(spark, tmp_path):
    n = 500
    _write(tmp_path / "in", "b.json", [{**GOOD, "id": f"b{i}"} for i in range(n)])
    _write(tmp_path / "in", "a.json", [{**GOOD, "id": f"a{i}"} for i in range(n)])
    want = [f"{name}{i}" for name in "ab" for i in range(n)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("7000", "60000", before):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = scan_json(spark, str(tmp_path / "in"), 0).select("id.spelled", "_seq")
            assert [r[0] for r in rows.orderBy("_seq").collect()] == want
            assert rows.select("_seq").distinct().count() == 2 * n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_parquet_scan_orders_and_tags(spark, tmp_path):
    spark.range(100).select(F.concat(F.lit("p"), "id").alias("id"), F.lit("?").alias("source")).coalesce(1).write.parquet(
        str(tmp_path / "t")
    )
    rows = scan_table(spark, str(tmp_path / "t"), 1, source="facebook").orderBy("_seq").collect()
    assert [r.id for r in rows] == [f"p{i}" for i in range(100)]
    assert {r.source for r in rows} == {"facebook"} and {r._seq.source_rank for r in rows} == {1}


def test_union_keeps_copies_and_source_order(spark):
    def source(rank, name, ids):
        df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id string, n long")
        return with_sequence(df, rank, "n", name)
    union = ordered_union(source(0, "yad2", ["x", "y"]), source(1, "facebook", ["x", "x", "z"]))
    assert [r.id for r in union.orderBy("_seq").collect()] == ["x", "y", "x", "x", "z"]
    assert {r.source: r.n for r in source_counts(union).collect()} == {"yad2": 2, "facebook": 3}
