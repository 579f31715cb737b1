from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rooftally.operators import (
    rejects_by_kind, sigma_stats, sigma_thresholds, spam_counts, screen, tag_outliers, validate, validator_counts,
)
from rooftally.operators.sigma import attach_stats, group_stats

RENT = "להשכרה"


def _split(df):
    result = validate(df)
    rejected = {r.listing.id: r.reason for r in result.rejected.collect()}
    return {r.id for r in result.valid.collect()}, rejected


def test_spam_reasons(listings):
    valid, rejected = _split(listings(
        {"id": "ok"},
        {"id": "city", "city": ""},
        {"id": "null-city", "city": None},
        {"id": "zero", "price": 0.0},
        {"id": "null-price", "price": None},
        {"id": "low", "price": 99.99},
        {"id": "edge", "price": 100.0, "deal_type": RENT},
        {"id": "keyword", "description": "מודעת בדיקה של המערכת"},
        {"id": "inside", "description": "the LaTest contest"},
        {"id": "several", "description": "fake dummy lorem ipsum"},
        {"id": "null-text", "description": None},
        {"id": "both", "city": "", "price": 5.0, "description": "test"},
    ))
    assert valid == {"ok", "edge", "null-text"}
    assert rejected == {
        "city": "missing city", "null-city": "missing city", "both": "missing city",
        "zero": "price too low (0.0)", "null-price": "price too low (None)", "low": "price too low (99.99)",
        "keyword": "spam keyword detected: 'בדיקה'", "inside": "spam keyword detected: 'test'",
        "several": "spam keyword detected: 'lorem ipsum'",
    }


def _cluster(n, step):
    return [{"id": f"n{i}", "price": 1_300_000.0 + i * step} for i in range(n)]


@pytest.mark.parametrize("odd,price", [("far above", 31_000_000.0), ("far below", 140.0)])
def test_one_outlier(listings, odd, price):
    valid, rejected = _split(listings(*_cluster(24, 7_000), {"id": odd, "price": price}))
    assert set(rejected) == {odd} and len(valid) == 24
    assert rejected[odd].startswith(f"price outlier: {price:.0f} is outside μ±3.0σ = [")


def test_outlier_reason_text(listings):
    prices = [1_300_000.0 + i * 7_000 for i in range(24)] + [31_000_000.0]
    mean = sum(prices) / 25
    sigma = (sum((p - mean) ** 2 for p in prices) / 25) ** 0.5
    _, rejected = _split(listings(*_cluster(24, 7_000), {"id": "odd", "price": 31_000_000.0}))
    assert rejected["odd"] == f"price outlier: 31000000 is outside μ±3.0σ = [{mean - 3 * sigma:.0f}, {mean + 3 * sigma:.0f}]"


def test_tight_cluster_and_constant_group(listings):
    assert not _split(listings(*_cluster(12, 4_000)))[1]
    assert not _split(listings(*[{"id": str(i)} for i in range(30)]))[1]
    assert not _split(listings({"id": "single"}))[1]


def test_fences_are_per_deal_type(listings):
    rents = [{"id": f"r{i}", "price": 5_000.0 + i, "deal_type": RENT} for i in range(20)]
    odd = {"id": "odd", "price": 50_000.0, "deal_type": RENT}
    assert set(_split(listings(*_cluster(24, 7_000), *rents, odd))[1]) == {"odd"}


def test_spam_does_not_shift_the_fences(listings):
    spam = [{"id": f"s{i}", "price": 9e9, "description": "test"} for i in range(50)]
    _, rejected = _split(listings(*_cluster(24, 7_000), {"id": "odd", "price": 31_000_000.0}, *spam))
    assert rejected["odd"].startswith("price outlier")


def test_null_deal_type_is_a_group(listings):
    rows = [{"id": f"n{i}", "price": 1000.0 + i, "deal_type": None} for i in range(20)]
    _, rejected = _split(listings(*rows, {"id": "odd", "price": 99_000.0, "deal_type": None}))
    assert set(rejected) == {"odd"}


def test_empty_and_all_spam(listings, spark):
    empty = listings({"id": "x"}).where("false")
    assert _split(empty) == (set(), {})
    valid, rejected = _split(listings({"id": "a", "city": ""}, {"id": "b", "price": 1.0}))
    assert valid == set() and set(rejected) == {"a", "b"}


def test_counts(listings):
    df = listings(*_cluster(24, 7_000), {"id": "odd", "price": 3.1e7}, {"id": "spam", "city": ""}, {"id": "low", "price": 1.0})
    result = validate(df)
    assert tuple(validator_counts(result.judged).first()) == (27, 24, 3)
    assert tuple(spam_counts(screen(df)).first()) == (25, 2)
    kinds = {r.reason_kind: r.n for r in rejects_by_kind(result.rejected).collect()}
    assert kinds == {"price outlier": 1, "missing city": 1, "price too low": 1}


def test_stats_are_population_moments(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 2.0)], "g string, v double")
    stats = {r.g: (r.n, r.mu, r.sigma, r.threshold) for r in sigma_thresholds(sigma_stats(df, "v", "g")).collect()}
    assert stats == {"a": (2, 2.0, 1.0, 3.0), "b": (1, 5.0, 0.0, 0.0), None: (1, 2.0, 0.0, 0.0)}


def _grouped(spark):
    """A hot group with a third of all rows, a hot one whose values are mostly null, one of nulls alone, a null key, many small ones."""
    hot = spark.range(6000).selectExpr("'hot' AS g", "double(id % 100 + if(id % 1000 = 0, 5000, 0)) AS v", "id")
    hollow = spark.range(4000).selectExpr("'hollow' AS g", "if(id % 100 = 0, double(id % 300 + if(id = 200, 9000, 0)), NULL) AS v", "id + 40000 AS id")
    nulls = spark.range(2000).selectExpr("'nulls' AS g", "CAST(NULL AS DOUBLE) AS v", "id + 50000 AS id")
    null = spark.range(300).selectExpr("CAST(NULL AS STRING) AS g", "double(id % 10 + if(id = 7, 900, 0)) AS v", "id + 10000 AS id")
    small = spark.range(12000).selectExpr(
        "concat('g', id % 600) AS g", "double(id % 7 + if(id % 600 = 3 AND id < 600, 800, 0)) AS v", "id + 20000 AS id"
    )
    return hot.unionByName(hollow).unionByName(nulls).unionByName(null).unionByName(small)


def test_groups_of_any_size_match_brute_force(spark):
    df = _grouped(spark)
    got = {r.id: r for r in tag_outliers(df, "v", "g").collect()}
    pdf = df.toPandas().set_index("id")
    groups = pdf.fillna({"g": "null key"}).groupby("g").v
    mean, sigma = groups.transform("mean"), groups.transform(lambda v: v.std(ddof=0))
    odd = ((pdf.v - mean).abs() > 3 * sigma) & (sigma > 0)
    assert len(got) == len(pdf)
    assert {key for key, row in got.items() if row.is_outlier} == set(pdf.index[odd])
    assert odd.sum() == 9
    for key in (0, 40000, 40001, 10007, 20003):
        assert got[key].mu == pytest.approx(mean[key]) and got[key].sigma == pytest.approx(sigma[key])
    assert got[50000].n is None and got[50000].mu is None and not got[50000].is_outlier


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_rows_of_small_groups_are_shuffled(spark, tmp_path):
    _grouped(spark).write.parquet(str(tmp_path / "rows"))
    df, stats = spark.read.parquet(str(tmp_path / "rows")), str(tmp_path / "stats")
    group_stats(df, "v", "g").write.parquet(stats)
    written = spark.read.parquet(stats)
    plan = _plan(attach_stats(df, written, "g"))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SinglePartition" not in plan
    assert plan.count("BroadcastHashJoin") >= 2 and "LeftAnti" in plan
    # The same plan for two groups as for six hundred.
    few = df.where("g IN ('hot', 'hollow')")
    joins = [word for word in ("BroadcastHashJoin", "LeftAnti", "Union") if word in _plan(attach_stats(few, written, "g"))]
    assert joins == ["BroadcastHashJoin", "LeftAnti", "Union"]


def test_outliers_on_events_match_brute_force(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "value")
    got = {r.event_id for r in tag_outliers(events, "value", "event_type").where("is_outlier").collect()}
    pdf = events.toPandas()
    groups = pdf.groupby("event_type").value
    spread = (pdf.value - groups.transform("mean")).abs() > 3 * groups.transform(lambda v: v.std(ddof=0))
    assert got == set(pdf.event_id[spread]) and got


def test_rows_are_read_once_where_no_group_is_small(spark, tmp_path):
    rows = [(k, f"g{k % 2}", float(k % 50)) for k in range(400)]
    spark.createDataFrame(rows, "id bigint, g string, v double").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    group_stats(df, "v", "g").write.parquet(str(tmp_path / "stats"))
    fenced = attach_stats(df, spark.read.parquet(str(tmp_path / "stats")), "g")
    plan = _plan(fenced)
    assert "Union" not in plan and plan.count("/rows]") == 1
    assert sorted(r.id for r in fenced.collect()) == list(range(400)) and fenced.where("mu IS NULL").count() == 0
