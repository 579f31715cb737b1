from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rooftally.operators import copy_counts, dedup_counts, deduplicate, keep_first, later_copies, with_fingerprint


def _fingerprints(df):
    return [r.fingerprint for r in with_fingerprint(df).orderBy("_seq").collect()]


def test_fingerprint_ignores_what_differs_between_sources(listings):
    a, b = _fingerprints(listings(
        {"id": "a", "source": "yad2", "agent_phone": "1", "neighborhood": "x", "floor": 1},
        {"id": "b", "source": "facebook", "agent_phone": "2", "neighborhood": "y", "floor": 9},
    ))
    assert a == b and len(a) == 32 and a == a.lower()


def test_fingerprint_tells_prices_and_cities_apart(listings):
    prints = _fingerprints(listings(
        {"price": 1_000_000.0}, {"price": 2_000_000.0}, {"city": "חיפה"}, {"deal_type": "להשכרה"}, {"rooms": 3.5},
    ))
    assert len(set(prints)) == 5


def test_price_tolerance_is_half_to_even(listings):
    a, b, c = _fingerprints(listings({"price": 1_950_000.0}, {"price": 2_050_000.0}, {"price": 2_050_001.0}))
    assert a == b != c


def test_first_in_order_is_kept(listings):
    df = listings({"id": "first"}, {"id": "second"}, {"id": "other", "city": "חיפה"}, {"id": "third"})
    for shuffled in (df, df.repartition(7), df.orderBy(F.desc("id"))):
        kept = {r.id: r.fingerprint for r in deduplicate(shuffled).collect()}
        assert set(kept) == {"first", "other"}
    marked = with_fingerprint(df)
    assert {r.id for r in later_copies(marked, "fingerprint", "_seq").collect()} == {"second", "third"}
    assert tuple(dedup_counts(marked).first()) == (4, 2, 2)


def test_no_copies(listings):
    df = listings(*[{"id": city, "city": city} for city in ("חיפה", "חולון", "רעננה")])
    assert deduplicate(df).count() == 3
    assert later_copies(with_fingerprint(df), "fingerprint", "_seq").isEmpty()


def test_empty(listings):
    df = listings({}).where("false")
    assert deduplicate(df).isEmpty()
    assert tuple(dedup_counts(with_fingerprint(df)).first()) == (0, 0, 0)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows share one key; the rest have copies here and there."""
    random.seed(3)
    rows = [("hot" if i % 3 == 0 else f"k{random.randint(0, 3000)}", i) for i in range(12_000)]
    random.shuffle(rows)
    return rows, spark.createDataFrame(rows, "key string, place long").repartition(6)


def test_hot_key_against_brute_force(skewed):
    rows, df = skewed
    first = {}
    for key, place in sorted(rows, key=lambda r: r[1]):
        first.setdefault(key, place)
    assert {(r.key, r.place) for r in keep_first(df, "key", "place").collect()} == set(first.items())
    later = {(r.key, r.place) for r in later_copies(df, "key", "place").collect()}
    assert later == {row for row in rows if first[row[0]] != row[1]}
    assert tuple(copy_counts(df, "key").first()) == (len(rows), len(first), len(rows) - len(first))


def test_hot_key_is_cut_down_before_the_shuffle(skewed):
    _, df = skewed
    plan = keep_first(df, "key", "place")._jdf.queryExecution().executedPlan().toString()
    before, after = plan.index("Final"), plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2
    assert before < plan.index("Exchange hashpartitioning(key") < after


def test_copies_are_not_gathered_by_key(skewed):
    """The full rows move by the unique order column, never by the hot key."""
    _, df = skewed
    plan = later_copies(df.withColumn("body", F.lit("x")), "key", "place")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [place" in plan or "HashJoin [place" in plan
    assert "Window [" in plan and "body" not in plan[plan.index("Window ["):]
