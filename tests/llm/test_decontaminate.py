"""Decontamination against a scan of every window in every document."""

from __future__ import annotations

import random
import re

import pytest

from rooftally.llm.decontaminate import contamination, drop_contaminated, matches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(texts, items, window=10):
    result = []
    for text in texts:
        found, hit, named = words(text), set(), set()
        for item, passage in items:
            own = words(passage)
            for at in range(max(0, len(own) - window) + 1 if own else 0):
                part = own[at:at + window]
                for start in range(len(found) - len(part) + 1):
                    if found[start:start + len(part)] == part:
                        hit.update(range(start, start + len(part)))
                        named |= {str(item)} - {"None"}
        result.append((len(found), len(hit), sorted(named)))
    return result


def passage(count, seed, vocabulary=60):
    random_ = random.Random(seed)
    return " ".join(f"w{int(vocabulary ** random_.random())}" for _ in range(count))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, passage(25, 1)), (2, passage(12, 2)), (3, "Three short words"), (4, None), (5, ""), (6, "the the the the"), (None, passage(14, 3)), (2, passage(11, 4)), (10, passage(25, 1))]
    return rows, spark.createDataFrame(rows, "item_id bigint, text string")


def texts_of(rows):
    one, two = rows[0][1], rows[1][1]
    return [
        passage(200, 9), f"{passage(20, 5)} {one.upper()} {passage(20, 6)}", " ".join(one.split()[3:15]), " ".join(two.split()[:9]), two.replace(" ", ", "),
        "three  SHORT... words and three short words", "the the the the the the", rows[6][1], None, "", "...", f"{one} {one}", f"{two} x {rows[7][1]}", "Éthree short words", passage(3000, 7),
    ]


def test_contamination_matches_brute_force(documents, items, clashing):
    rows, table = items
    texts = texts_of(rows)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in contamination(clashing(documents(*texts)), clashing(table)).collect()}
    assert [got[at] for at in range(len(texts))] == brute(texts, rows)
    assert got[1][1] >= 25 and got[3][1] == 0


def test_small_filter_gives_the_same(documents, items):
    rows, table = items
    texts = texts_of(rows)
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in contamination(documents(*texts), table, bits=8).collect()}
    assert [got[at] for at in range(len(texts))] == brute(texts, rows)


def test_repeated_null_and_empty(documents, items, spark):
    rows, table = items
    one = rows[0][1]
    repeated = documents((1, one), (1, one), (1, "clean text"), (None, one), (None, "clean"))
    got = sorted((r.doc_id or -1, r.n_hit, r.contaminated) for r in contamination(repeated, table).collect())
    assert got == [(-1, 0, False), (-1, 25, True), (1, 0, False), (1, 25, True), (1, 25, True)]
    kept = sorted((r.doc_id or -1, r.text) for r in drop_contaminated(repeated, table).collect())
    assert kept == [(-1, "clean"), (1, "clean text")]
    assert contamination(documents().limit(0), table).count() == 0
    assert {r.n_hit for r in contamination(repeated, table.limit(0)).collect()} == {0}


def test_dropping_keeps_clean_documents(documents, items, clashing):
    rows, table = items
    texts = texts_of(rows)
    wide = clashing(documents(*texts))
    kept = drop_contaminated(wide, table)
    assert kept.columns == wide.columns
    assert sorted(r.doc_id for r in kept.collect()) == [at for at, (_, hit, _) in enumerate(brute(texts, rows)) if not hit]


def test_proximity(documents, spark):
    table = spark.createDataFrame([(1, "alpha beta gamma")], "item_id bigint, text string")
    texts = ["alpha beta gamma", "alpha x beta gamma", "alpha x y beta x x x x x x x gamma", "beta alpha", "gamma"]
    got = {(r.doc_id, r.apart) for r in matches(documents(*texts), table, slop=3).collect()}
    assert (0, 0) in got and (1, 1) in got and (2, 2) in got
    assert not {pair for pair in got if pair[0] == 4}


def test_exact_matches_compare_every_word(documents, spark):
    table = spark.createDataFrame([(1, "alpha beta gamma"), (2, "echo echo")], "item_id bigint, text string")
    # The rarest words are alpha and gamma.
    texts = ["alpha x gamma", "alpha beta gamma", "beta beta beta", "echo x echo echo"]
    got = {(r.doc_id, r.phrase, r.start) for r in matches(documents(*texts), table, slop=3).collect() if r.apart == 0}
    assert got == {(1, "alpha beta gamma", 0), (3, "echo echo", 2)}
