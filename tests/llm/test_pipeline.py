"""The corpus run on a small table with planted cases, stage by stage."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from rooftally.llm.common import staged

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage keeps."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        found.append(docs)
    return found


def folded(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def test_stages_keep_the_columns_and_only_drop(stages):
    for before, after in zip(stages[:-2], stages[1:-1]):
        assert after.columns == before.columns
        assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "packing"]


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].collect()}
    clean = [key for key, toxic in labels.items() if not toxic]
    assert sum(key in kept for key in clean) / len(clean) > 0.98
    words = re.compile(r"\b(idiot|scum|moron|stupid|clown|worthless)\b", re.I)
    bad = [r.doc_id for r in stages[0].collect() if len(words.findall(r.text or "")) > 2]
    assert bad and sum(key in kept for key in bad) / len(bad) < 0.1


def test_exact_copies_leave_one(stages):
    rows = stages[1].collect()
    last = {}
    for row in rows:
        last[folded(row.text)] = max(row.doc_id, last.get(folded(row.text), -1))
    assert {r.doc_id for r in stages[2].collect()} == set(last.values())


def test_near_copies_leave_one(stages):
    from rooftally.llm.simhash import fingerprint
    rows = [(r.doc_id, fingerprint(r.text)) for r in stages[2].collect()]
    label = {key: key for key, _ in rows}
    changed = True
    while changed:
        changed = False
        for at, (a, x) in enumerate(rows):
            for b, y in rows[at + 1:]:
                if (x ^ y).bit_count() <= 3 and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    assert {r.doc_id for r in stages[3].collect()} == set(label.values())


def test_benchmark_passages_go(spark, stages):
    from test_decontaminate import brute
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = stages[3].collect()
    clean = {row.doc_id for row, (_, hit, _) in zip(rows, brute([r.text for r in rows], items)) if not hit}
    assert {r.doc_id for r in stages[4].collect()} == clean and len(clean) < len(rows)


def test_packing_covers_what_is_left(stages):
    left = {r.doc_id for r in stages[4].collect()}
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == left
    total = {}
    for row in pieces:
        total[row.doc_id] = total.get(row.doc_id, 0) + row.length
    assert all(total[row.doc_id] == row.doc_tokens for row in pieces)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == stages[5].columns and got.count() == stages[5].count()
