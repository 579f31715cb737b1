"""Quality and toxicity: training, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rooftally.llm import quality, toxicity
from rooftally.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("name, label, parts, part, least", [("op6_quality", "quality", 3, 1, 0.95), ("op7_toxicity", "toxic", 4, 2, 0.9)])
def test_held_out_accuracy(spark, labels, name, label, parts, part, least):
    rows = QUERIES[name](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = []
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % parts == part)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= (0.5 if parts == 3 else 0.3))
        if row.held_out and row.doc_id in labels:
            right.append(row.predicted == labels[row.doc_id][label])
    assert np.mean(right) >= least


def test_forest_separates_and_walks_as_told():
    random_ = np.random.default_rng(0)
    rows = random_.normal(size=(2000, len(quality.STATISTICS))).astype(np.float32)
    answer = ((rows[:, 3] > 0.4) & (rows[:, 7] < 0.9)).astype(int)
    forest = quality.fit(rows[:1500], answer[:1500])
    assert np.mean((forest.margins(rows[1500:]) > 0) == answer[1500:]) > 0.97
    for row in rows[:20]:
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < forest.feature.shape[1]:
                node = 2 * node + (2 if row[feature[node]] > threshold[node] else 1)
            total += leaf[node - forest.feature.shape[1]]
        assert abs(total - forest.margins(row[None])[0]) < 1e-9


@pytest.mark.parametrize("labels_", [[], [1, 1, 1], [0, 0]])
def test_forest_without_both_labels(labels_):
    forest = quality.fit(np.zeros((len(labels_), len(quality.STATISTICS))), np.array(labels_))
    margin = forest.margins(np.zeros((1, len(quality.STATISTICS))))[0]
    assert margin == 0 if not labels_ else (margin > 0) == bool(labels_[0])


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "é", "|" * 50, "\x00\x01", "word " * 50_000])
def test_statistics_of_any_text(text):
    values = quality.statistics(text)
    assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


def toxic_rows(count=400, seed=5):
    random_ = np.random.default_rng(seed)
    rows = []
    for at in range(count):
        sentences = [" ".join(f"w{random_.integers(300)}" for _ in range(8)) + "." for _ in range(random_.integers(1, 30))]
        label = int(at % 4 == 0)
        if label:
            sentences.insert(int(random_.integers(len(sentences) + 1)), "you utter blockhead of grottiness.")
        rows.append((" ".join(sentences), label, 1.0))
    return pd.DataFrame(rows, columns=["text", "label", "weight"])


def test_instances_are_found_from_document_labels(spark, documents):
    model = toxicity.fit(toxic_rows())
    scorer = model.scorer()
    test = toxic_rows(seed=6)
    assert np.mean([(scorer.document(text) >= 0.3) == bool(label) for text, label in zip(test["text"], test["label"])]) > 0.97
    text = test["text"][0]
    found = [text[start:stop] for _, start, stop, score in scorer.sentences(text) if score >= 0.3]
    assert len(found) == 1 and "blockhead" in found[0]
    rows = model.offending(documents(text, "all is well.", None, "")).collect()
    assert [(r.doc_id, text[r.start:r.stop].strip()) for r in rows] == [(0, found[0].strip())]


def test_noisy_or_of_sentences():
    model = toxicity.ToxicityModel(np.zeros(toxicity.DIMENSION, np.float32), -2.0)
    one = 1 / (1 + np.exp(2.0))
    assert model.scorer().document("a b. c d.") == pytest.approx(1 - (1 - one) ** 2)
    assert model.scorer().document("") == model.scorer().document(None) == 0


def test_one_label_or_none():
    rows = toxic_rows(20)
    for part in (rows[rows["label"] == 0], rows[:0]):
        assert toxicity.fit(part.reset_index(drop=True)).scorer().document("you utter blockhead. " * 50) < 0.3


def test_dropping_toxic_documents(documents, clashing):
    wide = clashing(documents("fine words.", "you utter blockhead of grottiness.", None, "", "word " * 30_000))
    kept = toxicity.drop_toxic(wide, toxicity.fit(toxic_rows()))
    assert kept.columns == wide.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3, 4]
    assert toxicity.drop_toxic(wide.limit(0), toxicity.fit(toxic_rows())).count() == 0


def test_learning_ignores_forbidden_null_and_repeated_labels(spark, documents):
    rows = toxic_rows(80)
    table = documents(*rows["text"])
    labels = spark.createDataFrame(
        [(at, int(label)) for at, label in enumerate(rows["label"])] + [(None, 1), (3, None), (0, 1), (999, 1)], "doc_id bigint, toxic int",
    )
    sample = toxicity.labelled_sample(table, labels, "toxic", ~toxicity.is_held_out(F.col("_id"), 4, 2), 1000)
    assert len(sample) == sum(zlib.crc32(str(at).encode()) % 4 != 2 for at in range(80))
    assert toxicity.learn(table, labels.limit(0)).scorer().document("words. " * 9) < 0.3


def test_held_out_of_null(spark):
    row = spark.range(1).select(toxicity.is_held_out(F.lit(None).cast("bigint"), 4, 2).alias("x")).first()
    assert row.x is False


def test_length_alone_is_no_evidence():
    rows = toxic_rows()
    # Noisy labels: one in ten of the clean documents is called toxic.
    rows.loc[rows.index[rows["label"] == 0][::10], "label"] = 1
    scorer = toxicity.fit(rows).scorer()
    clean = "w1 w2 w3. the day is mild.\n\n" * 100_000
    assert scorer.document(clean) < 0.01
    assert scorer.document(clean + "you utter blockhead of grottiness.") >= 0.3
    assert toxicity.ToxicityModel(np.zeros(toxicity.DIMENSION, np.float32), -2.0).scorer().document("\n" * 1000) == 0


@pytest.mark.parametrize("gap", ["\t", "\r\n", "\r", "\v", "\f"])
def test_all_white_space_parts_words(gap):
    assert toxicity.tokens(f"One{gap}two.{gap}three") == toxicity.tokens("one two. three" if "\n" not in gap else "one\ntwo.\nthree")
    scorer = toxicity.fit(toxic_rows()).scorer()
    spread = f"w1{gap}w2.{gap}w3 you{gap}utter blockhead of{gap}grottiness.{gap}w4"
    assert toxicity.ends_sentence(toxicity.tokens(f"word.{gap}w3")[0])
    if "\n" not in gap:
        assert scorer.document(spread) == scorer.document(spread.replace(gap, " ")) >= 0.3
    else:
        assert scorer.document(spread) == scorer.document(spread.replace(gap, "\n"))


def rare_abuse(count, seed):
    """Toxic documents have one of a hundred words each, so each word is in one of a hundred of them."""
    random_ = np.random.default_rng(seed)
    rows = []
    for at in range(count):
        sentences = [" ".join(f"{random_.integers(900)}w" for _ in range(6)) + "." for _ in range(random_.integers(1, 6))]
        if at % 2:
            sentences.insert(int(random_.integers(len(sentences) + 1)), f"you {chr(97 + at // 2 % 10) * 3}{chr(97 + at // 20 % 10) * 3}ish thing.")
        rows.append((" ".join(sentences), at % 2, 1.0))
    return pd.DataFrame(rows, columns=["text", "label", "weight"])


def test_words_of_one_in_a_hundred_toxic_documents_are_evidence():
    scorer = toxicity.fit(rare_abuse(6_000, 1)).scorer()
    test = rare_abuse(1_000, 2)
    caught = np.array([scorer.document(text) >= toxicity.REJECT_AT for text in test["text"]])
    labels = test["label"].to_numpy() == 1
    assert caught[labels].mean() > 0.95 and caught[~labels].mean() < 0.02


def test_copies_count_once_as_evidence():
    rows = toxic_rows()
    mild = "the orchard keeper mended seven wicker baskets before breakfast near the mill"
    copies = pd.DataFrame([(f"{mild} number{k}.", 1, 1.0) for k in range(300)], columns=rows.columns)
    scorer = toxicity.fit(pd.concat([rows, copies], ignore_index=True)).scorer()
    assert scorer.document("seven wicker baskets near the mill.") < toxicity.REJECT_AT
    assert scorer.document("you utter blockhead of grottiness.") >= toxicity.REJECT_AT


def test_noisy_or_by_hand():
    """Scores of fixed weights against the formula, sentence by sentence."""
    random_ = np.random.default_rng(3)
    weights, telling = random_.normal(0, 1, toxicity.DIMENSION).astype(np.float32), random_.random(toxicity.DIMENSION) < 0.4
    model = toxicity.ToxicityModel(weights, -1.5, telling)
    for text in ("a b. c", "One two!\nthree four? five", "x", "", None, "word " * 30 + ". other words.\n\nlast"):
        clean, sentence = 1.0, []
        for word in [*toxicity.tokens(text), None]:
            if word is not None:
                sentence.append(word)
            if sentence and (word is None or toxicity.ends_sentence(word)):
                found = [feature for own in sentence for feature in toxicity.features(own) if any(telling[f] for f in toxicity.features(own))]
                if found:
                    clean *= 1 - 1 / (1 + np.exp(1.5 - sum(float(weights[f]) for f in found)))
                sentence = []
        assert model.scorer().document(text) == pytest.approx(1 - clean, abs=1e-9)


def test_statistics_of_odd_rows(documents, clashing):
    rows = [(1, None), (1, ""), (2, "a few plain words."), (2, "other words, same id"), (3, "word " * 400_000), (3, "word " * 400_000)]
    plain = sorted((r._id, list(r._values)) for r in quality.measured(documents(*rows)).collect())
    assert sorted((r._id, list(r._values)) for r in quality.measured(clashing(documents(*rows))).collect()) == plain
    assert len(plain) == len(rows) and plain[0] == plain[1] and plain[2] != plain[3] and plain[4] == plain[5]
    assert quality.measured(documents(*rows).where("false")).count() == 0
