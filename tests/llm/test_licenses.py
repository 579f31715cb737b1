"""Licence scan: base phrases against brute force, templates on cases."""

from __future__ import annotations

import re

import pytest

from rooftally.llm.licenses import BASE, TEMPLATES, build_index, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

TEXTS = [
    "Released under the MIT License.", "words, words. Licensed under the Apache License, Version 2.0.\nmore words", "This work is licensed under the GNU General Public License, version 3.",
    "MIT  license mit-license MIT.LICENSE and the general, public license", "license", "mit", "public license", "general public", "apache license general public license", None, "", "...",
    "Licensed under CC BY-NC 4.0.", "All rights reserved.", "rights reserved, all of them", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "permission of a person to copy software", "émit license", "under the terms of the GNU Lesser General Public License", "filler " * 3000 + "mit license " * 50,
]


def base(text):
    found = WORD.findall((text or "").translate(FOLD))
    places, labels = [], set()
    for phrase, label in BASE:
        part = phrase.split()
        for at in range(len(found) - len(part) + 1):
            if found[at:at + len(part)] == part:
                places.append(at)
                labels.add(label)
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(at, text) for at, text in enumerate(TEXTS)], "doc_id bigint, text string")
    for name in ("_id", "_words", "_hits", "_votes", "_base", "labels", "score", "word"):
        df = df.selectExpr("*", f"1 AS `{name}`")
    return {r.doc_id: r for r in scan(df).collect()}


def test_base_matches_brute_force(rows):
    for at, text in enumerate(TEXTS):
        row = rows[at]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == base(text), text
        assert set(row.base_labels.split(",")) <= set(row.labels.split(",")) or not row.base_labels
        assert 0 <= row.score <= 1


def test_templates(rows):
    assert rows[12].labels == "cc-by-nc" and rows[12].score == 1
    assert rows[13].labels == "proprietary" and rows[14].labels == ""
    assert rows[15].labels == "mit" and rows[15].n_base == 0 and rows[16].labels == ""
    assert rows[0].labels == "mit" and rows[0].score == 1 and rows[0].notices[0].start == 0
    assert rows[1].labels == "apache" and rows[1].notices[0].start == 2
    assert set(rows[18].labels.split(",")) == {"gpl", "lgpl"}
    assert rows[9].labels == "" and rows[9].score == 0


def test_index_takes_the_words_in_fewest_documents():
    counts = {"released": 9, "under": 8, "the": 100, "mit": 1, "license": 2}
    [template], [stretch] = build_index(counts, TEMPLATES[:1], rare_words=3)
    assert set(stretch.rare) == {"mit", "license", "under"} and stretch.rare["mit"] == 3
    assert (template.label, template.size, stretch.first) == ("mit", 5, 0)


def test_stretches_cover_whole_templates():
    whole, stretches = build_index({}, TEMPLATES)
    for number, (template, (_, text, key)) in enumerate(zip(whole, TEMPLATES)):
        own = [stretch for stretch in stretches if stretch.template == number]
        assert [word for stretch in own for word in stretch.words] == re.findall("[a-z0-9]+", text.lower())
        assert own[0].first == 0 and all(b.first - a.first == len(a.words) <= 24 for a, b in zip(own, own[1:]))
        assert template.key == re.findall("[a-z0-9]+", key.lower()) and template.size == sum(len(stretch.words) for stretch in own)


def text_of(label):
    return max((text for name, text, _ in TEMPLATES if name == label), key=len)


LONG = [label for label in ("mit", "apache", "gpl", "lgpl", "bsd", "isc", "zlib", "unlicense", "mpl")]


@pytest.fixture(scope="module")
def variants(spark):
    """Scans of each long licence as it is, wrapped anew behind comment marks, with other names, without a clause, and twice."""
    texts = {}
    for label in LONG:
        text = text_of(label)
        found = text.split()
        texts[label, "whole"] = f"Some words first. {text} And some after."
        texts[label, "wrapped"] = "".join(f" * {' '.join(found[k:k + 7])}\r\n" for k in range(0, len(found), 7))
        texts[label, "twice"] = f"{text}\n\n{text}"
        texts[label, "alone"] = " ".join(re.findall(r"[a-z]+", text.lower())[::-1])
    bsd, mit = text_of("bsd"), text_of("mit")
    texts["bsd", "names"] = bsd.replace("the copyright holder nor", "Lantern Harbour Instruments of Westmarch Limited nor").replace(
        "BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "BY LANTERN HARBOUR INSTRUMENTS OF WESTMARCH LIMITED")
    texts["bsd", "dropped"] = bsd[:bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE IS PROVIDED"):]
    texts["mit", "dropped"] = mit.replace("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "")
    texts["mit", "late"] = " ".join(mit.split()[5:])
    texts["mit", "without the key"] = mit.replace("obtaining", "getting")
    texts["mit", "long"] = "zo ba " * 200_000 + mit + " zo ba" * 200_000
    df = spark.createDataFrame([(f"{label}/{form}", text) for (label, form), text in texts.items()], "doc_id string, text string")
    return {tuple(row.doc_id.split("/")): row for row in scan(df).collect()}


@pytest.mark.parametrize("label", LONG)
def test_whole_licences(variants, label):
    notices = {form: [n for n in variants[label, form].notices if n.label == label] for form in ("whole", "wrapped", "twice", "alone")}
    size = len(re.findall("[a-z0-9]+", text_of(label).lower()))
    for form in ("whole", "wrapped"):
        first = 3 if form == "whole" else 0
        assert (first, first + size, 1.0) in [(n.start, n.stop, n.share) for n in notices[form]]
        assert variants[label, form].score == 1
    assert {(0, 1.0), (size, 1.0)} <= {(n.start, n.share) for n in notices["twice"]}
    assert not notices["alone"]


def longest(row, label):
    return max((n for n in row.notices if n.label == label), key=lambda n: n.stop - n.start)


def test_changed_names_and_dropped_clauses(variants):
    for at, share in ((("bsd", "names"), 0.8), (("bsd", "dropped"), 0.75), (("mit", "dropped"), 0.85), (("mit", "late"), 0.9), (("mit", "long"), 1)):
        assert longest(variants[at], at[0]).share >= share, at
    # The whole text is one notice, from its first aligned stretch to its last.
    one = longest(variants["bsd", "dropped"], "bsd")
    assert one.start == 0 and one.stop == variants["bsd", "dropped"].n_words
    assert longest(variants["mit", "long"], "mit").start == 400_000
    assert "mit" not in variants["mit", "without the key"].labels.split(",")


def test_many_notices_in_one_text(spark):
    text = "Released under the MIT License. " * 20_000
    row = scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row.n_base, row.labels, len(row.notices)) == (20_000, "mit", 20_000)


def test_empty(spark):
    assert scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
