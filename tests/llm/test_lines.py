"""Line deduplication against a plain count."""

from __future__ import annotations

import random
from collections import Counter

from rooftally.llm.lines import common_lines, drop_common_lines, line_report

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, threshold=10, least=1):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(FOLD)

    split = [(text or "").split("\n") for text in texts]
    held = Counter(k for lines in split for k in {key(line) for line in lines} if len(k) >= least)
    kept = [[line for line in lines if held[key(line)] < threshold] for lines in split]
    return [(len(lines), len(lines) - len(left), "\n".join(left)) for lines, left in zip(split, kept)]


def texts_of():
    random_ = random.Random(3)
    lines = ["", " ", "Footer", "footer ", "\tFOOTER\r", "É", "é", "\xa0footer", "x\x1fy", "rare", *[f"line {k}" for k in range(12)]]
    texts = ["\n".join(random_.choices(lines, k=random_.randrange(1, 14))) for _ in range(60)]
    return [*texts, None, "", "\n", "a\r\nb", "same\nsame\nsame", "Footer", "footer\n", "\nfooter\n\n" * 3, "one", "one"]


def rows_of(df):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in df.collect()}


def test_report_matches_plain_count(documents, clashing):
    texts = texts_of()
    for threshold, least in ((10, 1), (2, 1), (10, 0), (3, 6)):
        got = rows_of(line_report(clashing(documents(*texts)), least_documents=threshold, least_chars=least))
        assert got == dict(enumerate(brute(texts, threshold, least)))


def test_threshold_is_met_by_documents_not_lines(documents):
    table = documents(*["again\nagain"] * 9, "again " * 3, "other")
    assert not common_lines(table).collect()
    assert [r.n_documents for r in common_lines(table.unionAll(table.limit(1)), least_documents=10).collect()] == [10]


def test_rows_that_repeat_and_null_ids(documents):
    rows = [(None, "x\nown")] * 5 + [(1, "x\ny")] * 4 + [(1, "X\nz")] + [(2, "w")]
    got = sorted((r.doc_id or -1, r.n_lines, r.n_dropped, r.kept_text) for r in line_report(documents(*rows)).collect())
    assert got == sorted([(-1, 2, 1, "own")] * 5 + [(1, 2, 1, "y")] * 4 + [(1, 2, 1, "z"), (2, 1, 0, "w")])


def test_dropping_keeps_the_columns(documents, clashing):
    texts = texts_of()
    wide = clashing(documents(*texts))
    got = drop_common_lines(wide)
    assert got.columns == wide.columns
    assert {r["doc_id"]: (r["text"], r["lang"], r["_id"]) for r in got.collect()} == {at: (kept, "en", "x") for at, (_, _, kept) in enumerate(brute(texts))}


def test_empty_and_long(documents):
    assert line_report(documents().limit(0)).count() == 0 and drop_common_lines(documents().limit(0)).count() == 0
    long = "\n".join(["common", *[f"unlike {k}" for k in range(40_000)], "common" * 50_000])
    rows = rows_of(line_report(documents(long, *["Common"] * 9, "\n".join(["common"] * 50_000))))
    assert rows[0][:2] == (40_002, 1) and rows[0][2] == long[7:]
    assert rows[10] == (50_000, 50_000, "") and rows[1] == (1, 1, "")
