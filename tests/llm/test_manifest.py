"""The Merkle manifest against trees built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftally.llm.common import running_before
from rooftally.llm.manifest import FIELDS, build, fold_path, leaf_digest, missing, proofs

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text=False):
    key, own, lang, source, chars = row
    own = own if text is False else text
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (key, source, lang, chars, own)))


def raised(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][at:at + 3])) for at in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, at):
    found = []
    for level in levels[:-1]:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        found.append((run[:at % 3], run[at % 3 + 1:]))
        at //= 3
    return found


def plain(rows):
    sources = sorted({row[3] for row in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((row for row in rows if row[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r))) for s in sources}
    trees = {s: raised([leaf_of(row) for row in own[s]]) for s in sources}
    top = raised([trees[s][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        for at, row in enumerate(own[s]):
            path = siblings(trees[s], at) + siblings(top, number)
            claim = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                claim = leaf_of(row, row[1].replace("\n", ""))
            folded, proof = fold_path(claim, path), "".join("".join(left + right) for left, right in path)
            out.append((row[0] if row[0] is not None else -1, leaf_of(row), trees[s][-1][0], top[-1][0], sha(proof), folded, folded == top[-1][0], proof))
    return sorted(out)


def got_of(df, **how):
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    joined = leaf_digest([F.replace("text", F.lit("\n"), F.lit("")) if name == "text" else F.col(name) for name in FIELDS])
    found = proofs(build(df, claim=F.when(even, joined), **how), whole=True).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.proof) for r in found)


def table(count, sources, seed):
    random_ = random.Random(seed)
    names = [None, "", "É", "z", "Z", *[f"s{k}" for k in range(sources)]]
    # A third of all rows have one source.
    return [(k, random_.choice(["a\nb", "plain", "", None, "x\n"]), random_.choice(["en", None, ""]), "hot" if k % 3 == 0 else random_.choice(names),
             random_.choice([None, 0, 12])) for k in range(count)]


@pytest.mark.parametrize("count, sources, levels, part_rows", [(260, 3, 1, 40), (260, 30, 2, 1000), (200, 0, 7, 50), (1, 0, 7, 50), (3, 1, 1, 1)])
def test_proofs_match_trees_in_memory(spark, clashing, count, sources, levels, part_rows):
    rows = table(count, sources, count)
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    assert got_of(df, stretch_levels=levels, part_rows=part_rows) == plain(rows)


def test_rows_that_repeat_and_null_ids(spark):
    rows = [(None, "x", "en", "a", 1), (None, "y", "en", "a", 1), (4, "same\n", None, None, 2), (4, "same\n", None, None, 2), (4, "other", None, None, 2)] * 3
    assert got_of(spark.createDataFrame(rows, SCHEMA), stretch_levels=1) == plain(rows)


def test_long_text_and_empty_table(spark):
    rows = [(k, "word\n" * 200_000 if k == 2 else "short", "en", "a", None) for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got_of(df) == plain(rows)
    assert proofs(build(df.limit(0))).count() == 0


def test_unclaimed_leaves_verify(spark):
    rows = table(60, 4, 9)
    assert {r.verified for r in proofs(build(spark.createDataFrame(rows, SCHEMA))).collect()} == {True}


def test_missing_nodes_are_the_least_union():
    random_ = np.random.default_rng(2)
    for count in (1, 2, 3, 10, 28, 100):
        held = np.unique(random_.integers(0, count, max(1, count // 4)))
        lacked, known, size, level = set(missing(held, count)), set(held.tolist()), count, 0
        while size > 1:
            got = {index for up, index in lacked if up == level}
            assert not got & known
            runs = {index // 3 for index in known}
            # All runs on the way are whole, and no node is fetched for another run.
            assert got | known == {index for run in runs for index in range(3 * run, min(3 * run + 3, size))}
            known, size, level = runs, -(-size // 3), level + 1
        assert all(up < level for up, _ in lacked)


def test_running_sums(spark):
    df = spark.createDataFrame([(k * 7, k % 5 + 1) for k in range(50)], "at bigint, size bigint")
    got = {r.at: r.before for r in running_before(df, "at", "size", "before", width=16).collect()}
    total = 0
    for k in range(50):
        assert got[k * 7] == total
        total += k % 5 + 1
