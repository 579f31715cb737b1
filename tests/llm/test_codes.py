"""Vector codes against plain Lloyd rounds in whole numbers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest

from rooftally.llm.codes import LEAF, Codebooks, compress, descend, encode, grow, learn, nearest, squared

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [(key, [math.floor(1024 * float(np.float32(x))) for x in v], label) for key, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda row: (row[0] is None, row[0] or 0, row[1]))
    width = len(kept[0][1]) // parts
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def find(book, part):
        return min((sum((x - y) ** 2 for x, y in zip(entry, part)), at) for at, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for row in cut:
                groups[find(books[p], row[p])[1]].append(row[p])
            books[p] = [tuple(sum(x) // len(groups[at]) for x in zip(*groups[at])) if at in groups else entry for at, entry in enumerate(books[p])]
    found = [[find(books[p], row[p]) for p in range(parts)] for row in cut]
    errors = defaultdict(int)
    for (_, _, label), best in zip(kept, found):
        errors[label] += sum(away for away, _ in best)
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted((key or -1, "".join(f"{at:02x}" for _, at in best), sum(away for away, _ in best), errors[label], digest)
                  for (key, _, label), best in zip(kept, found))


def rows_of(df):
    return sorted((r.vec_id or -1, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def vectors(count, seed, dims=16, spread=0.3):
    random_ = np.random.default_rng(seed)
    centres = random_.normal(0, 1, (5, dims))
    return [(k, [float(x) for x in (centres[k % 5] + random_.normal(0, spread, dims)).astype(np.float32)], [None, 1, 2][k % 3]) for k in range(count)]


@pytest.mark.parametrize("entries, block", [(256, 2_048), (7, 40), (16, 3)])
def test_codes_match_plain_rounds(spark, clashing, entries, block):
    rows = vectors(300, entries)
    rows += [(400, None, 1), (401, [None] * 16, 1), (402, [float("nan")] * 16, 2), (403, [float("inf")] + [0.0] * 15, 2), (404, [float("-inf")] * 16, None)]
    rows += [(5, rows[8][1], 1), (5, rows[9][1], 1), (7, rows[7][1], 1), (7, rows[7][1], 1), (None, rows[3][1], 2), (-2, rows[1][1], 2)]
    table = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    assert rows_of(compress(table, entries=entries, block=block)) == plain(rows, entries=entries)


def test_few_rows_and_ties(spark):
    rows = [(k, [float(k % 2)] * 8, None) for k in range(6)]
    got = rows_of(compress(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows) and {row[1] for row in got} == {"00000000", "01010101"}


def test_what_is_left_out(spark):
    assert compress(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = [(1, [], 1), (2, [1.0] * 3, 1), (3, [1.0] * 8, 1), (4, [2.0] * 8, 1), (5, [1.0] * 4, 1), (6, [1e9] * 8, 1)]
    assert [row[0] for row in rows_of(compress(spark.createDataFrame(odd, SCHEMA)))] == [3, 4]
    assert compress(spark.createDataFrame(odd[:2], SCHEMA)).count() == 0


def test_blocks_are_coded_by_given_books(spark):
    rows = vectors(50, 1, dims=8)
    books, blocks = learn(spark.createDataFrame(rows, SCHEMA), entries=4)
    shifted = Codebooks(books.entries + 1)
    got = {r._id: r._error for r in encode(blocks, shifted).collect()}
    for key, vector, _ in rows:
        parts = np.floor(1024 * np.array(vector, np.float64)).astype(np.int64).reshape(4, 2)
        assert got[key] == sum(((shifted.entries[p] - parts[p]) ** 2).sum(axis=1).min() for p in range(4))


def test_trees_prune_and_assign_whole_nodes():
    random_ = np.random.default_rng(5)
    centres = random_.integers(-5_000, 5_000, (16, 4))
    points = np.concatenate([centre + random_.integers(-20, 20, (256, 4)) for centre in centres])
    tree, book = grow(points, LEAF), grow(centres, 1)
    done, node, other = descend(tree, book)
    assert len(done) and not len(node)
    assert min(level for level, _, _ in done) < tree.depth
    codes, sums, counts = nearest(tree, book, centres)
    want = squared(tree.points, centres).argmin(axis=1)
    assert (codes == want).all() and (counts == np.bincount(want, minlength=16)).all()
    assert (sums == np.array([tree.points[want == k].sum(axis=0) for k in range(16)])).all()


def test_large_numbers_stay_exact():
    points = np.array([[(1 << 26) - 1, -(1 << 26) + 1]], np.int64)
    entries = np.array([[-(1 << 26) + 1, (1 << 26) - 1], [0, 1]], np.int64)
    assert squared(points, entries).tolist() == [[sum((int(x) - int(y)) ** 2 for x, y in zip(points[0], entry)) for entry in entries]]
