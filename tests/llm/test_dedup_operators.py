"""Exact and SimHash deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import xxhash

from rooftally.llm.components import connected
from rooftally.llm.exact_dedup import copy_groups, drop_copies
from rooftally.llm.simhash import (
    build_tree, drop_near_copies, fingerprint, forest, graft, near_edges, near_groups, near_links, part_masks, route, sparse_links,
)

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(text):
    return (text or "").translate(FOLD)


def expected_groups(rows):
    result = {}
    for key, text in rows:
        same = [k for k, t in rows if folded(t) == folded(text)]
        known = [k for k in same if k is not None]
        result.setdefault(key, set()).add((max(known) if known else None, len(same)))
    return result


ROWS = [
    (1, "Same text"), (2, "same TEXT"), (3, "same text "), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "ab"), (9, "ba"),
    (10, "x" * 300 + "a"), (11, "x" * 300 + "b"), (12, "x" * 300 + "A"), (13, "same text"),
]


def test_copy_groups_match_brute_force(documents):
    expected = expected_groups(ROWS)
    rows = copy_groups(documents(*ROWS), digest_all=True).collect()
    assert len(rows) == len(ROWS)
    texts = dict(ROWS)
    for row in rows:
        assert expected[row.doc_id] == {(row.keep_id, row.group_size)}
        assert row.kept == (row.keep_id == row.doc_id)
        assert row.digest == hashlib.sha256(folded(texts[row.doc_id]).encode()).hexdigest()


def test_refinement_hashes_only_what_collides(documents):
    rows = {row.doc_id: row for row in copy_groups(documents(*ROWS)).collect()}
    assert rows[8].digest is None and rows[8].kept and rows[8].group_size == 1
    assert rows[1].digest == rows[2].digest is not None


def test_full_filter_changes_nothing(documents):
    few = {(r.doc_id, r.keep_id, r.group_size) for r in copy_groups(documents(*ROWS), filter_bits=2).collect()}
    assert few == {(r.doc_id, r.keep_id, r.group_size) for r in copy_groups(documents(*ROWS)).collect()}


def test_ids_null_and_repeated(documents, clashing):
    rows = [(None, "a"), (None, "a"), (3, "a"), (3, "a"), (5, "b"), (5, "b"), (None, "c"), (7, "d"), (7, "e")]
    got = [(r.doc_id is None, r.doc_id, r.keep_id, r.group_size, r.kept) for r in copy_groups(documents(*rows)).collect()]
    assert [row[1:] for row in got if row[1] == 3] == [(3, 3, 4, True)] * 2
    assert (True, None, 3, 4, False) in got and (True, None, None, 1, True) in got
    wide = clashing(documents(*rows))
    kept = drop_copies(wide)
    assert kept.columns == wide.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "c"), (3, "a"), (5, "b"), (7, "d"), (7, "e")]


def test_exact_empty_and_long(spark, documents):
    assert copy_groups(documents().limit(0)).count() == 0
    assert drop_copies(documents().limit(0)).count() == 0
    long = "word " * 60_000
    assert {r.doc_id for r in drop_copies(documents((1, long), (2, long.upper()), (3, long + "x"))).collect()} == {2, 3}


def plain_fingerprint(text):
    found = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in folded(text)).split(" ") if w]
    if not found:
        return 0
    parts = [" ".join(found[k:k + 3]) for k in range(len(found) - 2)] if len(found) >= 3 else [" ".join(found)]
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one two", "One two\tTHREE", "a b c a b c a b c", "É é \xa0x y z", "w " * 500])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def components(prints, radius=3):
    label = list(range(len(prints)))

    def find(at):
        while label[at] != at:
            at = label[at]
        return at

    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(prints[a + 1:] ^ prints[a]) <= radius) + a + 1:
            label[max(find(a), find(int(b)))] = min(find(a), find(int(b)))
    return [find(at) for at in range(len(prints))]


def clustered(count, seed, centres=6):
    random_ = np.random.default_rng(seed)
    points = random_.integers(0, 1 << 63, count, dtype=np.uint64)
    middle = random_.integers(0, 1 << 63, centres, dtype=np.uint64)
    for at in range(count // 2):
        value = middle[at % centres]
        for bit in random_.integers(0, 64, random_.integers(0, 5)):
            value ^= np.uint64(1) << np.uint64(bit)
        points[at] = value
    return np.unique(points)


def test_shards_hold_every_near_pair():
    points = clustered(600, 1)
    tree = build_tree(points, 16, 3)
    at, shard, home = route(tree, points, 3)
    assert sorted(at[home]) == list(range(len(points)))
    homes = dict(zip(at[home], shard[home]))
    visits = {(int(a), int(s)) for a, s in zip(at, shard)}
    for a in range(len(points)):
        for b in np.flatnonzero(np.bitwise_count(points ^ points[a]) <= 3):
            assert (a, int(homes[b])) in visits or (int(b), int(homes[a])) in visits


def test_links_keep_components():
    points = clustered(1500, 2, centres=2)
    a, b = near_links(points, points, 3)
    nodes, roots = forest(a, b)
    root = dict(zip(nodes.tolist(), roots.tolist()))
    got = [root.get(p, p) for p in points.tolist()]
    want = components(points)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_dense_links_are_thinned():
    x, y = sparse_links(np.ones((300, 400), dtype=bool))
    assert len(x) <= 1400 and len(set(x)) == 300 and len(set(y)) == 400


@pytest.mark.parametrize("trees, radius", [(1, 3), (2, 3), (3, 3), (4, 3), (2, 2)])
def test_trees_over_parts_hold_every_near_pair(trees, radius):
    points = clustered(500, 4)
    met = set()
    for mask in part_masks(trees):
        part = points & mask
        tree = build_tree(part, 12, radius // trees)
        at, shard, home = route(tree, part, radius // trees)
        homes, visits = dict(zip(at[home].tolist(), shard[home].tolist())), set(zip(at.tolist(), shard.tolist()))
        assert sorted(homes) == list(range(len(points)))
        for a in range(len(points)):
            for b in np.flatnonzero(np.bitwise_count(points ^ points[a]) <= radius).tolist():
                if (a, homes[b]) in visits or (b, homes[a]) in visits:
                    met.add((a, b))
    assert met == {(a, b) for a in range(len(points)) for b in np.flatnonzero(np.bitwise_count(points ^ points[a]) <= radius).tolist()}


def test_grafted_trees_route_like_whole_ones():
    points = clustered(900, 6)
    tree = build_tree(points[:100], 8, 3)
    at, shard, home = route(tree, points, 0)
    assert home.all()
    own = {int(leaf): build_tree(points[at[shard == leaf]], 4, 3) for leaf in np.unique(shard)[::2]}
    whole = graft(tree, own)
    assert whole.shards == tree.shards + sum(part.shards - 1 for part in own.values())
    _, finer, _ = route(whole, points, 0)
    assert set(finer.tolist()) <= set(range(whole.shards)) and len(set(finer.tolist())) > tree.shards
    at, shard, home = route(whole, points, 3)
    homes, visits = dict(zip(at[home].tolist(), shard[home].tolist())), set(zip(at.tolist(), shard.tolist()))
    assert sorted(homes) == list(range(len(points)))
    for a in range(len(points)):
        for b in np.flatnonzero(np.bitwise_count(points ^ points[a]) <= 3).tolist():
            assert (a, homes[b]) in visits or (b, homes[a]) in visits


def test_visits_stay_few():
    points = np.random.default_rng(1).integers(0, 1 << 63, 40_000, dtype=np.uint64)
    visits = 0
    for mask in part_masks(2):
        tree = build_tree(points[:16_384] & mask, 1_024, 1)
        visits += len(route(tree, points & mask, 1)[0]) / len(points)
    assert tree.shards > 900 and visits < 14


@pytest.mark.parametrize("shard, block, sample", [(40, 65_536, 16_384), (40, 15, 16_384), (10_000, 65_536, 16_384), (8, 65_536, 64)])
def test_edges_of_shards_and_blocks(spark, shard, block, sample):
    points = clustered(400, 3)
    prints = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "_print bigint")
    edges = near_edges(prints, 3, shard=shard, block=block, sample=sample, leaf_sample=20)
    root = {r.node: r.root for r in connected(edges).collect()}
    got = [root.get(int(p), int(p)) for p in points.view(np.int64)]
    want = components(points)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}, 201: 200}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_groups_match_brute_force(documents, clashing):
    random_ = random.Random(4)
    base = [" ".join(f"w{random_.randrange(400)}" for _ in range(300)) for _ in range(6)]
    texts = []
    for text in base:
        for _ in range(5):
            found = text.split()
            found[random_.randrange(300)] = "other"
            texts.append(" ".join(found))
    texts += [None, "", " ", "short", "Short", texts[0].upper()]
    table = documents(*texts)
    rows = {r.doc_id: r for r in near_groups(clashing(table)).collect()}
    prints = np.array([plain_fingerprint(text) for text in texts], dtype=np.uint64)
    want = components(prints)
    assert {k: r.component_id for k, r in rows.items()} == dict(enumerate(want))
    assert all(r.fingerprint == f"{prints[k]:016x}" for k, r in rows.items())
    kept = drop_near_copies(clashing(table))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want)) and kept.columns == clashing(table).columns


def test_near_nulls_repeats_and_empty(documents):
    rows = [(None, "a b c"), (4, "a b c"), (4, "a b c"), (2, "A b c"), (None, "zz yy xx")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in near_groups(documents(*rows)).collect())
    assert got == [(-1, -1), (-1, 2), (2, 2), (4, 2), (4, 2)]
    assert near_groups(documents().limit(0)).count() == 0
    assert sorted(r.doc_id or -1 for r in drop_near_copies(documents((3, "a b c"), (3, "a b c"), (9, "A b c"))).collect()) == [3]


def test_rows_of_one_id_are_judged_by_their_own_text(documents):
    rows = [(5, "alpha beta gamma"), (5, "delta epsilon zeta"), (9, "Alpha beta gamma"), (9, "Alpha beta gamma")]
    kept = sorted((r.doc_id, r.text) for r in drop_copies(documents(*rows)).collect())
    assert kept == [(5, "delta epsilon zeta"), (9, "Alpha beta gamma")]
    rows = [(5, "alpha beta gamma"), (5, "delta epsilon zeta"), (3, "Alpha beta gamma")]
    kept = sorted((r.doc_id, r.text) for r in drop_near_copies(documents(*rows)).collect())
    assert kept == [(3, "Alpha beta gamma"), (5, "delta epsilon zeta")]
