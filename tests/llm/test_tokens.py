"""Token ids, Huffman codes, token files and packing."""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rooftally.llm.huffman import Code, code_lengths, decode
from rooftally.llm.packing import combinations, pack, plan_packing, repeat_counts
from rooftally.llm.token_files import round_trip, write_files
from rooftally.llm.tokenize import PieceEncoder, batches_of, encoder, tokenizer_path

ODD = [
    None, "", " ", "  a b", " a", " a  b\n c ", "a \n b", "x  y", "it's don't, a.b, c..", "<|endoftext|> a", "\n\n a", "a\t b", "a\u0085 b", "a\x1c b", "foo, bar.", "é, ñ.", "١, ²,",
    "日本, 語.", "a  ", "-, _,", "word " * 4000, "no.spaces" * 500, "😀 😀, x", "Same text", "Same text",
]


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def lists_of(own, texts):
    ids, bounds = own.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t.,'ab1é  _|"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_pieces_give_the_ids_of_whole_texts(texts):
    own = encoder(tokenizer_path())
    for text, ids in zip(texts, lists_of(own, texts)):
        assert ids == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_full_memory_gives_the_same(whole):
    texts = [text or "" for text in ODD]
    own = PieceEncoder(tokenizer_path(), remembered=3)
    for _ in range(2):
        for ids, text in zip(lists_of(own, texts), texts):
            assert ids == whole(text)[:-1].tolist()


def test_other_tokenizers_encode_whole_texts():
    own = PieceEncoder(tokenizer_path("word_bpe_49k.json"))
    assert lists_of(own, ["Some words, here"]) == [own.tokenizer.encode("Some words, here", add_special_tokens=False).ids]


def test_ends_and_batches(whole):
    texts = pa.array(ODD, pa.string())
    ids, bounds = encoder(tokenizer_path()).encode(texts, 0)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [whole(text).tolist() for text in ODD]
    parts = list(batches_of(texts, 100))
    assert [start for start, _ in parts] == np.cumsum([0, *(length for _, length in parts)])[:-1].tolist() and len(parts) > 3
    assert sum(length for _, length in parts) == len(ODD) and not list(batches_of(texts[:0]))


def plain_huffman_cost(counts):
    heap = sorted(int(count) for count in counts if count)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


@pytest.mark.parametrize("size, most", [(1, 20), (2, 20), (3, 2), (50, 20), (50, 6), (1000, 12), (5000, 20)])
def test_codes(size, most):
    random_ = np.random.default_rng(size)
    ids = np.minimum(random_.pareto(0.5, 30_000).astype(np.int64), size - 1)
    counts = np.bincount(ids, minlength=size)
    lengths = code_lengths(counts, most)
    used = counts > 0
    assert lengths.max() <= most and (lengths[used] > 0).all() and not lengths[~used].any()
    assert (2.0 ** -lengths[used].astype(float)).sum() <= 1
    if used.sum() > 1 and lengths.max() < most:
        assert (lengths * counts).sum() == plain_huffman_cost(counts)
    code = Code(lengths)
    for part in (ids, ids[:1], ids[:128], ids[:129], ids[:0]):
        bits, checkpoints = code.encode(part)
        assert (decode(bits, checkpoints, len(part), code.table(), code.depth) == part).all()


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        code_lengths(np.ones(9), 3)
    with pytest.raises(ValueError):
        Code(np.array([1, 1, 1]))


def test_token_files_round_trip(documents, whole, clashing):
    keys = [7 * at % 97 for at in range(len(ODD))]
    rows = sorted(round_trip(clashing(documents(*zip(keys, ODD)))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(keys)
    texts, before = dict(zip(keys, ODD)), 0
    for row in rows:
        ids = whole(texts[row.doc_id])
        assert (row.start, row.n_tokens, row.ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)


def test_token_files_of_repeated_null_and_no_ids(documents):
    rows = sorted(round_trip(documents((2, "b"), (None, "n"), (2, "b"), (2, "a"), (1, ""))).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 2]
    assert round_trip(documents().limit(0)).count() == 0


def test_files_close_and_name_their_documents(documents, spark, tmp_path, monkeypatch):
    import rooftally.llm.token_files as token_files
    table = documents(*(f"text number {at} " * 20 for at in range(50)))
    files = write_files(table, f"file://{tmp_path}")
    assert sum(r.documents for r in files.manifest.collect()) == 50
    # A reader of another process has nothing but the files.
    assert token_files.read_files(spark, files).count() == 50


def test_number_of_parts_changes_nothing(documents, spark, tmp_path):
    table = documents(*(f"text {at} " * (at % 40) for at in range(90)))
    few, many = (sorted(map(tuple, round_trip(table, file_ids=size).collect())) for size in (1 << 20, 40))
    assert few == many
    assert write_files(table, f"file://{tmp_path}", file_ids=40).manifest.count() > 20


def check_pieces(rows, texts, whole, window):
    pieces, sequences = {}, {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
        sequences.setdefault(row.sequence_id, []).append(row)
    for key, text in texts.items():
        ids, at = whole(text), 0
        for row in sorted(pieces[key], key=lambda r: r.start):
            part = ids[row.start:row.start + row.length]
            assert (row.start, row.doc_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes())) and len(part) == row.length > 0
            at += row.length
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    short = 0
    for rows_ in sequences.values():
        at = 0
        for row in sorted(rows_, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= window
        short += at < window
        assert all(row.padded_length == (at if at & (at - 1) == 0 else window) for row in rows_)
    assert short <= 1


@pytest.mark.parametrize("window", [1024, 48, 7])
def test_packing(documents, whole, clashing, window):
    random_ = np.random.default_rng(window)
    texts = [" ".join(f"w{random_.integers(1000)}" for _ in range(random_.integers(0, 400))) for _ in range(120)] + ODD
    check_pieces(pack(clashing(documents(*texts)), window=window).collect(), dict(enumerate(texts)), whole, window)


def test_packing_of_one_length_and_of_none(documents, whole):
    check_pieces(pack(documents(*["same words here"] * 70), window=16).collect(), {at: "same words here" for at in range(70)}, whole, 16)
    assert pack(documents().limit(0)).count() == 0
    assert sum(r.length for r in pack(documents((1, "a b"), (1, "a b"), (None, None)), window=16).collect()) == 7


def test_combinations_fill_the_window():
    for window in (4, 7, 1024):
        found = combinations(window)
        assert (found.sum(axis=1) == window).all() and (found[:, 0] < window).all()


@pytest.mark.parametrize("seed", range(4))
def test_repeat_counts_use_no_more_than_there_is(seed):
    random_ = np.random.default_rng(seed)
    histogram = random_.integers(0, 50, 256) * random_.integers(0, 2, 256)
    histogram[0] = 9
    found = combinations(256)
    counts = repeat_counts(histogram, found)
    used = np.bincount(found.ravel(), np.repeat(counts, 3), 256)
    assert (counts >= 0).all() and (used[1:] <= histogram[1:]).all()
    exact = np.zeros(256, dtype=np.int64)
    exact[100] = exact[156] = 1000
    assert repeat_counts(exact, found).sum() == 1000


def test_plan_gives_each_rank_one_slot():
    random_ = np.random.default_rng(8)
    plan = plan_packing(random_.integers(0, 40, 128), 128)
    for length in range(1, 128):
        mine = np.flatnonzero(plan.length == length)
        assert (np.diff(plan.first[mine]) > 0).all() and (not len(mine) or plan.first[mine[0]] == 0)


def test_added_tokens_are_encoded_as_the_library_does(documents):
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "a<|endoftext|>b  c", "<|endoftext|>", "<|endoftext|> a", "x <|endoftext| > y", "a b. <|endoftext|>, c d"]
    want = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert lists_of(PieceEncoder(tokenizer_path()), ["a b c, x", *texts])[1:] == want
    rows = {row.doc_id: row for row in round_trip(documents(*texts)).collect()}
    assert [rows[at].ids_crc32 for at in range(len(texts))] == [zlib.crc32(np.array([*ids, 0], "<u4").tobytes()) for ids in want]
