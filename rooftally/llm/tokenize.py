"""Token ids of whole texts by a tokenizer file, each distinct piece of text encoded once per worker.

Byte-level BPE splits a text before merging, and white space before something else always begins a new
part, as does white space after something else. So a text may be cut there, and the ids of the pieces joined
are the ids of the text. A batch of texts becomes one flat list of pieces, of which only the distinct ones
are looked up; ids are gathered by number. Workers remember pieces, and encode those they meet for the
first time together.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
REMEMBERED = 400_000    # pieces that a worker remembers, a batch more at most; others are encoded again when met
BATCH_BYTES = 1 << 23   # of text that is made pieces at a time; a longer text is a batch of its own
_GROUP = 4_096
# Before the first piece of a text, before a piece that follows a line feed (others follow a space), and before one in plain text.
_FIRST, _LINE, _PLAIN = "\x01", "\x00", "\x02"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def batches_of(texts: pa.Array, most_bytes: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """(start, length) of stretches of ``texts`` of about ``most_bytes`` each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield start, stop - start
        start = stop


class PieceEncoder:
    """Encodes texts to ids as the library does without adding special tokens.

    A text that contains an added token of the file is encoded whole, since the library takes it out first.

    Cutting at white space holds for byte-level BPE that adds no prefix space; for any other tokenizer
    file the whole texts are encoded.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.remembered = remembered
        # Ids whose token begins with a space or a line feed, by which pieces encoded together come apart again.
        self.begins = np.zeros(self.vocabulary, dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.begins[number] = token[:1] in ("Ġ", "Ċ")
        rules = str(self.tokenizer.pre_tokenizer)
        self.cuts = "ByteLevel(add_prefix_space=False" in rules and "use_regex=True" in rules and self.tokenizer.normalizer is None
        # Numbers of pieces; those that do not begin with a cut have theirs as -2 less the number.
        self.known: dict[str, int] = {}
        # Ids of all pieces, one after another; the empty piece is the first.
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts, self.sizes, self.blank_end = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, bool)
        self.used, self.pieces = 0, 1
        self.kept = self.used, self.pieces

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each followed by ``end`` if that is given, and where each begins (with the end of the last). Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        alone = self._alone(texts)
        whole = {at: self._whole(texts[at].as_py()) for at in np.flatnonzero(alone).tolist()}
        ids, bounds = self._flat(pc.if_else(pa.array(~alone), texts, ""))
        if whole:
            sizes = np.diff(bounds)
            parts = [whole[at] if at in whole else ids[bounds[at]:bounds[at + 1]] for at in range(len(texts))]
            sizes[list(whole)] = [len(own) for own in whole.values()]
            ids, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])
        if end is not None:
            ids, bounds = np.insert(ids, bounds[1:], end), bounds + np.arange(len(bounds))
        return ids, bounds

    def _alone(self, texts: pa.Array) -> np.ndarray:
        """Which texts are encoded whole."""
        found = np.full(len(texts), not self.cuts)
        raw = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts), "\n")[0].as_py().encode() if self.cuts else b""
        for part in (*self.added, _FIRST, _LINE, _PLAIN):
            if part.encode() in raw:
                found |= pc.match_substring(texts, part).to_numpy(zero_copy_only=False)
        return found

    def _flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        marked = pc.binary_join_element_wise(_FIRST, pc.replace_substring(texts, "\n", " " + _LINE), "")
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        distinct, place = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False)
        kept = self.used, self.pieces
        numbers = self._numbers(distinct)[place]
        joined = numbers < 0
        if joined.any():
            numbers = self._join(numbers, joined, distinct, place)
        sizes = self.sizes[numbers]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.starts[numbers] - ends[:-1], sizes) + np.arange(ends[-1])]
        if len(self.known) >= self.remembered:
            self._forget(*kept)
        return ids, ends[split.offsets.to_numpy()]

    def _join(self, numbers: np.ndarray, joined: np.ndarray, distinct: list[str], place: np.ndarray) -> np.ndarray:
        """``numbers`` where pieces that do not begin with a cut are units of their own, or joined with those they must not be cut from."""
        at = np.flatnonzero(joined)
        before = joined[at - 1] | self.blank_end[np.maximum(numbers[at - 1], 0)]
        after = np.append(joined, False)[at + 1]
        single = at[~before & ~after]
        numbers[single] = -2 - numbers[single]
        runs = np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)
        runs = [run for run in runs if numbers[run[0]] < 0]
        units = []
        for run in runs:
            first = int(run[0]) - bool(self.blank_end[max(numbers[run[0] - 1], 0)])
            units.append((first, int(run[-1]) + 1, _PLAIN + "".join([self._text(distinct[place[k]]) for k in range(first, int(run[-1]) + 1)])))
        for (first, stop, _), number in zip(units, self._numbers([unit for _, _, unit in units]).tolist()):
            numbers[first:stop] = 0
            numbers[first] = number
        return numbers

    @staticmethod
    def _text(piece: str) -> str:
        lead = piece[:1]
        return piece[1:] if lead in (_FIRST, _PLAIN) and lead else "\n" + piece[1:] if lead == _LINE else " " + piece

    @staticmethod
    def _cut(piece: str) -> bool:
        """Whether a cut lies before the piece: white space before something else."""
        lead = piece[:1]
        follows = piece[1:2] if lead == _LINE else lead
        return lead in (_FIRST, _PLAIN) and bool(lead) or bool(follows) and not follows.isspace()

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        found = list(map(self.known.get, pieces))
        if None in found:
            fresh = self._learn([piece for piece, number in zip(pieces, found) if number is None])
            found = [fresh[piece] if number is None else number for piece, number in zip(pieces, found)]
        return np.array(found, np.int64)

    def _learn(self, pieces: list[str]) -> dict[str, int]:
        """Numbers of distinct pieces that are not known."""
        together, single = [], []
        for piece in pieces:
            lead = piece[:1]
            plain = lead > " " and not lead.isspace() or lead == _LINE and self._cut(piece)
            (together if plain else single).append(piece)
        numbers = {}
        for start in range(0, len(together), _GROUP):
            group = together[start:start + _GROUP]
            ids = self._whole((" " + " ".join(group)).replace(" " + _LINE, "\n"))
            starts = np.flatnonzero(self.begins[ids])
            if len(starts) == len(group):
                first = self._store(group, ids, np.diff(np.append(starts, len(ids))))
                numbers.update(zip(group, range(first, first + len(group))))
            else:
                single.extend(group)
        encoded = [own.ids for own in self.tokenizer.encode_batch_fast(list(map(self._text, single)), add_special_tokens=False)]
        first = self._store(single, np.array([number for ids in encoded for number in ids], np.uint32), np.fromiter(map(len, encoded), np.int64, len(single)))
        numbers.update((piece, number if self._cut(piece) else -2 - number) for number, piece in enumerate(single, first))
        if len(self.known) < self.remembered:
            self.known.update(numbers)
            self.kept = self.used, self.pieces
        return numbers

    def _store(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> int:
        """The number of the first of ``pieces``, whose ids stand one after another."""
        first, stop = self.pieces, self.pieces + len(pieces)
        self.ids = _room(self.ids, self.used + len(ids))
        self.starts, self.sizes, self.blank_end = (_room(table, stop) for table in (self.starts, self.sizes, self.blank_end))
        self.ids[self.used:self.used + len(ids)] = ids
        self.starts[first:stop] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:stop] = sizes
        self.blank_end[first:stop] = [piece[-1:].isspace() for piece in pieces]
        self.used, self.pieces = self.used + len(ids), stop
        return first

    def _forget(self, used: int, pieces: int) -> None:
        """Leave out what is not remembered."""
        self.used, self.pieces = max(used, self.kept[0]), max(pieces, self.kept[1])


def checksums(ids: np.ndarray, bounds: np.ndarray) -> list[int]:
    """The CRC-32 of each stretch of ``ids``, as little-endian unsigned 32-bit numbers."""
    return checksums_at(ids, bounds[:-1], bounds[1:])


def checksums_at(ids: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[int]:
    raw = memoryview(ids.astype("<u4").tobytes())
    return [zlib.crc32(raw[a:b]) for a, b in zip((4 * starts).tolist(), (4 * stops).tolist())]


def as_bytes(ids: np.ndarray, bounds: np.ndarray, width: int) -> pa.Array:
    """Each stretch of ``ids`` as bytes, ``width`` for each id."""
    raw = ids[bounds[0]:bounds[-1]].astype(f"<u{width}").tobytes()
    offsets = (width * (bounds - bounds[0])).astype("<i4").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _room(table: np.ndarray, size: int) -> np.ndarray:
    """``table`` with room for ``size`` entries."""
    return table if size <= len(table) else np.concatenate([table, np.zeros(max(size, 2 * len(table)) - len(table), table.dtype)])


@lru_cache(maxsize=2)
def encoder(path: str, remembered: int = REMEMBERED) -> PieceEncoder:
    """The worker's encoder of a tokenizer file; it lives on from task to task."""
    return PieceEncoder(path, remembered)
