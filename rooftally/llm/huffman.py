"""Canonical length-limited Huffman codes over token ids, encoded and decoded by whole arrays.

A block of ids is a bit string with a checkpoint, its bit offset, for every ``STRIDE`` ids. Decoding
looks up the next bits of all strides of a block at once, so the table drives an array per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MOST_BITS = 20
STRIDE = 128


def code_lengths(counts: np.ndarray, most_bits: int = MOST_BITS) -> np.ndarray:
    """Bits for each id under package-merge, the best code of at most ``most_bits``; 0 for ids that never occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    if len(used) > 1 << most_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {most_bits} bits")
    if len(used) == 1:
        lengths[used] = 1
    if len(used) < 2:
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    # Level by level, items are ids or packages of two; the packages chosen at a level tell how many items to take below it.
    merged, is_id = weights, np.ones(len(weights), bool)
    levels = [is_id]
    for _ in range(most_bits - 1):
        pairs = merged[:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        place = np.argsort(both, kind="stable")
        merged, is_id = both[place], place < len(weights)
        levels.append(is_id)
    bits = np.zeros(len(order), dtype=np.int64)
    take = 2 * (len(order) - 1)
    for is_id in reversed(levels):
        ids = int(is_id[:take].sum())
        bits[:ids] += 1
        take = 2 * (take - ids)
    lengths[order] = bits
    return lengths


@dataclass
class Code:
    """The canonical code of some lengths: shorter codes first, ids in order within a length."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        self.lengths = np.asarray(self.lengths, dtype=np.uint8)
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        bits = self.lengths[order].astype(np.int64)
        self.depth = int(bits.max()) if len(bits) else 1
        span = np.left_shift(1, self.depth - bits)
        starts = np.concatenate([[0], np.cumsum(span)[:-1]]) if len(bits) else np.zeros(0, np.int64)
        if len(bits) and span.sum() > 1 << self.depth:
            raise ValueError("lengths are not those of a prefix code")
        self.codes = np.zeros(len(self.lengths), dtype=np.uint64)
        self.codes[order] = starts >> (self.depth - bits)
        self._order, self._span = order, span

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """For each run of ``depth`` bits: the id that it begins with, and that id's bits."""
        ids = np.zeros(1 << self.depth, dtype=np.uint32)
        filled = np.repeat(self._order, self._span)
        ids[:len(filled)] = filled
        return ids, self.lengths[ids].astype(np.int64)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of a block, padded to bytes, and the bit offset of each stride."""
        bits = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(bits)
        starts = ends - bits
        total = int(ends[-1]) if len(ends) else 0
        word = starts >> 5
        shifted = self.codes[ids] << (64 - bits - (starts & 31)).astype(np.uint64)
        size = (total >> 5) + 2
        # Codes do not overlap, so sums of their bits are exact.
        high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), size)
        low = np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
        return (high + low).astype(np.uint64).astype(">u4").tobytes()[:(total + 7) >> 3], starts[::STRIDE]


def decode(block: bytes, checkpoints: np.ndarray, count: int, table: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """The ``count`` ids of a block."""
    if not count:
        return np.zeros(0, dtype=np.uint32)
    by_bits, bits_of = table
    raw = np.frombuffer(block + bytes(8), dtype=np.uint8).astype(np.uint64)
    windows = (raw[:-3] << np.uint64(24)) | (raw[1:-2] << np.uint64(16)) | (raw[2:-1] << np.uint64(8)) | raw[3:]
    at = np.asarray(checkpoints, dtype=np.int64).copy()
    out = np.zeros((len(at), STRIDE), dtype=np.uint32)
    mask = np.uint64((1 << depth) - 1)
    last = count - (len(at) - 1) * STRIDE
    for step in range(min(STRIDE, count)):
        live = len(at) if step < last else len(at) - 1
        here = at[:live]
        peek = (windows[here >> 3] >> (32 - depth - (here & 7)).astype(np.uint64)) & mask
        out[:live, step] = by_bits[peek]
        at[:live] += bits_of[peek]
    return out.ravel()[:count]
