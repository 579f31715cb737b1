"""Quality by histogram gradient-boosted trees over statistics of a document.

Trees are grown level by level on binned statistics, and flattened into arrays: a batch of
documents walks every tree by index arithmetic, without a branch in Python.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready

FIT_DOCUMENTS = 20_000   # labelled documents that the driver fits on
TREES, DEPTH, BINS, RATE = 80, 4, 64, 0.15

STATISTICS = (
    "bytes", "words", "word_length", "word_length_spread", "distinct_words", "top_word", "repeated_next", "longest_run",
    "lines", "line_length", "distinct_lines", "letters", "capitals", "digits", "spaces", "beyond_ascii", "punctuation",
    "bars", "symbols", "full_stops", "commas", "symbol_words", "short_words", "entropy", "control",
)

_CLASS = np.zeros((256, 11), dtype=np.float64)
for _byte in range(256):
    _char = chr(_byte)
    _CLASS[_byte] = (
        _byte < 128 and _char.isalpha(), "A" <= _char <= "Z", _byte < 128 and _char.isdigit(), _char in " \t\r\n", _byte >= 128,
        33 <= _byte < 127 and not _char.isalnum(), _char == "|", _char in "*#$%&@^~=<>{}[]\\", _char == ".", _char == ",",
        _byte < 32 and _char not in "\t\r\n",
    )


def statistics(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero for null and empty."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = counts @ _CLASS / len(raw)
    some = counts[counts > 0] / len(raw)
    found = raw.split()
    number = len(found)
    lengths = np.fromiter(map(len, found), np.int64, number)
    often = Counter(found)
    ids = {word: at for at, word in enumerate(often)}
    order = np.fromiter(map(ids.__getitem__, found), np.int64, number)
    same = order[1:] == order[:-1]
    breaks = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    letters, capitals, digits, spaces, beyond, punctuation, bars, symbols, stops, commas, control = shares
    some_words, some_lines = max(number, 1), max(len(lines), 1)
    return [
        np.log1p(len(raw)), np.log1p(number), lengths.mean() if number else 0.0, lengths.std() if number else 0.0,
        len(often) / some_words, max(often.values(), default=0) / some_words, same.sum() / some_words,
        np.diff(breaks).max() / some_words if number else 0.0,
        np.log1p(len(lines)), np.log1p(sum(map(len, lines)) / some_lines), len(set(lines)) / some_lines,
        letters, capitals, digits, spaces, beyond, punctuation, bars, symbols, stops * len(raw) / some_words,
        commas * len(raw) / some_words, sum(1 for word in often if not word.isalpha() and word[-1:] not in b".,;:!?" and word[-1] < 128) / max(len(often), 1),
        (lengths <= 2).sum() / some_words, -(some * np.log2(some)).sum(), control,
    ]


def statistics_column(text: Column) -> Column:
    """The statistics of ``text`` as an array of floats."""
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(statistics(value), np.float32) for value in texts])

    return F.pandas_udf(measure, "array<float>")(text)


@dataclass
class Forest:
    """Full trees of one depth in arrays: node ``k`` has children ``2k + 1`` and ``2k + 2``; leaves follow the last level."""

    feature: np.ndarray     # trees x inner nodes
    threshold: np.ndarray   # trees x inner nodes; a value at most this goes to the first child
    leaf: np.ndarray        # trees x leaves
    base: float

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row of statistics."""
        total = np.full(len(rows), self.base)
        if not len(rows):
            return total
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        at = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[at, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return total

    def score(self, values: Column) -> Column:
        """The probability of label 1, from the column of statistics."""
        forest = self

        def score_batch(batch: pd.Series) -> pd.Series:
            rows = np.stack(batch.to_list()) if len(batch) else np.zeros((0, len(STATISTICS)), np.float32)
            return pd.Series(1 / (1 + np.exp(-forest.margins(rows))))

        return F.pandas_udf(score_batch, "double")(values)


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Trees boosted on the logistic loss. With no rows every score is one half; with one label, near that label."""
    inner, leaves = (1 << depth) - 1, 1 << depth
    rows = np.asarray(rows, np.float32).reshape(-1, len(STATISTICS))
    labels = np.asarray(labels, np.float64)
    prior = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(prior / (1 - prior)))
    if not len(rows) or labels.min() == labels.max():
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)), base)
    width = rows.shape[1]
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])).astype(np.float32) for column in rows.T]
    binned = np.stack([np.searchsorted(edge, column, "left") for edge, column in zip(edges, rows.T)], axis=1)
    column_start = np.arange(width) * bins
    flat = binned + column_start
    margin = np.full(len(rows), base)
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves)), base)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = labels - chance, np.maximum(chance * (1 - chance), 1e-6)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first = (1 << level) - 1
            cells = ((node - first)[:, None] * (width * bins) + flat).ravel()
            shape = ((1 << level), width, bins)
            slopes = np.bincount(cells, np.repeat(slope, width), np.prod(shape)).reshape(shape).cumsum(axis=2)
            bends = np.bincount(cells, np.repeat(bend, width), np.prod(shape)).reshape(shape).cumsum(axis=2)
            whole, weight = slopes[:, :, -1:], bends[:, :, -1:]
            gain = slopes ** 2 / (bends + 1) + (whole - slopes) ** 2 / (weight - bends + 1) - whole ** 2 / (weight + 1)
            gain[(bends < 2) | (weight - bends < 2)] = -np.inf
            for k, best in enumerate(gain.reshape(1 << level, -1).argmax(axis=1)):
                column, cut = divmod(int(best), bins)
                if gain[k, column, cut] > 1e-3 and cut < len(edges[column]):
                    forest.feature[tree, first + k], forest.threshold[tree, first + k] = column, edges[column][cut]
            chosen = forest.feature[tree, node]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), chosen] > forest.threshold[tree, node])
        leaf = node - inner
        forest.leaf[tree] = rate * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + 1)
        margin += forest.leaf[tree][leaf]
    return forest


def measured(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id`` and ``_values`` (the statistics) of every row of ``documents``. The text is read once for fitting and scoring.

    Null and empty texts have the statistics of no words, very long ones are measured whole, rows that repeat have a
    row each, and an empty table has none. Other columns are ignored, whatever their names.
    """
    ready(documents.sparkSession)
    return documents.select(
        F.col(f"`{id_column}`").alias("_id"), statistics_column(F.col(f"`{text_column}`")).alias("_values"),
    )


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality", *, allowed: Column | None = None, id_column: str = "doc_id", fit_documents: int = FIT_DOCUMENTS) -> Forest:
    """Trees fitted to at most ``fit_documents`` labelled rows of :func:`measured`, chosen by a hash of their id.

    ``allowed`` is a condition on ``_id`` of the labels. A document labelled more than once takes the
    mean of its labels; rows without an id or a label are not learned from.
    """
    votes = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("_vote"),
    )
    marked = votes.where(F.lit(True) if allowed is None else allowed).groupBy("_id").agg((F.avg("_vote") >= 0.5).cast("int").alias("_label"))
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(fit_documents)
    sample = rows.join(F.broadcast(chosen), "_id").groupBy("_id").agg(
        F.min("_values").alias("_values"), F.min("_label").alias("_label"),
    ).toPandas().sort_values("_id")
    values = np.stack(sample["_values"].to_list()) if len(sample) else np.zeros((0, len(STATISTICS)))
    return fit(values, sample["_label"].to_numpy())
