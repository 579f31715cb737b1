"""Toxicity by multiple-instance learning.

Labels are given for documents, but what offends is a sentence. Each sentence gets a linear score
over hashed words and word beginnings; a document is toxic unless none of its sentences is:
1 - prod(1 - p), the noisy-or. A sentence without any feature that tells toxic documents apart has
probability 0, so length alone never makes a document toxic. Training fits sentence weights to the labels of documents through
that, so the same weights point at the sentences.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready

DIMENSION = 1 << 18
BEGINNINGS = (3, 4, 5)
FIT_DOCUMENTS = 6_000   # labelled documents that the driver fits on, at most half of them toxic
EPOCHS = 60
TELLING = 5              # standard errors by which a feature's share differs between labels to take part
REJECT_AT = 0.3
_EDGE = b".,;:!?\"'()[]{}<>*#$%&|-_/\\"
_KNOWN = 200_000         # words whose score a worker remembers


def features(word: bytes) -> list[int]:
    """Hashed features of a word: itself, and its beginnings when it is longer."""
    word = word.strip(_EDGE + b"\n")
    found = [zlib.crc32(word) % DIMENSION] if word else []
    for size in BEGINNINGS:
        if len(word) > size:
            found.append(zlib.crc32(word[:size] + b"*") % DIMENSION)
    return found


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z folded; a line feed ends a sentence, so it is a word of its own."""
    found = []
    for line in (text or "").encode().lower().split(b"\n"):
        found += line.split()
        found.append(b"\n")
    found.pop()
    return found


SENTENCE = re.compile(r"[^\n]*?(?:[.!?](?=[\s]|\Z)|(?=\n)|\Z)", re.S)
_ENDS = (b".", b"!", b"?", b"\n")


def ends_sentence(word: bytes) -> bool:
    return word.endswith(_ENDS)


@dataclass
class ToxicityModel:
    """A weight for each feature and the bias of a sentence.

    ``telling`` marks the features that are evidence; a sentence without any has probability 0. Without
    it every word is evidence, a bare line break is not.
    """

    weights: np.ndarray
    bias: float
    telling: np.ndarray | None = None

    def scorer(self) -> _Scorer:
        return _Scorer(self.weights, self.bias, self.telling)

    def score(self, text: Column) -> Column:
        """The probability that ``text`` is toxic; texts without words, and null, get that of no sentence, 0."""
        model = self

        def score_batch(texts: pd.Series) -> pd.Series:
            scorer = model.scorer()
            return pd.Series([scorer.document(value) for value in texts], dtype="float64")

        return F.pandas_udf(score_batch, "double")(text)

    def offending(self, documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", at: float = REJECT_AT) -> DataFrame:
        """The sentences scored ``at`` or more: id, ``sentence`` (its number), ``start``, ``stop`` (characters) and ``score``."""
        model = self
        rows = documents.select(F.col(f"`{id_column}`").alias("_id"), F.col(f"`{text_column}`").alias("_text"))

        def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = model.scorer()
            for batch in batches:
                found = [
                    (key, *sentence)
                    for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for sentence in scorer.sentences(text) if sentence[-1] >= at
                ]
                columns = list(zip(*found)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([
                    pa.array(columns[0], batch.column(0).type),
                    *[pa.array(column, pa.int64()) for column in columns[1:4]], pa.array(columns[4], pa.float64()),
                ], ["_id", "sentence", "start", "stop", "score"])

        ready(documents.sparkSession)
        shape = "0L sentence, 0L start, 0L stop, 0D score"
        schema = rows.selectExpr("_id", *[part.strip() for part in shape.split(",")]).schema
        return rows.mapInArrow(locate, schema).withColumnRenamed("_id", id_column)


class _Scorer(dict):
    """Word scores as they are met; that of a word that is no evidence is not a number."""

    def __init__(self, weights: np.ndarray, bias: float, telling: np.ndarray | None = None) -> None:
        self.weights, self.bias = weights.tolist(), bias
        self.telling = None if telling is None else telling.tolist()

    def __missing__(self, word: bytes) -> float:
        weights, telling, value = self.weights, self.telling, 0.0
        evident = word != b"\n" if telling is None else False
        for feature in features(word):
            value += weights[feature]
            evident = evident or telling[feature]
        if not evident:
            value = np.nan
        if len(self) < _KNOWN:
            self[word] = value
        return value

    def logits(self, text: str | None) -> np.ndarray:
        found = tokens(text)
        if not found:
            return np.zeros(0)
        scores = np.fromiter(map(self.__getitem__, found), np.float64, len(found))
        ends = np.fromiter(map(ends_sentence, found), bool, len(found))
        starts = np.flatnonzero(np.concatenate([[True], ends[:-1]]))
        evident = ~np.isnan(scores)
        logits = np.add.reduceat(np.where(evident, scores, 0.0), starts) + self.bias
        return np.where(np.logical_or.reduceat(evident, starts), logits, -np.inf)

    def document(self, text: str | None) -> float:
        logits = self.logits(text)
        return float(-np.expm1(-np.logaddexp(0, logits).sum())) if len(logits) else 0.0

    def sentences(self, text: str | None) -> list[tuple[int, int, int, float]]:
        found = []
        for place in SENTENCE.finditer(text or ""):
            logits = self.logits(place.group())
            if len(logits):
                found.append((len(found), place.start(), place.end(), float(-np.expm1(-np.logaddexp(0, logits).sum()))))
        return found


def fit(rows: pd.DataFrame, epochs: int = EPOCHS) -> ToxicityModel:
    """A model from ``text``, ``label`` and ``weight``. Without both labels no feature is evidence, so it gives every text 0."""
    weights = np.zeros(DIMENSION)
    labels = rows["label"].to_numpy(np.float64)
    if not len(rows) or labels.min() == labels.max():
        return ToxicityModel(weights.astype(np.float32), -12.0, np.zeros(DIMENSION, bool))
    cache: dict[bytes, list[int]] = {}

    def features_of(word: bytes) -> list[int]:
        ids = cache.get(word)
        if ids is None:
            ids = features(word)
            if len(cache) < _KNOWN:
                cache[word] = ids
        return ids

    # Features that one label's documents hold beyond chance take part, however rare; sentences without any of the toxic ones are left out.
    hits, others, toxic, clean = support(rows["text"], labels, features_of)
    share = (hits + others + 1) / (toxic + clean + 2)
    surplus = (hits / toxic - others / clean) / np.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    evidence = (surplus > TELLING) & (hits / toxic > 5 * others / clean)
    usable = evidence | (surplus < -TELLING)
    chosen = set(np.flatnonzero(usable).tolist())

    cells, documents, sentences = [], [], 0
    for at, text in enumerate(rows["text"]):
        found = tokens(text)
        first = sentences
        for word in found:
            # A sentence has a feature or not, however often.
            cells += [sentences * DIMENSION + feature for feature in features_of(word) if feature in chosen]
            sentences += ends_sentence(word)
        sentences += bool(found) and not ends_sentence(found[-1])
        documents += [at] * (sentences - first)
    owner, feature = np.divmod(np.unique(np.array(cells, np.int64)), DIMENSION)
    # Signs of cleanness alone make no sentence evident.
    evident = np.zeros(max(sentences, 1), bool)
    evident[owner[evidence[feature]]] = True
    owner, feature = owner[evident[owner]], feature[evident[owner]]
    held, owner = np.unique(owner, return_inverse=True)
    documents, sentences = np.array(documents, np.int64)[held], len(held)

    importance = rows["weight"].to_numpy(np.float64)
    importance = importance / importance.mean()
    bias = -8.0
    squares, bias_square = np.full(DIMENSION, 1e-6), 1e-6
    for _ in range(epochs):
        logits = np.bincount(owner, weights[feature], sentences) + bias
        soft, chance = np.logaddexp(0, logits), np.exp(-np.logaddexp(0, -logits))
        total = np.maximum(np.bincount(documents, soft, len(rows)), 1e-9)
        # Of the negative log-likelihood of the noisy-or, by a sentence's logit.
        slope = np.where(labels > 0.5, -1 / np.expm1(np.minimum(total, 50)), 1.0) * importance
        by_sentence = slope[documents] * chance
        gradient = np.bincount(feature, by_sentence[owner], DIMENSION) + 0.02 * weights
        gradient[~usable] = 0
        squares += gradient ** 2
        weights -= gradient / np.sqrt(squares)
        slope_bias = by_sentence.sum() + 0.5 * (bias + 12)
        bias_square += slope_bias ** 2
        bias -= slope_bias / np.sqrt(bias_square)
        # What tells toxic documents apart never speaks for a text.
        weights[evidence] = np.maximum(weights[evidence], 0)
    return ToxicityModel(weights.astype(np.float32), float(bias), evidence & (weights > 0))


def copy_groups(words: list[np.ndarray]) -> list[int]:
    """A number for each document, given the checksums of its words: the same for documents that have half of all their words in common.

    Those that agree in two smallest products of four kinds are compared; copies hardly ever miss each other in all four.
    """
    group = list(range(len(words)))

    def first(at: int) -> int:
        while group[at] != at:
            group[at] = at = group[group[at]]
        return at

    kinds = np.random.default_rng(0).integers(1 << 62, size=(4, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for kind in kinds:
        buckets: dict[tuple[int, int], list[int]] = {}
        for at, own in enumerate(words):
            if not len(own):
                continue
            met = buckets.setdefault(tuple(int((own.astype(np.uint64) * factor).min()) for factor in kind), [])
            for other in met:
                if first(other) == first(at):
                    break
                common = len(np.intersect1d(own, words[other], assume_unique=True))
                if 3 * common >= len(own) + len(words[other]):
                    group[first(at)] = first(other)
                    break
            else:
                met.append(at)
    return [first(at) for at in range(len(words))]


def support(texts: pd.Series, labels: np.ndarray, features_of: Callable[[bytes], list[int]]) -> tuple[np.ndarray, np.ndarray, int, int]:
    """How many toxic and other documents hold each feature, and how many there are of either. Copies and near copies of a label count once."""
    words = [np.unique(np.array([zlib.crc32(word) for word in set(tokens(text)) - {b"\n"}], np.uint32)) for text in texts]
    groups = [(bool(label > 0.5), group) for label, group in zip(labels, copy_groups(words))]
    counts, sizes = np.zeros((2, DIMENSION), np.int64), [0, 0]
    # One group after another, so that the features of few documents are held at a time.
    order = sorted((at for at, own in enumerate(words) if len(own)), key=lambda at: groups[at])
    for (label, _), members in itertools.groupby(order, key=lambda at: groups[at]):
        own = {feature for at in members for word in set(tokens(texts.iloc[at])) for feature in features_of(word)}
        counts[int(label), np.fromiter(own, np.int64, len(own))] += 1
        sizes[int(label)] += 1
    return counts[1], counts[0], max(sizes[1], 1), max(sizes[0], 1)


def is_held_out(id_column: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` when divided by ``parts``; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == part, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, allowed: Column, limit: int, id_column: str = "doc_id", text_column: str = "text",
) -> pd.DataFrame:
    """At most ``limit`` labelled documents, half of each label at most, with the weight that makes up for the choice.

    Rows are chosen by a hash of their id, so the choice repeats and covers the whole table. A document
    labelled more than once takes the mean of its labels. The ids are at most ``limit``, hence the broadcast.
    """
    votes = labels.where(F.col(f"`{label}`").isNotNull() & F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").alias("_id"), F.col(f"`{label}`").cast("double").alias("_vote"),
    ).where(allowed)
    marked = votes.groupBy("_id").agg((F.avg("_vote") >= 0.5).cast("int").alias("label"))
    totals = {row["label"]: row["count"] for row in marked.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = marked.where(F.col("label") == value).orderBy(F.xxhash64("_id"), "_id").limit(limit // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = documents.select(F.col(f"`{id_column}`").alias("_doc"), F.col(f"`{text_column}`").alias("text"))
    # An id that several rows carry gives one of them.
    rows = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        F.min("text").alias("text"), F.min("label").alias("label"),
    ).toPandas().sort_values("_id")
    kept = rows["label"].value_counts()
    rows["weight"] = [totals[value] / kept[value] for value in rows["label"]]
    return rows.reset_index(drop=True)


def learn(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", *, allowed: Column | None = None,
    fit_documents: int = FIT_DOCUMENTS, epochs: int = EPOCHS,
) -> ToxicityModel:
    """A model fitted to at most ``fit_documents`` labelled documents. ``allowed`` is a condition on ``_id`` of the labels.

    Very long texts are cut into sentences whole. Other columns are ignored, whatever their names.
    """
    allowed = F.lit(True) if allowed is None else allowed
    return fit(labelled_sample(documents, labels, label, allowed, fit_documents), epochs)


def drop_toxic(documents: DataFrame, model: ToxicityModel, text_column: str = "text", at: float = REJECT_AT) -> DataFrame:
    """``documents`` without those scored ``at`` or more. Each row is judged by its text alone; null and empty ones stay."""
    ready(documents.sparkSession)
    return documents.where(model.score(F.col(f"`{text_column}`")) < at)
