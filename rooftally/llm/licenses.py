"""Licence scan through a positional index of rare licence words.

Templates are whole licence texts and short notices, cut into stretches of some 16 words. Of the words of a
stretch, the ones with the highest inverse document frequency over all documents are indexed with their places.
A document looks up its words in that index, and each hit says where the template would have to begin; a
stretch with enough hits that agree, and enough of its words in place, is aligned. Changed names and dropped clauses move the place where a
template seems to begin, so alignments of one template that are not far apart make one notice, and its
mandatory key phrase is verified under them.

Texts are read once: what is kept of them, and read again once the document frequencies are known, is the
sequence of their words with every word that no template has left blank.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ready, staged, words
from .license_texts import TEMPLATES

# --- Fixed values: the phrases every scan reports, and their labels. ---
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
# --- End of fixed values. ---

STRETCH_WORDS = 16  # words of a template that are aligned together, or nearly so many
RARE_WORDS = 4      # words of each stretch that are indexed
AGREE = 2           # of those, how many must agree on where the template begins
IN_PLACE = 2        # one in so many words of an aligned stretch must stand in place


def _words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


@dataclass
class Stretch:
    template: int
    first: int              # place in the template
    words: list[str]
    rare: dict[str, int]    # indexed words and their places in the template
    agree: int


@dataclass
class Template:
    label: str
    size: int
    key_at: int
    key: list[str]


def template_words(templates=TEMPLATES) -> list[str]:
    """The words that the scan needs of a text, in order."""
    texts = [text for _, text, _ in templates] + [phrase for phrase, _ in BASE]
    return sorted({word for text in texts for word in _words(text)})


def corpus_counts(kept: DataFrame) -> dict[str, int]:
    """How many rows hold each word of the ``_words`` that were kept. The result is as small as the list of these words."""
    held = F.explode(F.array_distinct(F.array_compact("_words")))
    return {row["word"]: row["count"] for row in kept.select(held.alias("word")).groupBy("word").count().collect()}


def build_index(
    counts: dict[str, int], templates=TEMPLATES, stretch_words: int = STRETCH_WORDS, rare_words: int = RARE_WORDS, agree: int = AGREE,
) -> tuple[list[Template], list[Stretch]]:
    """Templates, and their stretches with the words of highest inverse document frequency, which are those in fewest documents."""
    whole, stretches = [], []
    for number, (label, text, key) in enumerate(templates):
        found, phrase = _words(text), _words(key)
        at = next(k for k in range(len(found)) if found[k:k + len(phrase)] == phrase)
        whole.append(Template(label, len(found), at, phrase))
        parts = max(1, round(len(found) / stretch_words))
        bounds = [len(found) * part // parts for part in range(parts + 1)]
        for first, stop in zip(bounds, bounds[1:]):
            own = found[first:stop]
            once = [word for word in dict.fromkeys(own) if own.count(word) == 1]
            rare = sorted(once, key=lambda word: (counts.get(word, 0), word))[:rare_words]
            stretches.append(Stretch(number, first, own, {word: first + own.index(word) for word in rare}, min(agree, len(rare))))
    return whole, stretches


def _array(values, kind: str) -> Column:
    """A constant array, given to Spark as one literal."""
    return F.split(F.lit(",".join(str(value) for value in values)), ",").cast(f"array<{kind}>")


def _base(at: Column) -> Column:
    """Place and label of the base phrase whose last word is at ``at`` of ``_words``; null where there is none."""
    found = F.lit(None).cast("struct<at:int,label:string>")
    for phrase, name in reversed(BASE):
        before = phrase.split()[:-1]
        fits = at >= len(before)
        for back, word in enumerate(reversed(before), 1):
            fits = fits & F.get("_words", at - back).eqNullSafe(F.lit(word))
        found = F.when(fits, F.struct((at - len(before)).cast("int").alias("at"), F.lit(name).alias("label"))).otherwise(found)
    return found


def _aligned(stretches: list[Stretch]) -> tuple[Column, Column, Column]:
    """Columns, each made of the one before: hits of indexed words, their votes (stretch, begin), and votes with enough like them."""
    by_word: dict[str, list[tuple[int, int]]] = {}
    for number, stretch in enumerate(stretches):
        for word, place in stretch.rare.items():
            by_word.setdefault(word, []).append((number, place))
    listed = list(by_word)
    entries = F.array(*[
        F.array(*[F.struct(F.lit(number).alias("stretch"), F.lit(place).alias("place")) for number, place in by_word[word]]) for word in listed
    ])
    hits = F.filter(
        F.transform("_words", lambda word, at: F.when(word.isin(listed), F.struct(word.alias("word"), at.alias("at")))), lambda hit: hit.isNotNull(),
    )
    votes = F.array_sort(F.flatten(F.transform("_hits", lambda hit: F.transform(
        F.element_at(entries, F.array_position(_array(listed, "string"), hit["word"]).cast("int")),
        lambda entry: F.struct(entry["stretch"].alias("stretch"), (hit["at"] - entry["place"]).cast("int").alias("begin")),
    ))))
    # Equal votes stand together: the first of them has one like it ``agree`` - 1 further on if there are enough.
    needed = _array([stretch.agree for stretch in stretches], "int")
    agreed = F.filter("_votes", lambda vote, at: ~vote.eqNullSafe(F.get("_votes", at - 1)) & vote.eqNullSafe(
        F.get("_votes", (at + F.get(needed, vote["stretch"]) - 1).cast("int")),
    ))
    return hits, votes, agreed


def _placed(vote: Column, whole: list[Template], stretches: list[Stretch]) -> Column:
    """A vote with its template, the words of its stretch that stand in place, and whether the key phrase does."""
    all_words = F.array(*[_array(stretch.words, "string") for stretch in stretches])
    all_keys = F.array(*[_array(template.key, "string") for template in whole])
    template = F.get(_array([stretch.template for stretch in stretches], "int"), vote["stretch"])
    at = vote["begin"] + F.get(_array([stretch.first for stretch in stretches], "int"), vote["stretch"])
    key_at = vote["begin"] + F.get(_array([template.key_at for template in whole], "int"), template)
    own = F.get(all_words, vote["stretch"])
    in_place = F.size(F.filter(F.transform(own, lambda word, k: F.get("_words", (at + k).cast("int")).eqNullSafe(word)), lambda same: same))
    key = F.forall(F.transform(F.get(all_keys, template), lambda word, k: F.get("_words", (key_at + k).cast("int")).eqNullSafe(word)), lambda same: same)
    return F.struct(
        template.alias("template"), vote["begin"].alias("begin"), vote["stretch"].alias("stretch"), in_place.alias("placed"), F.size(own).alias("size"), key.alias("key"),
        F.greatest(at, F.lit(0)).alias("start"), F.least(at + F.size(own), F.size("_words")).cast("int").alias("stop"),
    )


def _notice(group: Column, whole: list[Template]) -> Column:
    """Neighbouring alignments of one template as a notice; of a stretch aligned more than once, the best counts."""
    template = F.get(group, F.lit(0))["template"]
    ordered = F.array_sort(F.transform(group, lambda one: F.struct(one["stretch"].alias("stretch"), one["placed"].alias("placed"))))
    none = F.struct(F.lit(-1).alias("stretch"), F.lit(0).alias("placed"), F.lit(0).alias("total"))
    total = F.aggregate(ordered, none, lambda last, one: F.struct(
        one["stretch"].alias("stretch"), one["placed"].alias("placed"),
        (last["total"] + one["placed"] - F.when(last["stretch"] == one["stretch"], last["placed"]).otherwise(0)).alias("total"),
    ))["total"]
    return F.struct(
        F.get(_array([one.label for one in whole], "string"), template).alias("label"),
        F.array_min(F.transform(group, lambda one: one["start"])).alias("start"), F.array_max(F.transform(group, lambda one: one["stop"])).alias("stop"),
        (total / F.get(_array([one.size for one in whole], "int"), template)).alias("share"),
    )


def scan(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``documents``: id, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``, ``notices``.

    Words are runs of letters, digits and code points beyond ASCII, A-Z folded, so line breaks and comment marks
    between them do not count; a null or empty text has none. The base is every place of a ``BASE`` phrase.
    ``labels`` are those of the base and of the templates found. ``notices`` lists the templates found: ``label``,
    ``start`` and ``stop`` (words; the part that was aligned), ``share`` of the template's words in place. Alignments of a
    template that begin within half its length of one another are one notice, and one of them must hold the key phrase.
    ``score`` is the largest share, at least 0.5 where the base has a label, and 0 without any. Very long texts are
    scanned whole: what a row takes grows with its words and its hits. Each row is judged by its own text, so rows that
    repeat give equal rows. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    ready(documents.sparkSession)
    known = template_words(templates)
    sequence = F.transform(words(F.col(f"`{text_column}`")), lambda word: F.when(word.isin(known), word))
    kept = staged(documents.select(F.col(f"`{id_column}`").alias("_id"), sequence.alias("_words")), "licence-words")
    whole, stretches = build_index(corpus_counts(kept), templates)

    ends = F.filter(F.transform("_words", lambda word, at: F.when(word == "license", at)), lambda at: at.isNotNull())
    base = F.filter(F.transform(ends, _base), lambda item: item.isNotNull())
    hits, votes, agreed = _aligned(stretches)
    found = kept.withColumn("_base", base).withColumn("_hits", hits).withColumn("_votes", votes).withColumn("_agreed", agreed)
    aligned = F.filter(F.transform("_agreed", lambda vote: _placed(vote, whole, stretches)), lambda one: one["placed"] * IN_PLACE >= one["size"])
    found = found.withColumn("_aligned", F.array_sort(aligned))

    # A notice ends where the template changes or the next alignment begins more than half its length further on.
    reach = _array([template.size // 2 for template in whole], "int")

    def opens(one: Column, at: Column) -> Column:
        before = F.get("_aligned", at - 1)
        return F.when((at == 0) | (before["template"] != one["template"]) | (one["begin"] - before["begin"] > F.get(reach, one["template"])), at)

    found = found.withColumn("_opens", F.filter(F.transform("_aligned", opens), lambda at: at.isNotNull()))
    groups = F.transform("_opens", lambda at, k: F.slice(
        "_aligned", at + 1, F.coalesce(F.get("_opens", k + 1), F.size("_aligned")) - at,
    ))
    verified = F.filter(groups, lambda group: F.exists(group, lambda one: one["key"]))
    found = found.withColumn("_notices", F.transform(verified, lambda group: _notice(group, whole)))

    own = F.transform("_base", lambda item: item["label"])
    places = F.transform("_base", lambda item: item["at"])
    best = F.coalesce(F.array_max(F.transform("_notices", lambda item: item["share"])), F.lit(0.0))
    return found.select(
        F.col("_id").alias(id_column), F.size("_words").cast("bigint").alias("n_words"), F.size("_base").cast("bigint").alias("n_base"),
        F.array_min(places).cast("bigint").alias("first_word"), F.array_max(places).cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.transform("_notices", lambda item: item["label"]))), ",").alias("labels"),
        F.when(F.size("_base") > 0, F.greatest(best, F.lit(0.5))).otherwise(best).alias("score"), F.col("_notices").alias("notices"),
    )
