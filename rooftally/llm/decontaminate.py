"""Benchmark decontamination through a positional index of training text.

Test items are cut into windows of consecutive words. A first reading of all texts counts these words;
the rarest of each window are its anchors. A second reading writes the index: the postings (word, document,
position) of the anchors alone, a small share of those of all words of the tests. A window can only occur
where the positions of its anchors, less their places in the window, agree, so their lists are intersected
from the rarest on, and what is left is compared with the words of the document. Everything is a DataFrame
expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bit_table, retain, staged, with_bit, words

WINDOW_WORDS = 10
FILTER_BITS = 1 << 20
SLOP = 5


def item_windows(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text", window: int = WINDOW_WORDS) -> DataFrame:
    """``_item``, ``_phrase`` (words joined by spaces) and ``_words`` of every window; a shorter item is one, an empty one none."""
    items = benchmark.select(F.col(f"`{item_column}`").alias("_item"), words(F.col(f"`{text_column}`")).alias("_all")).where("size(_all) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_all") - window + 1))
    cut = items.select("_item", "_all", F.explode(starts).alias("_from")).select("_item", F.slice("_all", F.col("_from"), window).alias("_words"))
    return cut.select("_item", F.array_join("_words", " ").alias("_phrase"), "_words").distinct()


def _marked(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows by id and a hash of their text: rows that agree in both have the same words, so they may share results."""
    return documents.select(F.col(f"`{id_column}`").alias("_id"), _mark_of(text_column).alias("_mark"), F.col(f"`{text_column}`").alias("_text"))


def _mark_of(text_column: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_column}`"), F.lit("")))


def _among(rows: DataFrame, vocabulary: DataFrame, bits: int) -> DataFrame:
    """``rows`` whose ``_word`` is in ``vocabulary``, and some few others.

    Words are told apart by a number below ``bits``, so at most as many rows are broadcast.
    """
    slot = F.pmod(F.xxhash64("_word"), F.lit(bits))
    slots = vocabulary.select(slot.alias("_slot")).distinct()
    return rows.withColumn("_slot", slot).join(F.broadcast(slots), "_slot", "left_semi").drop("_slot")


def anchors_of(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """For each phrase that can occur at all: its rarest word and the next rarest other one, if any, with their places."""
    places = phrases.select("_phrase", F.size("_words").alias("_size"), F.posexplode("_words").alias("_place", "_word"))
    counted = places.join(counts, "_word", "left").withColumn("_times", F.coalesce("_times", F.lit(0)))
    ranked = counted.groupBy("_phrase", "_word").agg(F.min("_place").alias("_place"), F.first("_times").alias("_times"), F.first("_size").alias("_size"))
    by_rarity = Window.partitionBy("_phrase").orderBy("_times", "_word")
    first = ranked.withColumn("_rank", F.row_number().over(by_rarity)).where("_rank <= 2").groupBy("_phrase").agg(
        F.min(F.struct("_rank", "_word", "_place", "_times", "_size")).alias("_one"),
        F.max(F.struct("_rank", "_word", "_place")).alias("_two"),
    )
    # A window with a word that no document has cannot occur.
    return first.where("_one._times > 0").select(
        "_phrase", F.col("_one._size").alias("_size"), F.col("_one._word").alias("_word"), F.col("_one._place").alias("_place"),
        F.when(F.col("_two._rank") == 2, F.col("_two._word")).alias("_next"), F.col("_two._place").alias("_next_place"),
    )


class PhraseIndex:
    """The postings over all of ``documents`` of the anchors of ``phrases``, in the shared folder.

    The empty word, which no text has, is posted at the end of every document, so the index knows all
    documents and how many words they have.
    """

    def __init__(self, documents: DataFrame, phrases: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = FILTER_BITS) -> None:
        self.bits = bits
        self.rows = _marked(documents, id_column, text_column)
        vocabulary = staged(phrases.select(F.explode("_words").alias("_word")).distinct(), "vocabulary")
        ended = F.array_append(words(F.col("_text")), F.lit(""))
        placed = self.rows.select("_id", "_mark", F.posexplode(ended).alias("_position", "_word"))
        # Counted before the shuffle: a task sends a row for each word of the tests, however frequent.
        times = _among(placed.select("_word"), vocabulary, bits).groupBy("_word").agg(F.count(F.lit(1)).alias("_times"))
        counts = staged(times.join(vocabulary, "_word", "left_semi"), "word-counts")
        self.anchors = staged(anchors_of(phrases, counts), "anchors")
        wanted = self.anchors.select("_word").union(self.anchors.where("_next IS NOT NULL").select("_next"))
        nothing = documents.sparkSession.createDataFrame([("",)], "_word string")
        self.index = staged(_among(placed, wanted.union(nothing), bits), "postings")
        self.postings = self.index.where("_word <> ''")

    @property
    def documents(self) -> DataFrame:
        """``_id``, ``_mark`` and ``n_words`` of every row."""
        return self.index.where("_word = ''").select("_id", "_mark", F.col("_position").cast("bigint").alias("n_words"))

    def candidates(self) -> DataFrame:
        """``_id``, ``_mark``, ``_phrase``, ``_start``, ``_size`` where the anchors of a phrase stand as they do in it."""
        first = self.postings.join(self.anchors, "_word").select(
            "_id", "_mark", "_phrase", "_size", (F.col("_position") - F.col("_place")).alias("_start"), "_next", "_next_place",
        ).where("_start >= 0")
        following = self.postings.select(
            F.col("_id").alias("_other_id"), F.col("_mark").alias("_other_mark"), F.col("_word").alias("_other_word"), F.col("_position").alias("_at"),
        )
        agreed = first.where("_next IS NOT NULL").join(
            following,
            F.col("_id").eqNullSafe(F.col("_other_id")) & (F.col("_mark") == F.col("_other_mark"))
            & (F.col("_next") == F.col("_other_word")) & (F.col("_start") + F.col("_next_place") == F.col("_at")),
            "left_semi",
        )
        columns = ["_id", "_mark", "_phrase", "_size", "_start"]
        return agreed.select(columns).unionByName(first.where("_next IS NULL").select(columns))

    def near(self, slop: int = SLOP) -> DataFrame:
        """``_id``, ``_mark``, ``_phrase``, ``_start``, ``_apart`` where the two rarest words of a phrase stand up to ``slop`` words off their distance in it."""
        def starts(word: str, place: str, name: str) -> DataFrame:
            anchors = self.anchors.where("_next IS NOT NULL").select("_phrase", F.col(word).alias("_word"), F.col(place).alias("_from"))
            return self.postings.join(anchors, "_word").select("_id", "_mark", "_phrase", (F.col("_position") - F.col("_from")).alias(name))

        # Starts are compared within stretches of the slop's size and their neighbours, not all with all.
        one = starts("_word", "_place", "_start").withColumn("_part", F.floor(F.col("_start") / (slop + 1)))
        two = starts("_next", "_next_place", "_other").withColumn(
            "_part", F.explode(F.array(*[F.floor(F.col("_other") / (slop + 1)) + step for step in (-1, 0, 1)])),
        )
        apart = F.abs(F.col("one._start") - F.col("two._other"))
        same = F.col("one._id").eqNullSafe(F.col("two._id"))
        for name in ("_mark", "_phrase", "_part"):
            same = same & (F.col(f"one.{name}") == F.col(f"two.{name}"))
        return one.alias("one").join(two.alias("two"), same & apart.between(1, slop)).select(
            "one._id", "one._mark", "one._phrase", "one._start", apart.alias("_apart"),
        ).distinct()


def occurrences(index: PhraseIndex, candidates: DataFrame) -> DataFrame:
    """``_id``, ``_mark`` and ``_found``: those candidates (``_start``, ``_size``, ``_phrase``) whose words are all those of the phrase.

    A row for each row of the documents that has any candidate.
    """
    # Words of the documents that have a candidate, and of some few others, are read again to be compared.
    table = bit_table(candidates, F.col("_mark"), index.bits)
    suspects = with_bit(index.rows, table, F.col("_mark"), index.bits, "_maybe").where("_maybe").select("_id", "_mark", words(F.col("_text")).alias("_all"))
    per_document = candidates.groupBy("_id", "_mark").agg(F.collect_set(F.struct("_start", "_size", "_phrase")).alias("_candidates"))
    places = per_document.select(F.col("_id").alias("_of"), F.col("_mark").alias("_of_mark"), "_candidates")
    checked = suspects.join(places, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_of_mark")))
    found = F.filter(
        "_candidates", lambda c: F.array_join(F.slice(F.col("_all"), c["_start"] + 1, c["_size"]), " ") == c["_phrase"],
    )
    return checked.select("_id", "_mark", found.alias("_found"))


def contamination(
    documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS, bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_hit``, ``item_ids`` (sorted strings) and ``contaminated``.

    Words are runs of letters, digits and code points beyond ASCII, A-Z folded; a null text has none. A
    word is hit when it lies in an occurrence of a window, so a document is contaminated when any is.
    ``item_ids`` names the items with a window that occurs; items without an id mark words but are not named.
    Equal items, and rows of equal id and text, are each reported alike. Empty tables give no hits.
    Very long texts are searched whole, one array of words to a row. Other columns are ignored, whatever their names.
    """
    found = _contamination(documents, benchmark, id_column, text_column, item_column, item_text_column, window, bits)
    return found.drop("_mark").withColumnRenamed("_id", id_column)


def _contamination(
    documents: DataFrame, benchmark: DataFrame, id_column: str, text_column: str, item_column: str, item_text_column: str, window: int, bits: int,
) -> DataFrame:
    windows = staged(item_windows(benchmark, item_column, item_text_column, window), "windows")
    phrases = staged(windows.select("_phrase", "_words").distinct(), "phrases")
    index = PhraseIndex(documents, phrases, id_column, text_column, bits)
    checked = occurrences(index, staged(index.candidates(), "candidates"))
    covered = F.array_distinct(F.flatten(F.transform("_found", lambda c: F.sequence(c["_start"], c["_start"] + c["_size"] - 1))))
    hits = checked.where("size(_found) > 0").select(
        "_id", "_mark", F.size(covered).cast("bigint").alias("_hit"), F.array_distinct(F.transform("_found", lambda c: c["_phrase"])).alias("_phrases"),
    )
    hits = staged(hits.dropDuplicates(["_id", "_mark"]), "hits")
    named = hits.select("_id", "_mark", F.explode("_phrases").alias("_phrase")).join(windows.select("_phrase", "_item"), "_phrase")
    items = named.groupBy("_id", "_mark").agg(F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("_items"))
    marks = hits.alias("h").join(
        items.alias("i"), F.col("h._id").eqNullSafe(F.col("i._id")) & (F.col("h._mark") == F.col("i._mark")), "left",
    ).select(F.col("h._id").alias("_of"), F.col("h._mark").alias("_of_mark"), "_hit", "_items")
    joined = index.documents.join(staged(marks, "marks"), F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_mark") == F.col("_of_mark")), "left")
    return joined.select(
        "_id", "_mark", "n_words", F.coalesce("_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("item_ids"), F.col("_hit").isNotNull().alias("contaminated"),
    )


def matches(
    documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS, slop: int = SLOP, bits: int = FILTER_BITS,
) -> DataFrame:
    """Where windows match: id, ``phrase``, ``start`` (the word it begins at) and ``apart``, 0 where all its words stand as in the window.

    With 1 to ``slop`` the two rarest words stand that many words nearer or farther, a proximity match.
    A phrase of one distinct word has no two words to be near each other, so it only matches exactly.
    """
    windows = staged(item_windows(benchmark, item_column, item_text_column, window), "windows")
    index = PhraseIndex(documents, staged(windows.select("_phrase", "_words").distinct(), "phrases"), id_column, text_column, bits)
    found = occurrences(index, staged(index.candidates(), "candidates")).select("_id", F.explode("_found").alias("_at"))
    exact = found.select("_id", "_at._phrase", "_at._start", F.lit(0).alias("_apart"))
    return exact.unionByName(index.near(slop).select("_id", "_phrase", "_start", "_apart")).distinct().toDF(id_column, "phrase", "start", "apart")


def drop_contaminated(
    documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", *,
    item_column: str = "item_id", item_text_column: str = "text", window: int = WINDOW_WORDS, bits: int = FILTER_BITS,
) -> DataFrame:
    """``documents`` without the rows that hold any window of ``benchmark``. Rows that share an id are judged each by its own text."""
    found = _contamination(documents, benchmark, id_column, text_column, item_column, item_text_column, window, bits)
    verdicts = found.select("_id", "_mark", (~F.col("contaminated")).alias("_stays"))
    return retain(documents, verdicts, id_column, _mark_of(text_column), once=False)
