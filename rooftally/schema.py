"""Schemas and the fixed business constants shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: they decide which rows survive, so they are not tunable defaults. ---

# Source tags, in input order: rows of an earlier source win over later ones.
SOURCES = ("yad2", "facebook")

# Deal types seen in the feeds (informative; not enforced).
DEAL_TYPES = ("למכירה", "להשכרה")

# A description containing one of these (case-insensitive substring) is spam.
# With several hits the first in this order is reported.
SPAM_KEYWORDS = ("test", "בדיקה", "lorem ipsum", "dummy", "fake", "placeholder")

MIN_PRICE = 100.0            # prices below this are nonsense, whatever the deal type
OUTLIER_SIGMA = 3.0          # a price further than this many σ from the mean is rejected
PRICE_BUCKET = 100_000       # fingerprint price granularity
DOCUMENT_BATCH_LIMIT = 400   # documents per committed batch

# A record without one of these keys cannot be normalized.
REQUIRED_KEYS = ("source", "deal_type", "property_type")

LISTING = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("neighborhood", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("deal_type", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("rooms", T.DoubleType()),
    T.StructField("floor", T.IntegerType()),
    T.StructField("size_sqm", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("description", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
    T.StructField("agent_phone", T.StringType()),
])

# --- End of fixed values. ---

LISTING_COLUMNS = tuple(LISTING.names)

# Position of a row in the ordered input: sources in rank order, files by path,
# then the position inside the file. Unique per row.
SEQ = T.StructType([
    T.StructField("source_rank", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("row", T.LongType()),
])

# Internal columns that travel with a listing between stages.
SEQ_COLUMN = "_seq"
ERROR_COLUMN = "_error"
RAW_COLUMN = "_raw"
