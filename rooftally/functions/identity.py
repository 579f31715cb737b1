"""Listing identity: price bucket and fingerprint."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import PRICE_BUCKET
from .pytext import float_text

__all__ = ["float_text", "price_bucket", "fingerprint"]


def price_bucket(price: Column, size: int = PRICE_BUCKET) -> Column:
    """Nearest multiple of ``size``; ties go to the even multiple (``rint``, not ``round``)."""
    return F.rint(price / F.lit(size)).cast("bigint") * F.lit(size)


def fingerprint(
    city: Column, street: Column, rooms: Column, price: Column, deal_type: Column,
    bucket_size: int = PRICE_BUCKET,
) -> Column:
    """MD5 over the attributes that identify a property across sources.

    ``concat_ws`` would skip nulls and shift the parts, hence the coalesces.
    """
    parts = [
        F.lower(F.coalesce(city, F.lit(""))),
        F.lower(F.coalesce(street, F.lit(""))),
        float_text(F.coalesce(rooms, F.lit(0.0))),
        price_bucket(F.coalesce(price, F.lit(0.0)), bucket_size).cast("string"),
        F.coalesce(deal_type, F.lit("")),
    ]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))
