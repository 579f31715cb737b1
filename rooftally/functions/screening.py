"""Rejection reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MIN_PRICE, OUTLIER_SIGMA, SPAM_KEYWORDS
from .pytext import float_text


def keyword_hit(text: Column, keywords: Sequence[str] = SPAM_KEYWORDS) -> Column:
    """First of ``keywords`` contained in the lower-cased text; else null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(word)), F.lit(word)) for word in keywords])


def spam_reason(
    city: Column, price: Column, lowered_description: Column,
    min_price: float = MIN_PRICE, keywords: Sequence[str] = SPAM_KEYWORDS,
) -> Column:
    """Why a listing is spam (city, then price, then wording), or null when it is not."""
    low_price = F.concat(
        F.lit("price too low ("), F.coalesce(float_text(price), F.lit("None")), F.lit(")")
    )
    # Concatenation with a null is null, so without a hit there is no reason.
    wording = F.concat(
        F.lit("spam keyword detected: '"), keyword_hit(lowered_description, keywords), F.lit("'")
    )
    return (
        F.when(F.coalesce(city, F.lit("")) == "", F.lit("missing city"))
        .when(F.coalesce(price, F.lit(0.0)) < min_price, low_price)
        .otherwise(wording)
    )


def outlier_reason(value: Column, mean: Column, sigma: Column, n_sigma: float = OUTLIER_SIGMA) -> Column:
    """Text naming the value and the fence it fell outside of, without decimals.

    ``rint`` first, because ``%.0f`` rounds halves up here and to even in Python.
    """
    low, high = mean - F.lit(n_sigma) * sigma, mean + F.lit(n_sigma) * sigma
    return F.format_string(
        f"price outlier: %.0f is outside μ±{float(n_sigma)}σ = [%.0f, %.0f]",
        F.rint(value), F.rint(low), F.rint(high),
    )
