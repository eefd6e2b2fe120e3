"""Prices and points, always in decimals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Upper ends of the price bands, the points rate, the word for "no card".
BAND_LIMITS = (("low", 10), ("medium", 25), ("high", 50))
TOP_BAND = "very_high"
POINTS_PER_PRICE = 10
NO_CARD = "null"

MONEY = "decimal(18,2)"


def floor2(value: Column) -> Column:
    """Round down to two places, negatives away from zero."""
    return F.floor(value, F.lit(2)).cast(MONEY)


def price_band(price: Column) -> Column:
    band = F.lit(TOP_BAND)
    for name, limit in reversed(BAND_LIMITS):
        band = F.when(price <= F.lit(limit), F.lit(name)).otherwise(band)
    return band


def is_member(card: Column) -> Column:
    """A customer without a card carries the word ``null`` as card number."""
    return card != F.lit(NO_CARD)


def reward_points(member: Column, total: Column) -> Column:
    zero = F.lit(0).cast(MONEY)
    return F.when(member, floor2(total / F.lit(POINTS_PER_PRICE))).otherwise(zero)


def spend_cap(balance: Column, total: Column) -> Column:
    """The most points an order can use: no more than held, no more than its price."""
    return floor2(F.least(balance, total))
