"""Flags and the discount rule."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillflow import fixed_values as V


def yes_no_flag(word: Column) -> Column:
    """`yes` is true, `no` is false, anything else is null."""
    return F.when(word == V.ONLINE_WORD, F.lit(True)).when(word == V.OFFLINE_WORD, F.lit(False))


def offer_flag(text: Column) -> Column:
    """Text as a boolean; empty or unreadable means the offer was not used."""
    return F.coalesce(text.try_cast("boolean"), F.lit(False))


def discount_percentage(offers: Mapping[str, Column]) -> Column:
    """Percent of the first offer that is set, 0 when none is; `offers` maps offer name to flag."""
    return F.coalesce(
        *[F.when(offers[name], F.lit(percent)) for name, percent in V.OFFER_DISCOUNTS.items()],
        F.lit(V.NO_DISCOUNT),
    )
