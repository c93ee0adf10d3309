"""Prices and order-independent sums."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = 1_000_000
_ONE_MICRO = Decimal("0.000001")
# Amounts from here on have no whole units in a long.
_TOO_LARGE = 2.0**63


def total_paid_price(units: Column, unit_price: Column, discount: Column) -> Column:
    """Price of a sales line after the discount."""
    return units * unit_price * (1 - discount / 100)


def exact_sum(amount: Column) -> Column:
    """Sum of a finite double column to the millionth, as decimal(28,6); null beyond the longs.

    A plain double sum depends on the order in which tasks finish. Here whole
    units and millionths are summed as two longs, so the result is the same on
    every run, the aggregate stays a code-generated hash aggregate without
    decimal objects per row, and a third of 10^12 rows in one group still fits.
    """
    whole = F.floor(amount)
    micros = F.floor((amount - whole) * _MICROS + 0.5)
    total = F.try_sum(whole).cast("decimal(20,0)") + F.try_sum(micros).cast(
        "decimal(20,0)"
    ) * F.lit(_ONE_MICRO)
    return F.when(F.max(F.abs(amount)) < _TOO_LARGE, total.cast("decimal(28,6)"))


def amount_sum(amount: Column) -> Column:
    """Sum of a finite double column as a double: the exact one, or beyond the longs the plain one."""
    return F.coalesce(exact_sum(amount).cast("double"), F.sum(amount))


def partial_sums(amount: Column) -> list[Column]:
    """Sums to be summed again by `total_of_sums`."""
    return [exact_sum(amount).alias("exact_paid"), F.sum(amount).alias("plain_paid")]


def total_of_sums(as_double=lambda amount: amount.cast("double")) -> Column:
    """Sum of `partial_sums`, exact where all of them are; `as_double` may round it."""
    all_exact = F.count("exact_paid") == F.count("plain_paid")
    return F.when(all_exact, as_double(F.sum("exact_paid"))).otherwise(as_double(F.sum("plain_paid")))


def to_cents(amount: Column) -> Column:
    """Exact amount rounded half up to two places, as a double."""
    return F.round(amount, 2).cast("double")
