"""Money rules. Amounts are doubles in the rows and whole cents inside sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def cents(amount: Column) -> Column:
    """Whole cents, halves rounded up (``round`` would round the decimal text instead)."""
    return F.floor(amount * 100 + 0.5).cast("bigint")


def round_cents(amount: Column) -> Column:
    return cents(amount) / 100


def line_amount(number: Column, price: Column) -> Column:
    return number * price


def money_sum(amount: Column) -> Column:
    """Sum in decimals, so that the result depends on no row order."""
    return F.sum(amount.cast(MONEY))
