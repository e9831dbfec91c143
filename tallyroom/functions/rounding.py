"""Rounding that gives the same digits on every engine and every partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two-digit money as DOUBLE, rounded half up on an exact decimal.

    For sums and differences. A mean or ratio has no exact decimal: ``mean2`` rounds it once.
    """
    return F.round(value.cast("decimal(38,6)"), 2).cast("double")


def mean2(total: Column, n: Column, scale: int = 2) -> Column:
    """``total / n`` in two digits as DOUBLE, rounded half up once, on whole numbers.

    ``total`` is a decimal in units of ``10 ** -scale``; ``n`` is a count, and 0 gives NULL.
    """
    cent = (F.nullif(n, F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(10 ** (scale - 2)))).cast("decimal(38,0)")
    twice = (F.abs(total).cast("decimal(38,0)") * 2).cast("decimal(38,0)")
    cents = F.call_function("div", twice + cent, cent * 2)
    return F.signum(total.cast("double")) * cents / 100.0


def cents(money: Column) -> Column:
    """Two-digit money in whole cents."""
    return (money * 100).cast("decimal(38,0)")


def whole_pct(part: Column, whole: Column) -> Column:
    """Share in whole percent, half to even; 0 when there is nothing to share."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100
    return F.coalesce(F.rint(share).cast("bigint"), F.lit(0).cast("bigint"))


def py_round1(value: Column) -> Column:
    """One decimal digit, rounded on the exact binary value with ties to even.

    ``round`` and ``bround`` decide on the printed digits of a double and call a tie where the
    stored number lies just beside it. Here only the product ``10 * value`` can be inexact, and
    it matters only when it lands on a half: then its error, which the sum below yields without
    any rounding, tells on which side the stored number is.
    """
    tenfold = value * 10.0
    error = (value * 8.0 - tenfold) + value * 2.0
    on_half = tenfold - F.floor(tenfold) == 0.5
    beside = F.when(on_half, tenfold + F.signum(error) * 0.25).otherwise(tenfold)
    return F.rint(beside) / 10.0
