"""Money, rounding and percentages with results that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Single amounts have up to 14 digits before the point, sums of them and sums of such
# sums up to 34: exact in any order, and a decimal that overflows fails the job (ANSI).
AMOUNT = "decimal(18,4)"
TOTAL = "decimal(28,4)"


def finite(amount: Column) -> Column:
    return ~(F.isnan(amount) | (F.abs(amount) == float("inf")))


def money_sum(amount: Column, kind: str = AMOUNT, times: Column | None = None) -> Column:
    """Exact sum as a double; ``kind=TOTAL`` for amounts that are themselves sums.

    ``times`` counts each amount that often. A NaN or an infinity makes the sum so.
    """
    amount = amount.cast("double")
    exact = F.when(finite(amount), amount).cast(kind)
    plain = amount if times is None else amount * times
    exact = exact if times is None else exact * times
    odd = ~finite(amount)
    return F.when(F.bool_or(odd), F.sum(F.when(odd, plain))).otherwise(F.sum(exact).cast("double"))


def money_avg(amount: Column, kind: str = AMOUNT) -> Column:
    return money_sum(amount, kind) / F.count(amount)


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Half-up rounding in double arithmetic, the same in every SQL engine."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` as a rounded double; null when ``whole`` is 0."""
    return round_half_up(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)
