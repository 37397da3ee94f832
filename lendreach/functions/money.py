"""Amounts, limits and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pay periods per month by pay frequency.
PERIODS = {"B": 2.16667, "S": 2.0, "W": 4.3333, "M": 1.0}
FLAT_LIMIT = 255


def step_up(c: Column, step: int = 25) -> Column:
    """Round up to the next multiple of ``step``."""
    return F.ceil(c / step) * step


def capped(c: Column, cap: Column) -> Column:
    """Smaller of the two; null when either is null."""
    return F.when(c.isNull() | cap.isNull(), None).otherwise(F.least(c, cap))


def rate_limit(pay: Column, rate: Column, cap: Column) -> Column:
    """Pay times rate, rounded up to 25, capped."""
    return capped(step_up(pay * rate).cast("double"), cap.cast("double"))


def max_limit(pay: Column, rate: Column, cap: Column, default: int = 1000) -> Column:
    return F.coalesce(rate_limit(pay, rate, cap), F.lit(float(default)))


def per_period(income: Column, frequency: Column) -> Column:
    """Monthly income split by pay frequency; null for an unknown frequency."""
    out = None
    for code, n in PERIODS.items():
        value = income.cast("double") / F.lit(n)
        out = F.when(frequency == code, value) if out is None else out.when(frequency == code, value)
    return out


def next_limit(product: Column, income: Column, frequency: Column, rate: Column, cap: Column,
               flat_products: Sequence[str]) -> Column:
    """Limit of the following loan; a flat amount for the flat products."""
    return F.when(product.isin(list(flat_products)), F.lit(float(FLAT_LIMIT))).otherwise(
        rate_limit(per_period(income, frequency), rate.cast("double"), cap))


def recency_group(days: Column) -> Column:
    return F.when(days <= 45, "GC Active").when(days <= 180, "GC Engaged").when(
        days > 180, "GC Dormant")


def credit_band(available: Column, limit: Column, lowest: int, step: int = 10) -> Column:
    """Text band of available over total credit, in steps down to ``lowest`` percent."""
    out = F.when(available >= limit, "100%")
    for pct in range(100 - step, lowest - 1, -step):
        floor = F.lit(pct).cast("decimal(5,0)") / 100
        out = out.when(available >= floor * limit, f"{pct}%-{pct + step - 1}%")
    return out.otherwise(f"<{lowest}%")


def bid_band(c: Column, step: int = 10, top: int = 40) -> Column:
    """$3-$10, $11-$20 ... then an open band; null stays null."""
    out = F.when(c <= step, f"$3-${step}")
    for hi in range(2 * step, top + 1, step):
        out = out.when(c <= hi, f"${hi - step + 1}-${hi}")
    return out.when(c > top, f"${top + 1}+")


def rate(num: Column, den: Column) -> Column:
    """Quotient as double; null for a zero or missing denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))
