"""Numeric helpers: exact decimal amounts and guarded ratios."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_decimal(x, precision: int, scale: int) -> Column:
    return _c(x).cast(f"decimal({precision},{scale})")


def amount(x, precision: int = 14, scale: int = 2) -> Column:
    """Money column as an exact decimal (sums stay exact)."""
    return to_decimal(x, precision, scale)


def pct(num, den, scale: int = 2) -> Column:
    """num / den * 100 rounded once, NULL when den is 0 or NULL.

    Computed in double and rounded at the end so that engines that divide
    decimals as double give the same digits.
    """
    d = _c(den).cast("double")
    return F.round(_c(num).cast("double") / F.nullif(d, F.lit(0.0)) * 100.0, scale)


def safe_pct(num, den, scale: int = 2) -> Column:
    """pct() with 0 instead of NULL when the denominator is 0."""
    return F.coalesce(pct(num, den, scale), F.lit(0.0))


def half_sum(a, b, precision: int = 10, scale: int = 2) -> Column:
    """(a + b) / 2 as decimal(precision, scale) - exact for integers."""
    return ((_c(a) + _c(b)).cast("decimal(20,0)") / F.lit(2)).cast(
        f"decimal({precision},{scale})")


def exact_pct(num, den, scale: int, kind: str, times_first: bool = False) -> Column:
    """A percentage as decimal arithmetic with a fixed scale gives it: the quotient
    is cut off after ``scale`` digits, multiplied by 100 (``times_first``: before
    the division), and rounded half away from zero to the two digits of ``kind``.
    NULL when ``den`` is 0 or NULL, or if the result does not fit ``kind``.

    ``num`` and ``den`` have at most two decimals and are compared in cents, so
    every step is exact."""
    n, d = ((_c(x).cast("decimal(20,2)") * 100).cast("decimal(20,0)") for x in (num, den))
    unit = 10 ** (scale - 2)
    with_factor = n * F.lit(Decimal((100 if times_first else 1) * 10 ** scale)).cast(f"decimal({scale + 3},0)")
    whole = F.call_function("div", F.abs(with_factor), F.nullif(F.abs(d), F.lit(Decimal(0))))
    cents = F.call_function("div", whole.cast("decimal(28,0)") * (1 if times_first else 100) + unit // 2,
                            F.lit(Decimal(unit)))
    signed = F.when(n * d < 0, -cents).otherwise(cents)
    return (signed.cast("decimal(20,0)") / F.lit(Decimal(100))).try_cast(kind)
