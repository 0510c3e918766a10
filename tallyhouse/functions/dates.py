"""Date helpers: smart keys, strict parsing, calendar names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(text, fmt: str = "yyyy-MM-dd") -> Column:
    """Strict text -> date; NULL when the text does not match ``fmt``.

    ``try_cast('2024-01' as date)`` yields a date in Spark, so a format is
    given explicitly to reject partial dates.
    """
    return F.try_to_date(_c(text), fmt)


def date_key(d) -> Column:
    """Integer YYYYMMDD key of a date (NULL stays NULL)."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(d) -> Column:
    """Integer YYYYMM of a date."""
    d = _c(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def first_of_month(year, month) -> Column:
    """Date of the first day of (year, month); NULL if either is NULL."""
    return F.make_date(_c(year), _c(month), F.lit(1))


def iso_weekday(d) -> Column:
    """Monday = 1 ... Sunday = 7, independent of locale settings."""
    return (F.weekday(_c(d)) + 1).cast("int")


def _pick(names: list[str], index_1_based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index_1_based)


def month_name(d) -> Column:
    return _pick(C.MONTH_NAMES, F.month(_c(d)))


def month_short_name(d) -> Column:
    return _pick(C.MONTH_SHORT_NAMES, F.month(_c(d)))


def weekday_name(d) -> Column:
    return _pick(C.WEEKDAY_NAMES, iso_weekday(d))


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` on wall-clock values (no time
    zone, so a daylight-saving session zone cannot shift the result)."""
    return F.timestamp_diff("SECOND", _c(start).cast("timestamp_ntz"),
                            _c(end).cast("timestamp_ntz")).cast("long")
