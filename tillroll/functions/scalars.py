"""Scalar expressions of the report layer."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS_PER_SECOND = 1_000_000


def whole_div(dividend: Column, divisor: Column) -> Column:
    """Integer division that truncates toward zero, as ``bigint``."""
    return F.call_function("div", dividend, divisor)


def epoch_micros_to_ts(micros: Column) -> Column:
    """Microseconds since the epoch as a timestamp; the fraction of a second is dropped."""
    return F.timestamp_seconds(whole_div(micros, F.lit(_MICROS_PER_SECOND)))


def days_between(start: Column, end: Column) -> Column:
    """Day boundaries crossed from ``start`` to ``end``: 23:00 to 01:00 the next day is 1."""
    return F.datediff(end, start)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up; NULL where ``whole`` is zero."""
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def date_or_today(as_of: date | None) -> Column:
    """The given day as a literal, or the current date."""
    return F.current_date() if as_of is None else F.lit(as_of)
