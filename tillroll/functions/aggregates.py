"""Aggregate expressions. All but the exact distinct count combine on the map side into fixed-width buffers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.money import line_parts, money_parts, total_of
from tillroll.functions.scalars import whole_div


def row_count() -> Column:
    """Number of rows."""
    return F.count(F.lit(1))


def value_count(value: Column) -> Column:
    """Number of rows where ``value`` isn't NULL."""
    return F.count(value)


def count_where(predicate: Column) -> Column:
    """Number of rows where ``predicate`` holds; unknown doesn't count."""
    return F.count(F.when(predicate, F.lit(1)))


def distinct_count(value: Column, rsd: float | None = None) -> Column:
    """Exact distinct count, or, only where ``rsd`` is given, an estimate with that relative error.

    The exact count shuffles one row per (group, value); the estimate shuffles one sketch per group and task.
    """
    return F.count_distinct(value) if rsd is None else F.approx_count_distinct(value, rsd)


def bitmap_bucket(value: Column) -> Column:
    """Which bitmap of 32768 whole numbers a value belongs to."""
    return F.bitmap_bucket_number(value)


def bitmap_of(value: Column) -> Column:
    """Bitmap of the values of one bucket; bitmaps of a bucket are united by ``bitmap_or_agg`` and counted exactly."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(value))


def total_money(amount: Column) -> Column:
    """Sum of a money column; exact for up to four decimals, and without a cut for others."""
    return total_of(money_parts(amount))


def mean_money(amount: Column) -> Column:
    """Plain mean of a money column over the rows where it is present, from :func:`total_money`."""
    return F.try_divide(total_money(amount), F.count(amount))


def total_amount(quantity: Column, unit_price: Column, *, whole: bool = False) -> Column:
    """Sum of quantity times price; exact where both have up to four decimals, and without a cut for others.

    ``whole`` tells that quantities have no fraction, which needs fewer sums.
    """
    return total_of(line_parts(quantity, unit_price, whole=whole))


def mean_amount(quantity: Column, unit_price: Column, *, whole: bool = False) -> Column:
    """Mean of quantity times price over the rows where both are present, from :func:`total_amount`."""
    parts = line_parts(quantity, unit_price, whole=whole)
    return F.try_divide(total_of(parts), F.count(parts[0]))


def total_units(df: DataFrame, column: str) -> Column:
    """Sum of a column of counts: whole numbers as ``bigint``, doubles as money is summed."""
    is_double = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return total_money(F.col(column)) if is_double else F.sum(column)


def int_avg(value: Column) -> Column:
    """Average of whole numbers, truncated toward zero, as ``bigint``; NULL over no values."""
    return whole_div(F.sum(value), F.count(value))


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """Sum over sum; NULL where the denominator's sum is zero."""
    return F.try_divide(F.sum(numerator), F.sum(denominator))
