"""Money arithmetic that is exact for prices and quantities of up to four decimals and cuts no digits of others.

Sums of doubles change in the last digit with the order of the rows. So an amount is split into a whole number of 1/10000
currency units (``bigint``) and what the rounding leaves (``double``). The whole parts are summed exactly, in pieces
that can't overflow; the rests are summed as doubles, and are 0.0 for prices of up to four decimals. The
finished total is the sum of both. An amount that is NaN, infinite or beyond 2.8e10 has no whole part: all of it is rest.

A quantity with a fraction is split alike, into whole units, a whole number of 1/10000 and a rest. Its product with a
price is then the whole units times the price's, the fraction times the price's (in 1/10 ** 8, a ``bigint`` of its own),
and the products with the rests. Nothing here depends on ANSI mode.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_DIGITS = 4
_SCALE = 10**MONEY_DIGITS
_UNIT = float(_SCALE)
_LARGEST = float(1 << 48)  # units; larger amounts are rest
_WHOLE_IN_DOUBLE = float(1 << 53)
_HALF_BITS, _THIRD_BITS = 24, 21


def holds_whole(df: DataFrame, column: str) -> bool:
    """Whether a column's type has no fractions, which makes :func:`line_parts` cheaper."""
    return isinstance(df.schema[column].dataType, T.IntegralType)


def money_units(price: Column) -> Column:
    """The whole part of a price, in 1/10000 units; 0 where it is not finite or too large, NULL where it is NULL."""
    price = price.cast("double")
    fits = F.abs(price) < F.lit(_LARGEST / _UNIT)
    return F.when(fits, F.rint(price * F.lit(_UNIT)).cast("bigint")).when(price.isNotNull(), F.lit(0).cast("bigint"))


def units_to_double(units: Column) -> Column:
    """A (summed) number of 1/10000 units as ``double``."""
    return units.cast("double") / F.lit(_UNIT)


def money_parts(price: Column) -> tuple[Column, Column]:
    """A price as its whole units and the rest."""
    price = price.cast("double")
    units = money_units(price)
    return units, price - units_to_double(units)


def line_parts(quantity: Column, unit_price: Column, *, whole: bool = False) -> tuple[Column, Column] | tuple[Column, Column, Column]:
    """A line amount, quantity times price, as its whole units, its 1/10 ** 8 units and the rest.

    With ``whole`` the caller knows that quantities have no fraction (:func:`holds_whole`); there are no 1/10 ** 8 then.
    """
    price, number = unit_price.cast("double"), quantity.cast("double")
    amount, units, zero = number * price, money_units(price), F.lit(0).cast("bigint")
    fits = (F.abs(price) < F.lit(_LARGEST / _UNIT)) & (F.abs(amount) < F.lit(_LARGEST / _UNIT))
    price_rest = price - units_to_double(units)
    if whole:
        coarse = F.when(fits, quantity.cast("bigint") * units).when(amount.isNotNull(), zero)
        return coarse, F.when(fits, number * price_rest).otherwise(amount)
    split = F.abs(number) < F.lit(_LARGEST / _UNIT)
    entire = (F.abs(number) < F.lit(_WHOLE_IN_DOUBLE)) & (number == F.rint(number))
    counted = F.when(split, F.rint(number * F.lit(_UNIT)).cast("bigint"))  # the quantity in 1/10000
    ones = F.when(split, F.call_function("div", counted, F.lit(_SCALE))).when(entire, number.cast("bigint"))
    parts = F.when(split, counted % _SCALE).when(entire, zero)
    known = F.when(split, units_to_double(counted)).when(entire, number)
    fits = fits & (split | entire)
    coarse = F.when(fits, ones * units).when(amount.isNotNull(), zero)
    fine = F.when(fits, parts * units).when(amount.isNotNull(), zero)
    return coarse, fine, F.when(fits, (number - known) * price + known * price_rest).otherwise(amount)


def sums_of(parts: tuple[Column, ...]) -> list[Column]:
    """Aggregates: fixed-width sums of amounts given in parts, which can be added up again; see :func:`total_from`.

    Two halves of the whole units, three thirds of the 1/10 ** 8 if there are any, and the rest: none of the whole ones
    can overflow before 2 ** 39 rows.
    """
    coarse, *fine, rest = parts
    sums = [F.sum(F.shiftright(coarse, _HALF_BITS)), F.sum(coarse.bitwiseAND(F.lit((1 << _HALF_BITS) - 1)))]
    for part in fine:
        third = F.lit((1 << _THIRD_BITS) - 1)
        sums += [F.sum(F.shiftright(part, 2 * _THIRD_BITS))]
        sums += [F.sum(F.shiftright(part, k * _THIRD_BITS).bitwiseAND(third)) for k in (1, 0)]
    return [*sums, F.sum(rest)]


def total_from(sums: list[Column]) -> Column:
    """The total that :func:`sums_of`, or sums of such sums, add up to; NULL over no amounts."""
    high, low, *fine, rest = sums
    coarse = _joined([high, low], _HALF_BITS)
    if not fine:
        return units_to_double(coarse) + rest
    scale = F.lit(_SCALE).cast("decimal(5,0)")
    every = coarse.cast("decimal(33,0)") * scale + _joined(fine, _THIRD_BITS).cast("decimal(37,0)")
    small = every % scale
    return units_to_double((every - small) / scale) + small.cast("double") / F.lit(_UNIT * _UNIT) + rest


def count_from(sums: list[Column]) -> Column:
    """As :func:`total_from`, as ``bigint``, for amounts that are whole numbers."""
    high, low, rest = sums
    return (_joined([high, low], _HALF_BITS) / F.lit(_SCALE).cast("decimal(5,0)")).cast("bigint") + rest.cast("bigint")


def _joined(pieces: list[Column], bits: int) -> Column:
    total, *others = (p.cast("decimal(38,0)") for p in pieces)
    for piece in others:
        total = total * F.lit(1 << bits).cast("decimal(10,0)") + piece
    return total


def total_of(parts: tuple[Column, ...]) -> Column:
    """Aggregate: the sum of amounts given in parts; NULL over no amounts."""
    return total_from(sums_of(parts))


def line_amount(quantity: Column, unit_price: Column, *, whole: bool = False) -> Column:
    """Line amount, quantity times price, as ``double``."""
    coarse, *fine, rest = line_parts(quantity, unit_price, whole=whole)
    if not fine:
        return units_to_double(coarse) + rest
    carried = coarse + F.call_function("div", fine[0], F.lit(_SCALE))
    return units_to_double(carried) + (fine[0] % _SCALE).cast("double") / F.lit(_UNIT * _UNIT) + rest
