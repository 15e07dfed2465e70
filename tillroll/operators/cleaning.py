"""Row filters and in-place column changes of the cleaning stage."""

from collections.abc import Callable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.scalars import date_or_today


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where every given column is present: not NULL and, for floats, not NaN.

    Same rows as ``na.drop``, but written as plain predicates so that ``IsNotNull`` reaches the scan.
    """
    return df.filter(all_present(df, *columns)) if columns else df


def all_present(df: DataFrame, *columns: str) -> Column:
    """Whether a row has all the given columns: what :func:`drop_missing` keeps."""
    return reduce(lambda a, b: a & b, (_present(df, c) for c in columns))


def _present(df: DataFrame, column: str) -> Column:
    here = F.col(column).isNotNull()
    if isinstance(df.select(column).schema[0].dataType, (T.DoubleType, T.FloatType)):
        here = here & ~F.isnan(column)
    return here


def normalize(df: DataFrame, changes: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Replace each named column by a function of itself."""
    return df.withColumns({c: change(F.col(c)) for c, change in changes.items()})


def add_load_date(df: DataFrame, as_of: date | None = None) -> DataFrame:
    """Add ``load_date``: the given day, or today."""
    return df.withColumn("load_date", date_or_today(as_of))
