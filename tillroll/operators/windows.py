"""Totals and shares within a partition.

The totals are a plain aggregate, combined before its shuffle, and are joined back to the rows: a partition that holds a
third of all rows is never brought together in one task. Both sides of that join read the same columns, so Spark sees
that they begin with the same steps and runs what lies before their first shuffle once, also over rows that are not
written yet.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.aggregates import total_money
from tillroll.functions.scalars import share_pct

_TOTAL = "_partition_total"


def partition_total(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Add the sum of ``value`` over the whole partition; NULL keys form a partition. Doubles are summed as money."""
    return _with_total(df, value, by).withColumnRenamed(_TOTAL, name)


def partition_share(df: DataFrame, value: str, by: Sequence[str], name: str, digits: int = 2) -> DataFrame:
    """Add ``value`` as a percentage of its partition's total; NULL where the total is zero."""
    rows = _with_total(df, value, by)
    return rows.withColumn(name, share_pct(F.col(value), F.col(_TOTAL), digits)).drop(_TOTAL)


def _with_total(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    is_double = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    total = total_money(F.col(value)) if is_double else F.sum(value)
    keys = {c: f"_key_{i}" for i, c in enumerate(by)}
    counts = [F.count(c).alias(f"_count_{i}") for i, c in enumerate(df.columns)]
    totals = df.groupBy(*(F.col(c).alias(k) for c, k in keys.items())).agg(total.alias(_TOTAL), *counts)
    read = reduce(and_, (F.col(f"_count_{i}") >= 0 for i in range(len(counts))))  # holds always, but keeps the columns
    totals = totals.where(read).select(*keys.values(), _TOTAL)
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    return df.join(totals, same, "left").drop(*keys.values())
