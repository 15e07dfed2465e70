"""Segment labels. NULL compares as unknown, so it falls through to the last label."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cut-offs and labels every report consumer knows.
HIGH_VALUE_FROM = 1000
MEDIUM_VALUE_FROM = 500
FREQUENT_FROM = 10
REGULAR_FROM = 5


def value_segment(spent: Column, high: float = HIGH_VALUE_FROM, medium: float = MEDIUM_VALUE_FROM) -> Column:
    """'High Value' from ``high`` up, 'Medium Value' from ``medium`` up, else 'Low Value'."""
    return F.when(spent >= high, "High Value").when(spent >= medium, "Medium Value").otherwise("Low Value")


def frequency_segment(transactions: Column, frequent: int = FREQUENT_FROM, regular: int = REGULAR_FROM) -> Column:
    """Label by number of transactions; the bounds in the label text follow the cut-offs."""
    return (
        F.when(transactions >= frequent, f"Frequent ({frequent}+ transactions)")
        .when(transactions >= regular, f"Regular ({regular}-{frequent - 1} transactions)")
        .otherwise(f"Occasional (1-{regular - 1} transactions)")
    )
