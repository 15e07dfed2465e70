"""Column expressions: scalars, segments, money and aggregates."""

from tillroll.functions.aggregates import (
    bitmap_bucket,
    bitmap_of,
    count_where,
    distinct_count,
    int_avg,
    mean_amount,
    mean_money,
    ratio_of_sums,
    row_count,
    total_amount,
    total_money,
    total_units,
    value_count,
)
from tillroll.functions.money import (
    count_from,
    holds_whole,
    line_amount,
    line_parts,
    money_parts,
    money_units,
    sums_of,
    total_from,
    total_of,
    units_to_double,
)
from tillroll.functions.scalars import date_or_today, days_between, epoch_micros_to_ts, share_pct, whole_div
from tillroll.functions.segments import frequency_segment, value_segment

__all__ = [
    "bitmap_bucket",
    "bitmap_of",
    "count_from",
    "count_where",
    "date_or_today",
    "days_between",
    "distinct_count",
    "epoch_micros_to_ts",
    "frequency_segment",
    "holds_whole",
    "int_avg",
    "line_amount",
    "line_parts",
    "mean_amount",
    "mean_money",
    "money_parts",
    "money_units",
    "ratio_of_sums",
    "row_count",
    "share_pct",
    "sums_of",
    "total_amount",
    "total_from",
    "total_money",
    "total_of",
    "total_units",
    "units_to_double",
    "value_count",
    "value_segment",
    "whole_div",
]
