"""Gold to reports. Each report reads gold (one row per customer or subcategory), never the transactions."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.aggregates import count_where, int_avg, mean_money, row_count, total_money, total_units
from tillroll.functions.scalars import date_or_today, days_between, epoch_micros_to_ts
from tillroll.functions.segments import (
    FREQUENT_FROM,
    HIGH_VALUE_FROM,
    MEDIUM_VALUE_FROM,
    REGULAR_FROM,
    frequency_segment,
    value_segment,
)
from tillroll.operators.ordering import order_desc
from tillroll.operators.windows import partition_share


def customer_segment_value(
    cm: DataFrame, high: float = HIGH_VALUE_FROM, medium: float = MEDIUM_VALUE_FROM
) -> DataFrame:
    """Customers per value segment, highest average spend first. NULL ``total_spent`` counts as 'Low Value'."""
    segments = (
        cm.withColumn("customer_segment", value_segment(F.col("total_spent"), high, medium))
        .groupBy("customer_segment")
        .agg(
            row_count().alias("customer_count"),
            mean_money(F.col("total_spent")).alias("avg_spent"),
            int_avg(F.col("total_transactions")).alias("avg_transactions"),
        )
    )
    return order_desc(segments, "avg_spent")


def customer_activity_analysis(cm: DataFrame, as_of: date | None = None, days: int = 90) -> DataFrame:
    """One row: customers in all, active and inactive by last purchase, and mean days from first to last purchase.

    Counts customers with at least one transaction, since gold holds no others. A NULL ``last_purchase`` is neither
    active nor inactive. ``first_purchase`` and ``last_purchase`` may be timestamps or epoch microseconds (bigint).
    The column names keep the 90 of the default whatever ``days`` is, since the report table fixes them.
    """
    first, last = _moment(cm, "first_purchase"), _moment(cm, "last_purchase")
    idle_days = days_between(last, date_or_today(as_of))
    return cm.agg(
        row_count().alias("total_customers"),
        count_where(idle_days <= days).alias("active_90_days"),
        count_where(idle_days > days).alias("inactive_90_days"),
        int_avg(days_between(first, last)).alias("avg_customer_lifespan"),
    )


def _moment(df: DataFrame, column: str) -> Column:
    is_micros = isinstance(df.select(column).schema[0].dataType, T.LongType)
    return epoch_micros_to_ts(F.col(column)) if is_micros else F.col(column)


def category_performance_analysis(pm: DataFrame) -> DataFrame:
    """Roll-up of product metrics per category, largest revenue first.

    ``total_customers`` is the sum of the subcategories' distinct counts, so a customer of two subcategories counts
    twice. ``category_avg_price`` is the unweighted mean of the subcategories' means. Both are meant so.
    """
    rolled = pm.groupBy("category").agg(
        total_money(F.col("total_revenue")).alias("category_revenue"),
        total_units(pm, "total_units_sold").alias("category_units"),
        F.sum("unique_customers").alias("total_customers"),
        F.avg("avg_price").alias("category_avg_price"),
        F.try_divide(total_money(F.col("total_revenue")), F.sum("unique_customers")).alias("revenue_per_customer"),
    )
    return order_desc(rolled, "category_revenue")


def top_performing_subcategories(pm: DataFrame, n: int | None = None) -> DataFrame:
    """Every subcategory with its share of the category's revenue in percent, largest revenue first.

    All rows unless ``n`` is given. The share is NULL where the category's revenue is zero.
    """
    rows = pm.select("category", "subcategory", "total_revenue", "total_units_sold")
    shares = partition_share(rows, "total_revenue", ["category"], "category_revenue_share")
    return order_desc(shares, "total_revenue", n)


def customer_purchase_frequency(
    cm: DataFrame, frequent: int = FREQUENT_FROM, regular: int = REGULAR_FROM
) -> DataFrame:
    """Customers per purchase-frequency segment. ``avg_transaction_value`` is a mean of the customers' means."""
    return (
        cm.withColumn("frequency_segment", frequency_segment(F.col("total_transactions"), frequent, regular))
        .groupBy("frequency_segment")
        .agg(
            row_count().alias("customer_count"),
            mean_money(F.col("total_spent")).alias("avg_total_spent"),
            F.avg("avg_transaction_amount").alias("avg_transaction_value"),
        )
    )
