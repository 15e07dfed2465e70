"""Gold from mergeable daily states.

A state holds what one day's transactions add to the metrics: sums in pieces that can be added up (see
:func:`tillroll.functions.money.sums_of`), counts, first and last moments, and the customers of each product as bitmaps.
Gold is the sum of the states of all days. So a day that is run again replaces its own state, and nothing but that day's
transactions is read. The names of the products are joined with the states, not with the transactions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.aggregates import bitmap_bucket, bitmap_of, value_count
from tillroll.functions.money import count_from, holds_whole, line_parts, money_parts, sums_of, total_from

SHORT, LONG = 3, 6  # pieces of a sum of values, and of one of products


def _pieces(name: str, n: int) -> list[str]:
    return [f"{name}_{i}" for i in range(n)]


def _sums(name: str, parts: tuple[Column, ...]) -> list[Column]:
    return [c.alias(f"{name}_{i}") for i, c in enumerate(sums_of(parts))]


def _added(name: str, n: int) -> list[Column]:
    """Aggregates that add up the pieces of several states."""
    return [F.sum(c) for c in _pieces(name, n)]


def customer_state(tx: DataFrame) -> DataFrame:
    """One row per ``customer_id``: what :func:`merged_customers` needs of these transactions."""
    amount = line_parts(F.col("quantity"), F.col("unit_price"))
    return tx.groupBy("customer_id").agg(
        value_count(F.col("transaction_id")).alias("transactions"),
        *_sums("spent", amount),
        F.count(amount[0]).alias("amounts"),
        F.min("transaction_date").alias("first_purchase"),
        F.max("transaction_date").alias("last_purchase"),
    )


def merged_customers(states: DataFrame) -> DataFrame:
    """``customer_metrics`` from the customer states of all days."""
    spent = total_from(_added("spent", LONG))
    return states.groupBy("customer_id").agg(
        F.sum("transactions").alias("total_transactions"),
        spent.alias("total_spent"),
        F.try_divide(spent, F.sum("amounts")).alias("avg_transaction_amount"),
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
    )


def product_state(tx: DataFrame) -> DataFrame:
    """One row per ``product_id``: the sums that :func:`merged_products` needs of these transactions."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    return tx.where("product_id IS NOT NULL").groupBy("product_id").agg(
        *_sums("units", money_parts(quantity)),
        *_sums("revenue", line_parts(quantity, price)),
        *_sums("price", money_parts(price)),
        F.count(price).alias("prices"),
    )


def product_customers(tx: DataFrame) -> DataFrame:
    """The distinct customers of each product: as bitmaps of 32768 ids where ids are whole numbers, else one row each."""
    known = tx.where("product_id IS NOT NULL AND customer_id IS NOT NULL")
    if not holds_whole(tx, "customer_id"):
        return known.select("product_id", "customer_id").distinct()
    customer = F.col("customer_id")
    return known.groupBy("product_id", bitmap_bucket(customer).alias("bucket")).agg(bitmap_of(customer).alias("customers"))


def merged_products(states: DataFrame, customers: DataFrame, names: DataFrame, *, whole_units: bool) -> DataFrame:
    """``product_metrics`` from the states of all days.

    ``names`` has category and subcategory by ``product_id``, or by ``product_id`` and ``load_date`` where each day's
    transactions have their own. ``whole_units`` tells that quantities have no fraction.
    """
    keys = [c for c in ("product_id", "load_date") if c in names.columns]
    by = ["category", "subcategory"]
    units = _added("units", SHORT)
    sums = states.join(names, keys).groupBy(*by).agg(
        (count_from(units) if whole_units else total_from(units)).alias("total_units_sold"),
        total_from(_added("revenue", LONG)).alias("total_revenue"),
        F.try_divide(total_from(_added("price", SHORT)), F.sum("prices")).alias("avg_price"),
    )
    named = customers.join(names, keys)
    if "customers" in customers.columns:
        united = named.groupBy(*by, "bucket").agg(F.bitmap_or_agg("customers").alias("customers"))
        counted = united.groupBy(*by).agg(F.sum(F.bitmap_count("customers")).alias("unique_customers"))
    else:
        counted = named.groupBy(*by).agg(F.count_distinct("customer_id").alias("unique_customers"))
    counted = counted.select(*(F.col(c).alias(f"_{c}") for c in by), "unique_customers")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return sums.join(counted, same, "left").select(
        *by, "total_units_sold", "total_revenue", "avg_price", F.coalesce("unique_customers", F.lit(0)).alias("unique_customers")
    )
