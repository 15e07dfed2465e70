"""Silver to gold: metrics per customer and per subcategory."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.aggregates import (
    bitmap_bucket,
    bitmap_of,
    distinct_count,
    mean_amount,
    mean_money,
    total_amount,
    total_units,
    value_count,
)
from tillroll.functions.money import holds_whole, line_parts, money_parts, sums_of, total_from
from tillroll.operators.joins import join_tx_products

_KEYS = ["_names_key", "_names_key_2"]
_COLUMNS = ["category", "subcategory", "total_units_sold", "total_revenue", "avg_price", "unique_customers"]


def customer_metrics(tx: DataFrame) -> DataFrame:
    """One row per ``customer_id`` (NULL forms a group), over all transactions.

    One shuffle, of one row per customer and map task: every buffer is fixed-width and combined before the exchange,
    so a customer holding a third of all rows costs no more than any other.
    """
    quantity, price, whole = F.col("quantity"), F.col("unit_price"), holds_whole(tx, "quantity")
    return tx.groupBy("customer_id").agg(
        value_count(F.col("transaction_id")).alias("total_transactions"),
        total_amount(quantity, price, whole=whole).alias("total_spent"),
        mean_amount(quantity, price, whole=whole).alias("avg_transaction_amount"),
        F.min("transaction_date").alias("first_purchase"),
        F.max("transaction_date").alias("last_purchase"),
    )


def product_metrics(
    tx: DataFrame,
    products: DataFrame,
    *,
    products_are_small: bool = False,
    salts: int = 1,
    distinct_rsd: float | None = None,
    bitmaps: bool = False,
    by_load: bool = False,
) -> DataFrame:
    """One row per (``category``, ``subcategory``), over the transactions whose product is known.

    ``avg_price`` is the plain mean of ``unit_price`` per transaction row, not weighted by quantity. ``total_units_sold``
    is a whole number, or a double where quantities may have fractions.

    The exact distinct count has to shuffle about one row per (subcategory, customer), the largest shuffle of the gold
    stage. So the two names are replaced by a key of two 64-bit hashes before it and joined back to the finished
    metrics. Hot subcategories and hot customers are combined before that shuffle; the second one carries one row per
    subcategory and task.

    ``bitmaps``, for customer ids that are whole numbers and densely used: the exact count shuffles one bitmap per
    (subcategory, 32768 ids) and task instead. It pays where these have over some ten customers each; ids that are no
    whole numbers are refused.

    ``by_load`` joins on ``load_date`` as well, for products with a row for each (:func:`tillroll.operators.names_as_of`).
    See :func:`join_tx_products` for the join options and :func:`distinct_count` for ``distinct_rsd``.
    """
    if bitmaps and not holds_whole(tx, "customer_id"):
        raise ValueError("bitmaps need customer ids that are whole numbers")
    needed = ["product_id", "customer_id", "quantity", "unit_price"]
    if salts > 1 and not products_are_small:
        needed.append("transaction_id")
    on = ["product_id", "load_date"] if by_load else ["product_id"]
    needed += on[1:]
    joined = join_tx_products(
        tx.select(*needed), product_keys(products, on), products_are_small=products_are_small, salts=salts, on=on
    )
    quantity, price = F.col("quantity"), F.col("unit_price")
    if bitmaps:
        metrics = _by_bitmaps(joined, tx)
        return metrics.join(_names_by_key(products), _KEYS).select(*_COLUMNS)
    metrics = joined.groupBy(*_KEYS).agg(
        total_units(tx, "quantity").alias("total_units_sold"),
        total_amount(quantity, price, whole=holds_whole(tx, "quantity")).alias("total_revenue"),
        mean_money(price).alias("avg_price"),
        distinct_count(F.col("customer_id"), distinct_rsd).alias("unique_customers"),
    )
    return metrics.join(_names_by_key(products), _KEYS).select(*_COLUMNS)


def _by_bitmaps(joined: DataFrame, tx: DataFrame) -> DataFrame:
    """The metrics by key, by way of sums and a bitmap for each bucket of customer ids."""
    quantity, price, customer = F.col("quantity"), F.col("unit_price"), F.col("customer_id")
    whole = holds_whole(tx, "quantity")
    pieces = {"revenue": sums_of(line_parts(quantity, price, whole=whole)), "price": sums_of(money_parts(price))}
    pieces["units"] = [F.sum(quantity)] if whole else sums_of(money_parts(quantity))
    named = [c.alias(f"{name}_{i}") for name, sums in pieces.items() for i, c in enumerate(sums)]
    by_bucket = joined.groupBy(*_KEYS, bitmap_bucket(customer).alias("_bucket")).agg(
        *named, F.count(price).alias("prices"), bitmap_of(customer).alias("customers")
    )
    added = {name: [F.sum(f"{name}_{i}") for i in range(len(sums))] for name, sums in pieces.items()}
    return by_bucket.groupBy(*_KEYS).agg(
        (added["units"][0] if whole else total_from(added["units"])).alias("total_units_sold"),
        total_from(added["revenue"]).alias("total_revenue"),
        F.try_divide(total_from(added["price"]), F.sum("prices")).alias("avg_price"),
        F.sum(F.bitmap_count("customers")).alias("unique_customers"),
    )


def product_keys(products: DataFrame, on: Sequence[str] = ("product_id",)) -> DataFrame:
    """What :func:`product_metrics` joins the transactions with: the columns ``on`` and the key of its two names."""
    return products.select(*on, *_names_key())


def _names_key() -> list[Column]:
    """128-bit key of (category, subcategory). The NULL flags tell (NULL, x) from (x, NULL)."""
    category, subcategory = F.col("category"), F.col("subcategory")
    names = (category.isNull(), category, subcategory.isNull(), subcategory)
    return [F.xxhash64(*names).alias(_KEYS[0]), F.xxhash64(F.lit("second"), *names).alias(_KEYS[1])]


def _names_by_key(products: DataFrame) -> DataFrame:
    """The names behind each key."""
    return products.select(*_names_key(), "category", "subcategory").distinct()
