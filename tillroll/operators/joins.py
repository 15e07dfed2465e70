"""The fact-to-dimension join and the size check behind its broadcast."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024
_ROW_OVERHEAD_BYTES = 32
_FIXED_WIDTH_BYTES = 16
_SALT = "_salt"
HOT_SHARE = 0.01


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``'s rows, from one distributed aggregate over the real data.

    Measures what the rows hold, not the compressed size of their files, so it is safe to broadcast by.
    """
    width = F.lit(_ROW_OVERHEAD_BYTES).cast("bigint")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + F.lit(_FIXED_WIDTH_BYTES)
        else:
            width = width + F.lit(_FIXED_WIDTH_BYTES)
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def join_tx_products(
    tx: DataFrame,
    products: DataFrame,
    *,
    products_are_small: bool = False,
    salts: int = 1,
    hot_share: float = HOT_SHARE,
    on: Sequence[str] = ("product_id",),
) -> DataFrame:
    """Inner join of transactions with products on ``product_id``, which is kept once, and further columns of ``on``.

    NULL keys and transactions without a product drop out. A column both sides hold must be projected away first.

    - Default: no hint. Spark broadcasts the products under its own size limit; otherwise it shuffles both sides and
      adaptive execution splits the partitions of hot products.
    - ``products_are_small``: the caller has checked the size (see :func:`measured_bytes`); broadcast them.
    - ``salts`` > 1, for products too large to broadcast: the hot products, those with over ``hot_share`` of the
      transactions, are found by a count (one pass over the key column); their transactions are spread over that many
      sub-keys by a hash of the transaction's columns, and only their rows are repeated once per salt. All others are
      joined as they are. At most ``1 / hot_share`` ids reach the driver. The hash is a function of the row, so a retried
      task salts alike; ``tx`` should hold ``transaction_id``, to tell like purchases apart.
    """
    if products_are_small:
        return tx.join(F.broadcast(products), [*on], "inner")
    hot = hot_products(tx, hot_share) if salts > 1 else []
    if not hot:
        return tx.join(products, [*on], "inner")
    is_hot, spread = F.col("product_id").isin(hot), F.pmod(F.xxhash64(*tx.columns), F.lit(salts)).cast("int")
    salted_tx = tx.withColumn(_SALT, F.when(is_hot, spread).otherwise(0))
    repeats = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_products = products.withColumn(_SALT, F.explode(repeats))
    return salted_tx.join(salted_products, [*on, _SALT], "inner").drop(_SALT)


def hot_products(tx: DataFrame, hot_share: float = HOT_SHARE) -> list:
    """The ids with over ``hot_share`` of the transactions, ``1 / hot_share`` at most. Counted in one pass, never sampled."""
    counts = tx.groupingSets([["product_id"], []], "product_id").agg(F.count(F.lit(1)).alias("n"), F.grouping("product_id").alias("all"))
    named = counts.where((F.col("all") == 1) | F.col("product_id").isNotNull())
    top = named.orderBy(F.desc("all"), F.desc("n")).limit(int(1 / hot_share) + 1).collect()
    least = hot_share * sum(r["n"] for r in top if r["all"])
    return sorted(r["product_id"] for r in top if not r["all"] and r["n"] > least)
