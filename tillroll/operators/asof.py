"""The product of a transaction as its own load has it: an as-of join on the load date."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_NAMES = ["category", "subcategory"]


def newest_names(products: DataFrame) -> DataFrame:
    """product_id, category and subcategory of each product, once: of its newest load; of several rows there, the largest."""
    newest = products.groupBy("product_id").agg(F.max(F.struct("load_date", *_NAMES)).alias("newest"))
    return newest.select("product_id", *(F.col(f"newest.{c}").alias(c) for c in _NAMES))


def newest_rows(products: DataFrame) -> DataFrame:
    """All rows of each product's newest load, so that a product with several rows there counts with each."""
    newest = products.groupBy(F.col("product_id").alias("_id")).agg(F.max("load_date").alias("_newest"))
    same = F.col("product_id").eqNullSafe(F.col("_id")) & F.col("load_date").eqNullSafe(F.col("_newest"))
    return products.join(newest, same, "left_semi")


def names_as_of(keys: DataFrame, products: DataFrame, *, first_stands_in: bool = True) -> DataFrame:
    """product_id, load_date, category and subcategory for each of ``keys`` (product_id, load_date) whose product is known.

    The names are those of the newest load that isn't later; of several rows of a product in one load, the largest. Where
    all loads of the product are later, the first one stands in, unless ``first_stands_in`` is off. NULL ids and dates
    match nothing.

    Keys and loads are united and, within a product, the names are carried forward in the order of the loads. That takes
    one narrow row per product and load date, however many transactions there are of it.
    """
    known = "product_id IS NOT NULL AND load_date IS NOT NULL"
    loads = products.where(known).groupBy("product_id", "load_date").agg(F.max(F.struct(*_NAMES)).alias("names"))
    wanted = keys.where(known).select("product_id", "load_date").distinct()
    none = F.when(F.lit(False), F.struct(*(F.lit(None).cast("string").alias(c) for c in _NAMES)))
    both = loads.withColumn("wanted", F.lit(False)).unionByName(wanted.select("product_id", "load_date", none.alias("names"), F.lit(True).alias("wanted")))
    so_far = Window.partitionBy("product_id").orderBy("load_date", "wanted").rowsBetween(Window.unboundedPreceding, 0)
    names = F.last("names", ignorenulls=True).over(so_far)
    if first_stands_in:
        later = Window.partitionBy("product_id").orderBy(F.desc("load_date"), F.desc("wanted")).rowsBetween(Window.unboundedPreceding, 0)
        names = F.coalesce(names, F.last("names", ignorenulls=True).over(later))
    carried = both.withColumn("names", names).where("wanted AND names IS NOT NULL")
    return carried.select("product_id", "load_date", *(F.col(f"names.{c}").alias(c) for c in _NAMES))
