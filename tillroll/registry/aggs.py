"""Queries for the aggregations, each over whole transactions or the metrics made from them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import aggregates as a
from tillroll.functions.segments import frequency_segment
from tillroll.registry import views as v
from tillroll.registry.reports import FREQUENCY_CASE, GOLD_CM, GOLD_PM, cm, pm


def _by_product(df: DataFrame, **aggregates) -> DataFrame:
    return df.groupBy("product_id").agg(*(agg.alias(name) for name, agg in aggregates.items()))


def _group_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = v.tx(spark, sf_dir).join(v.products(spark, sf_dir), "product_id")
    return joined.groupBy("category", "subcategory").agg(F.sum("quantity").alias("units"))


def _global_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.tx(spark, sf_dir).agg(
        a.row_count().alias("transactions"),
        F.sum("quantity").alias("units"),
        F.min("transaction_date").alias("first_purchase"),
        F.max("transaction_date").alias("last_purchase"),
    )


def _rollup_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pm(spark, sf_dir).groupBy("category").agg(
        a.row_count().alias("subcategories"),
        F.sum("total_units_sold").alias("category_units"),
        a.total_money(F.col("total_revenue")).alias("category_revenue"),
    )


def _agg_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = v.tx(spark, sf_dir).groupBy("customer_id", "product_id")
    return grouped.agg(a.ratio_of_sums(F.col("transaction_id"), F.col("quantity") - 1).alias("ratio"))


QUERIES = {
    "group_by_one": lambda s, d: v.tx(s, d).groupBy("customer_id").agg(F.sum("quantity").alias("units")),
    "group_by_two": _group_by_two,
    "group_by_case": lambda s, d: cm(s, d)
    .groupBy(frequency_segment(F.col("total_transactions")).alias("frequency_segment"))
    .agg(a.row_count().alias("customers")),
    "global_agg": _global_agg,
    "rollup_category": _rollup_category,
    "agg_count_star": lambda s, d: _by_product(v.tx_raw(s, d), transactions=a.row_count()),
    "agg_count_col": lambda s, d: _by_product(
        v.tx_raw(s, d), priced=a.value_count(F.col("unit_price")), counted=a.value_count(F.col("quantity"))
    ),
    "agg_count_if": lambda s, d: _by_product(
        v.tx_raw(s, d), dear=a.count_where(F.col("unit_price") >= 20), cheap=a.count_where(F.col("unit_price") < 20)
    ),
    "agg_count_distinct": lambda s, d: _by_product(v.tx(s, d), customers=a.distinct_count(F.col("customer_id"))),
    "agg_sum": lambda s, d: _by_product(
        v.tx(s, d), units=F.sum("quantity"), amount=a.total_amount(F.col("quantity"), F.col("unit_price"))
    ),
    "agg_avg": lambda s, d: _by_product(
        v.tx(s, d),
        mean_amount=a.mean_amount(F.col("quantity"), F.col("unit_price")),
        mean_price=a.mean_money(F.col("unit_price")),
    ),
    "agg_avg_int": lambda s, d: _by_product(v.tx(s, d), mean=a.int_avg(F.col("transaction_id") % 11 - 7)),
    "agg_min_max": lambda s, d: _by_product(
        v.tx(s, d), first_purchase=F.min("transaction_date"), last_purchase=F.max("transaction_date")
    ),
    "agg_ratio": _agg_ratio,
}


def _product_sql(view: str, name: str, select: str) -> str:
    return f"WITH {view} SELECT product_id, {select} FROM {name} GROUP BY product_id"


ORACLES = {
    "group_by_one": f"""WITH {v.TX} SELECT customer_id, CAST(sum(quantity) AS BIGINT) AS units
FROM tx GROUP BY customer_id""",
    "group_by_two": f"""WITH {v.TX}, {v.PRODUCTS} SELECT category, subcategory, CAST(sum(quantity) AS BIGINT) AS units
FROM tx JOIN products USING (product_id) GROUP BY category, subcategory""",
    "group_by_case": f"""{GOLD_CM} SELECT {FREQUENCY_CASE} AS frequency_segment, count(*) AS customers
FROM cm GROUP BY {FREQUENCY_CASE}""",
    "global_agg": f"""WITH {v.TX} SELECT count(*) AS transactions, CAST(sum(quantity) AS BIGINT) AS units,
       min(transaction_date) AS first_purchase, max(transaction_date) AS last_purchase FROM tx""",
    "rollup_category": f"""{GOLD_PM} SELECT category, count(*) AS subcategories,
       CAST(sum(total_units_sold) AS BIGINT) AS category_units,
       {v.EXACT_SUM.format('total_revenue')} AS category_revenue
FROM pm GROUP BY category""",
    "agg_count_star": _product_sql(v.TX_RAW, "tx_raw", "count(*) AS transactions"),
    "agg_count_col": _product_sql(v.TX_RAW, "tx_raw", "count(unit_price) AS priced, count(quantity) AS counted"),
    "agg_count_if": _product_sql(
        v.TX_RAW,
        "tx_raw",
        "count(CASE WHEN unit_price >= 20 THEN 1 END) AS dear, count(CASE WHEN unit_price < 20 THEN 1 END) AS cheap",
    ),
    "agg_count_distinct": _product_sql(v.TX, "tx", "count(DISTINCT customer_id) AS customers"),
    "agg_sum": _product_sql(
        v.TX,
        "tx",
        "CAST(sum(quantity) AS BIGINT) AS units, CAST(sum(quantity * unit_price) AS DOUBLE) AS amount",
    ),
    "agg_avg": _product_sql(
        v.TX,
        "tx",
        "CAST(sum(quantity * unit_price) AS DOUBLE) / count(*) AS mean_amount, "
        "CAST(sum(unit_price) AS DOUBLE) / count(*) AS mean_price",
    ),
    "agg_avg_int": _product_sql(
        v.TX, "tx", "CAST(sum(transaction_id % 11 - 7) // count(transaction_id) AS BIGINT) AS mean"
    ),
    "agg_min_max": _product_sql(
        v.TX, "tx", "min(transaction_date) AS first_purchase, max(transaction_date) AS last_purchase"
    ),
    "agg_ratio": f"""WITH {v.TX} SELECT customer_id, product_id,
       CAST(sum(transaction_id) AS DOUBLE) / nullif(CAST(sum(quantity - 1) AS DOUBLE), 0) AS ratio
FROM tx GROUP BY customer_id, product_id""",
}
