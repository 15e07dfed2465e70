"""Queries for the user-level operators: cleaning rules, metrics and reports."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.gold import customer_metrics, product_metrics
from tillroll.plans.reports import (
    category_performance_analysis,
    customer_activity_analysis,
    customer_purchase_frequency,
    customer_segment_value,
    top_performing_subcategories,
)
from tillroll.plans.silver import process_customers, process_products, process_transactions
from tillroll.registry import views as v

# The segments' labels and limits.
VALUE_CASE = (
    "CASE WHEN total_spent >= 1000 THEN 'High Value' WHEN total_spent >= 500 THEN 'Medium Value' ELSE 'Low Value' END"
)
FREQUENCY_CASE = (
    "CASE WHEN total_transactions >= 10 THEN 'Frequent (10+ transactions)' "
    "WHEN total_transactions >= 5 THEN 'Regular (5-9 transactions)' ELSE 'Occasional (1-4 transactions)' END"
)


def cm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_metrics(v.tx(spark, sf_dir))


def pm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_metrics(v.tx(spark, sf_dir), v.products(spark, sf_dir))


def cm_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_metrics(v.tx_large(spark, sf_dir))


def pm_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_metrics(v.tx_large(spark, sf_dir), v.products(spark, sf_dir))


def cm_unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean is multiplied by its count, since means of cents lie right between two cents at times."""
    metrics = customer_metrics(v.tx_unit_price(spark, sf_dir))
    mean_times_n = F.col("avg_transaction_amount") * F.col("total_transactions")
    return v.rounded(metrics.withColumn("avg_transaction_amount", mean_times_n), "total_spent", "avg_transaction_amount", digits=2)


def pm_unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = product_metrics(v.tx_unit_price(spark, sf_dir), v.products(spark, sf_dir))
    return v.rounded(metrics, "total_revenue", "avg_price", digits=2)


def activity_epoch_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity report over gold whose moments are microseconds since the epoch."""
    gold = cm(spark, sf_dir)
    moments = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_purchase", "last_purchase")}
    return customer_activity_analysis(gold.withColumns(moments), v.AS_OF)


def category_performance(gold: DataFrame) -> DataFrame:
    return v.rounded(category_performance_analysis(gold), "category_avg_price", "revenue_per_customer")


def purchase_frequency(gold: DataFrame) -> DataFrame:
    return v.rounded(customer_purchase_frequency(gold), "avg_transaction_value")


# The reports as SELECTs over cm and pm; other modules reuse them.
SEGMENT_VALUE_SQL = f"""SELECT {VALUE_CASE} AS customer_segment, count(*) AS customer_count,
       {v.EXACT_SUM.format('total_spent')} / count(total_spent) AS avg_spent,
       CAST(sum(total_transactions) // count(total_transactions) AS BIGINT) AS avg_transactions
FROM cm GROUP BY 1"""


def activity_sql(as_of: date) -> str:
    return f"""SELECT count(*) AS total_customers,
       count(CASE WHEN datediff('day', last_purchase, DATE '{as_of}') <= 90 THEN 1 END) AS active_90_days,
       count(CASE WHEN datediff('day', last_purchase, DATE '{as_of}') > 90 THEN 1 END) AS inactive_90_days,
       CAST(sum(datediff('day', first_purchase, last_purchase))
            // count(datediff('day', first_purchase, last_purchase)) AS BIGINT) AS avg_customer_lifespan
FROM cm"""


ACTIVITY_SQL = activity_sql(v.AS_OF)

CATEGORY_SQL = f"""SELECT category, {v.EXACT_SUM.format('total_revenue')} AS category_revenue,
       CAST(sum(total_units_sold) AS BIGINT) AS category_units,
       CAST(sum(unique_customers) AS BIGINT) AS total_customers,
       round(avg(avg_price), 4) AS category_avg_price,
       round(sum(total_revenue) / nullif(CAST(sum(unique_customers) AS DOUBLE), 0), 4) AS revenue_per_customer
FROM pm GROUP BY category"""

SUBCATEGORY_SQL = """SELECT category, subcategory, total_revenue, total_units_sold,
       round(total_revenue * 100.0 / nullif(sum(total_revenue) OVER (PARTITION BY category), 0), 2)
         AS category_revenue_share
FROM pm"""

FREQUENCY_SQL = f"""SELECT {FREQUENCY_CASE} AS frequency_segment, count(*) AS customer_count,
       {v.EXACT_SUM.format('total_spent')} / count(total_spent) AS avg_total_spent,
       round(avg(avg_transaction_amount), 4) AS avg_transaction_value
FROM cm GROUP BY 1"""

GOLD_CM = f"WITH {v.TX}, {v.CM}"
GOLD_PM = f"WITH {v.TX}, {v.PRODUCTS}, {v.PM}"
GOLD_CM_LARGE = f"WITH {v.TX_LARGE}, {v.CM}"
GOLD_PM_LARGE = f"WITH {v.TX_LARGE}, {v.PRODUCTS}, {v.PM}"

QUERIES = {
    "process_customers": lambda s, d: process_customers(v.customers_raw(s, d), v.AS_OF),
    "process_products": lambda s, d: process_products(v.products_raw(s, d), v.AS_OF),
    "process_transactions": lambda s, d: process_transactions(v.tx_raw(s, d), v.AS_OF),
    "customer_metrics": cm,
    "product_metrics": pm,
    "customer_segment_value": lambda s, d: customer_segment_value(cm(s, d)),
    "customer_activity_analysis": lambda s, d: customer_activity_analysis(cm(s, d), v.AS_OF),
    "category_performance_analysis": lambda s, d: category_performance(pm(s, d)),
    "top_performing_subcategories": lambda s, d: top_performing_subcategories(pm(s, d)),
    "customer_purchase_frequency": lambda s, d: purchase_frequency(cm(s, d)),
    "customer_metrics_unit_price": cm_unit_price,
    "product_metrics_unit_price": pm_unit_price,
    "customer_metrics_fractional": lambda s, d: customer_metrics(v.tx_fractional(s, d)),
    "product_metrics_fractional": lambda s, d: product_metrics(v.tx_fractional(s, d), v.products(s, d)),
    "product_metrics_bitmap": lambda s, d: product_metrics(v.tx(s, d), v.products(s, d), bitmaps=True),
    "product_metrics_bitmap_large": lambda s, d: product_metrics(v.tx_large(s, d), v.products(s, d), bitmaps=True),
    "customer_activity_epoch_micros": activity_epoch_micros,
    "customer_metrics_large": cm_large,
    "product_metrics_large": pm_large,
    "customer_segment_value_large": lambda s, d: customer_segment_value(cm_large(s, d)),
    "customer_activity_analysis_large": lambda s, d: customer_activity_analysis(cm_large(s, d), v.AS_OF_LARGE),
    "category_performance_analysis_large": lambda s, d: category_performance(pm_large(s, d)),
    "customer_purchase_frequency_large": lambda s, d: purchase_frequency(cm_large(s, d)),
    "top_performing_subcategories_large": lambda s, d: top_performing_subcategories(pm_large(s, d)),
}

ORACLES = {
    "process_customers": f"""WITH {v.CUSTOMERS_RAW}
SELECT customer_id, lower(email) AS email, upper(country) AS country, city, DATE '{v.AS_OF}' AS load_date
FROM customers_raw WHERE email IS NOT NULL""",
    "process_products": f"""WITH {v.PRODUCTS_RAW}
SELECT product_id, product_name, {v.initcap_sql("category")} AS category,
       {v.initcap_sql("subcategory")} AS subcategory, price, supplier_id, DATE '{v.AS_OF}' AS load_date
FROM products_raw WHERE price IS NOT NULL AND NOT isnan(price) AND supplier_id IS NOT NULL""",
    "process_transactions": f"""WITH {v.TX_RAW}
SELECT *, DATE '{v.AS_OF}' AS load_date FROM tx_raw WHERE quantity IS NOT NULL AND unit_price IS NOT NULL""",
    "customer_metrics": f"{GOLD_CM} SELECT * FROM cm",
    "product_metrics": f"{GOLD_PM} SELECT * FROM pm",
    "customer_segment_value": f"{GOLD_CM} {SEGMENT_VALUE_SQL} ORDER BY avg_spent DESC",
    "customer_activity_analysis": f"{GOLD_CM} {ACTIVITY_SQL}",
    "category_performance_analysis": f"{GOLD_PM} {CATEGORY_SQL} ORDER BY category_revenue DESC",
    "top_performing_subcategories": f"{GOLD_PM} {SUBCATEGORY_SQL} ORDER BY total_revenue DESC",
    "customer_purchase_frequency": f"{GOLD_CM} {FREQUENCY_SQL}",
    "customer_metrics_unit_price": f"""WITH {v.TX_UNIT_PRICE}, {v.CM}
SELECT * REPLACE (round(total_spent, 2) AS total_spent, 
  round(avg_transaction_amount * total_transactions, 2) AS avg_transaction_amount) FROM cm""",
    "product_metrics_unit_price": f"""WITH {v.TX_UNIT_PRICE}, {v.PRODUCTS}, {v.PM}
SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, round(avg_price, 2) AS avg_price) FROM pm""",
    "customer_metrics_fractional": f"WITH {v.TX_FRACTIONAL}, {v.CM} SELECT * FROM cm",
    "product_metrics_fractional": f"WITH {v.TX_FRACTIONAL}, {v.PRODUCTS}, {v.PM_FRACTIONAL} SELECT * FROM pm",
    "product_metrics_bitmap": f"{GOLD_PM} SELECT * FROM pm",
    "product_metrics_bitmap_large": f"{GOLD_PM_LARGE} SELECT * FROM pm",
    "customer_activity_epoch_micros": f"{GOLD_CM} {ACTIVITY_SQL}",
    "customer_metrics_large": f"{GOLD_CM_LARGE} SELECT * FROM cm",
    "product_metrics_large": f"{GOLD_PM_LARGE} SELECT * FROM pm",
    "customer_segment_value_large": f"{GOLD_CM_LARGE} {SEGMENT_VALUE_SQL}",
    "customer_activity_analysis_large": f"{GOLD_CM_LARGE} {activity_sql(v.AS_OF_LARGE)}",
    "category_performance_analysis_large": f"{GOLD_PM_LARGE} {CATEGORY_SQL}",
    "customer_purchase_frequency_large": f"{GOLD_CM_LARGE} {FREQUENCY_SQL}",
    "top_performing_subcategories_large": f"{GOLD_PM_LARGE} {SUBCATEGORY_SQL}",
}
