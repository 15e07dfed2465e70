"""Queries for the row-level operators: filters, projections, scalars, CASE, the join, windows and order."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.money import line_amount
from tillroll.functions.scalars import days_between, epoch_micros_to_ts
from tillroll.functions.segments import frequency_segment, value_segment
from tillroll.operators.cleaning import add_load_date, drop_missing, normalize
from tillroll.operators.joins import join_tx_products
from tillroll.operators.ordering import order_desc
from tillroll.operators.windows import partition_share, partition_total
from tillroll.registry import views as v
from tillroll.plans.reports import customer_segment_value
from tillroll.registry.reports import FREQUENCY_CASE, GOLD_CM, GOLD_PM, SEGMENT_VALUE_SQL, VALUE_CASE, cm, pm


def _line_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = line_amount(F.col("quantity"), F.col("unit_price"))
    return v.tx(spark, sf_dir).select("transaction_id", amount.alias("amount"))


def _cte_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report under a name of its own, selected again."""
    return spark.sql(
        "WITH by_value AS (SELECT * FROM {report}) SELECT customer_segment, avg_spent FROM by_value WHERE customer_count > 0",
        report=customer_segment_value(cm(spark, sf_dir)),
    )


def _joined(spark: SparkSession, sf_dir: str, salts: int) -> DataFrame:
    tx = v.tx(spark, sf_dir).select("transaction_id", "product_id", "quantity")
    return join_tx_products(tx, v.products(spark, sf_dir), salts=salts)


def _scalar_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * F.col("l_discount")).alias("product"),
        (F.col("l_extendedprice") * 100.0 / F.col("l_quantity")).alias("quotient"),
    )


def _scalar_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    third = F.round(F.col("value") / 3, 2)
    return v.table(spark, sf_dir, "events").select("event_id", third.alias("third"))


def _scalar_epoch_micros(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    moment = epoch_micros_to_ts(micros).cast("timestamp_ntz")
    return v.table(spark, sf_dir, "events").select("event_id", moment.alias("moment"))


def _scalar_datediff(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = days_between(F.col("o_orderdate"), F.lit(v.AS_OF))
    return v.table(spark, sf_dir, "orders").select("o_orderkey", days.alias("days"))


QUERIES = {
    "dropna_one": lambda s, d: drop_missing(v.customers_raw(s, d), "email"),
    "dropna_any": lambda s, d: drop_missing(v.products_raw(s, d), "price", "supplier_id"),
    "normalize_columns": lambda s, d: normalize(v.customers_raw(s, d), {"email": F.lower, "country": F.upper}),
    "add_load_date": lambda s, d: add_load_date(v.products(s, d), v.AS_OF),
    "line_amount": _line_amount,
    "cte_select": _cte_select,
    "case_value_segment": lambda s, d: cm(s, d).select(
        "customer_id", "total_spent", value_segment(F.col("total_spent")).alias("customer_segment")
    ),
    "case_frequency_segment": lambda s, d: cm(s, d).select(
        "customer_id", "total_transactions", frequency_segment(F.col("total_transactions")).alias("frequency_segment")
    ),
    "join_tx_products": lambda s, d: _joined(s, d, salts=1),
    "join_tx_products_salted": lambda s, d: _joined(s, d, salts=8),
    "window_partition_sum": lambda s, d: partition_total(
        pm(s, d).select("category", "subcategory", "total_revenue"), "total_revenue", ["category"], "category_total"
    ),
    "window_share": lambda s, d: partition_share(
        pm(s, d).select("category", "subcategory", "total_revenue"), "total_revenue", ["category"], "share"
    ),
    "order_by_agg": lambda s, d: order_desc(
        pm(s, d).groupBy("category").agg(F.sum("total_units_sold").alias("category_units")), "category_units"
    ),
    "order_by_col": lambda s, d: order_desc(
        pm(s, d).select("category", "subcategory", "total_revenue"), "total_revenue"
    ),
    "scalar_lower": lambda s, d: v.customers_raw(s, d).select("customer_id", F.lower("email").alias("email")),
    "scalar_upper": lambda s, d: v.customers_raw(s, d).select("customer_id", F.upper("country").alias("country")),
    "scalar_initcap": lambda s, d: v.products_raw(s, d).select(
        "product_id", F.initcap("product_name").alias("product_name"), F.initcap("subcategory").alias("subcategory")
    ),
    "scalar_arith": _scalar_arith,
    "scalar_round": _scalar_round,
    "scalar_epoch_micros": _scalar_epoch_micros,
    "scalar_datediff": _scalar_datediff,
}

_JOIN_SQL = f"""WITH {v.TX}, {v.PRODUCTS}
SELECT product_id, transaction_id, quantity, category, subcategory FROM tx JOIN products USING (product_id)"""

ORACLES = {
    "dropna_one": f"WITH {v.CUSTOMERS_RAW} SELECT * FROM customers_raw WHERE email IS NOT NULL",
    "dropna_any": f"""WITH {v.PRODUCTS_RAW} SELECT * FROM products_raw
WHERE price IS NOT NULL AND NOT isnan(price) AND supplier_id IS NOT NULL""",
    "normalize_columns": f"""WITH {v.CUSTOMERS_RAW}
SELECT customer_id, lower(email) AS email, upper(country) AS country, city FROM customers_raw""",
    "add_load_date": f"WITH {v.PRODUCTS} SELECT *, DATE '{v.AS_OF}' AS load_date FROM products",
    "line_amount": f"WITH {v.TX} SELECT transaction_id, CAST(quantity * unit_price AS DOUBLE) AS amount FROM tx",
    "cte_select": f"""{GOLD_CM}, by_value AS ({SEGMENT_VALUE_SQL})
SELECT customer_segment, avg_spent FROM by_value WHERE customer_count > 0""",
    "case_value_segment": f"{GOLD_CM} SELECT customer_id, total_spent, {VALUE_CASE} AS customer_segment FROM cm",
    "case_frequency_segment": f"""{GOLD_CM}
SELECT customer_id, total_transactions, {FREQUENCY_CASE} AS frequency_segment FROM cm""",
    "join_tx_products": _JOIN_SQL,
    "join_tx_products_salted": _JOIN_SQL,
    "window_partition_sum": f"""{GOLD_PM} SELECT category, subcategory, total_revenue,
       CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) OVER (PARTITION BY category) AS DOUBLE) AS category_total FROM pm""",
    "window_share": f"""{GOLD_PM} SELECT category, subcategory, total_revenue,
       round(total_revenue * 100.0 / nullif(
         CAST(sum(CAST(total_revenue AS DECIMAL(18,2))) OVER (PARTITION BY category) AS DOUBLE), 0), 2) AS share FROM pm""",
    "order_by_agg": f"""{GOLD_PM} SELECT category, CAST(sum(total_units_sold) AS BIGINT) AS category_units
FROM pm GROUP BY category ORDER BY category_units DESC""",
    "order_by_col": f"{GOLD_PM} SELECT category, subcategory, total_revenue FROM pm ORDER BY total_revenue DESC",
    "scalar_lower": f"WITH {v.CUSTOMERS_RAW} SELECT customer_id, lower(email) AS email FROM customers_raw",
    "scalar_upper": f"WITH {v.CUSTOMERS_RAW} SELECT customer_id, upper(country) AS country FROM customers_raw",
    "scalar_initcap": f"""WITH {v.PRODUCTS_RAW} SELECT product_id, {v.initcap_sql("product_name")} AS product_name,
       {v.initcap_sql("subcategory")} AS subcategory FROM products_raw""",
    "scalar_arith": """SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS product,
       l_extendedprice * CAST(100.0 AS DOUBLE) / l_quantity AS quotient FROM lineitem""",
    "scalar_round": "SELECT event_id, round(value / 3, 2) AS third FROM events",
    "scalar_epoch_micros": "SELECT event_id, date_trunc('second', ts) AS moment FROM events",
    "scalar_datediff": f"""SELECT o_orderkey, CAST(datediff('day', o_orderdate, DATE '{v.AS_OF}') AS INT) AS days
FROM orders""",
}
