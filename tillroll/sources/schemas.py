"""Declared schemas of the raw files, the silver tables and the gold tables.

Ids are ``bigint``: under a declared ``int`` an id beyond two thousand million would read as NULL.
"""

from pyspark.sql import types as T

RAW_CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("registration_date", T.DateType()),
    ]
)

RAW_PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("supplier_id", T.LongType()),
    ]
)

RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("transaction_date", T.TimestampType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
    ]
)

RAW = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "transactions": RAW_TRANSACTIONS}

SILVER = {
    name: T.StructType([*schema.fields, T.StructField("load_date", T.DateType())]) for name, schema in RAW.items()
}

GOLD = {
    "customer_metrics": T.StructType(
        [
            T.StructField("customer_id", T.LongType()),
            T.StructField("total_transactions", T.LongType()),
            T.StructField("total_spent", T.DoubleType()),
            T.StructField("avg_transaction_amount", T.DoubleType()),
            T.StructField("first_purchase", T.TimestampType()),
            T.StructField("last_purchase", T.TimestampType()),
        ]
    ),
    "product_metrics": T.StructType(
        [
            T.StructField("category", T.StringType()),
            T.StructField("subcategory", T.StringType()),
            T.StructField("total_units_sold", T.LongType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("avg_price", T.DoubleType()),
            T.StructField("unique_customers", T.LongType()),
        ]
    ),
}
