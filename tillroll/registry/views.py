"""The retail tables as views of the given tables, once in Spark and once as SQL for the oracle."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = date(2024, 4, 27)
AS_OF_LARGE = date(2001, 10, 1)  # 90 days before lies inside the order dates


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Sums of doubles and means of means, which are summed in no fixed order, rounded so that they compare equal."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# A sum of money doubles, exact as the library's.
EXACT_SUM = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def _purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")


def _tx_columns(quantity: Column, unit_price: Column) -> list[Column]:
    return [
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.col("ts").alias("transaction_date"),
        quantity.alias("quantity"),
        unit_price.alias("unit_price"),
    ]


def _quantity() -> Column:
    return (1 + F.col("event_id") % 2).cast("int")


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as cleaned transactions."""
    return _purchases(spark, sf_dir).select(*_tx_columns(_quantity(), F.col("value")))


TX = """tx AS (
  SELECT event_id AS transaction_id, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts AS transaction_date,
         CAST(1 + event_id % 2 AS INT) AS quantity, CAST(value AS DECIMAL(12,2)) AS unit_price
  FROM events WHERE event_type = 'purchase')"""


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with some prices and quantities missing."""
    event = F.col("event_id")
    return _purchases(spark, sf_dir).select(
        *_tx_columns(F.when(event % 50 != 11, _quantity()), F.when(event % 40 != 7, F.col("value")))
    )


TX_RAW = """tx_raw AS (
  SELECT event_id AS transaction_id, user_id AS customer_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts AS transaction_date,
         CASE WHEN event_id % 50 <> 11 THEN CAST(1 + event_id % 2 AS INT) END AS quantity,
         CASE WHEN event_id % 40 <> 7 THEN value END AS unit_price
  FROM events WHERE event_type = 'purchase')"""


def tx_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as transactions: the largest of the given tables."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").alias("transaction_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


TX_LARGE = """tx AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
         o_orderdate AS transaction_date, CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def tx_unit_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the price of one unit, which has as many decimals as a double."""
    return tx_large(spark, sf_dir).withColumn("unit_price", F.col("unit_price") / F.col("quantity"))


TX_UNIT_PRICE = """tx AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
         o_orderdate AS transaction_date, CAST(l_quantity AS INT) AS quantity,
         l_extendedprice / CAST(l_quantity AS INT) AS unit_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def tx_fractional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in quarters: quantities and prices both have decimals."""
    return tx_large(spark, sf_dir).withColumn("quantity", F.col("quantity") / 4)


TX_FRACTIONAL = """tx AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, o_custkey AS customer_id, l_partkey AS product_id,
         o_orderdate AS transaction_date, CAST(CAST(l_quantity AS INT) * 0.25 AS DECIMAL(12,2)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as cleaned products."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory")
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS subcategory FROM part)"""


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw products: some prices NULL, some NaN, some suppliers NULL, text in the wrong case."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.lower("p_brand").alias("subcategory"),
        F.when(key % 30 == 5, F.lit(float("nan"))).when(key % 25 != 3, F.col("p_retailprice")).alias("price"),
        F.when(key % 20 != 7, F.col("p_size")).alias("supplier_id"),
    )


PRODUCTS_RAW = """products_raw AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, lower(p_brand) AS subcategory,
         CASE WHEN p_partkey % 30 = 5 THEN CAST('NaN' AS DOUBLE)
              WHEN p_partkey % 25 <> 3 THEN p_retailprice END AS price,
         CASE WHEN p_partkey % 20 <> 7 THEN p_size END AS supplier_id
  FROM part)"""


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw customers: some emails NULL, text in the wrong case."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    key = F.col("c_custkey")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        key.alias("customer_id"),
        F.when(key % 10 != 3, F.concat("c_name", F.lit("@Example.COM"))).alias("email"),
        F.lower("n_name").alias("country"),
        F.col("c_mktsegment").alias("city"),
    )


CUSTOMERS_RAW = """customers_raw AS (
  SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 10 <> 3 THEN c_name || '@Example.COM' END AS email,
         lower(n_name) AS country, c_mktsegment AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def raw_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw datasets with all the columns of their files, in file order."""
    people = customers_raw(spark, sf_dir)
    return {
        "customers": people.select(
            "customer_id",
            F.concat(F.lit("First "), F.col("customer_id").cast("string")).alias("first_name"),
            F.col("city").alias("last_name"),
            "email",
            "country",
            "city",
            F.date_add(F.lit(date(2024, 1, 1)), (F.col("customer_id") % 300).cast("int")).alias("registration_date"),
        ),
        "products": products_raw(spark, sf_dir),
        "transactions": tx_raw(spark, sf_dir).withColumn(
            "payment_method", F.when(F.col("transaction_id") % 3 == 0, "paypal").otherwise("credit_card")
        ),
    }


RAW_CUSTOMERS_FILE = f"""{CUSTOMERS_RAW}, customers_file AS (
  SELECT customer_id, 'First ' || customer_id AS first_name, city AS last_name, email, country, city,
         CAST(DATE '2024-01-01' + CAST(customer_id % 300 AS INT) AS DATE) AS registration_date
  FROM customers_raw)"""

# Gold over whichever transactions are named tx.
CM = """cm AS (
  SELECT customer_id, count(transaction_id) AS total_transactions,
         CAST(sum(quantity * unit_price) AS DOUBLE) AS total_spent,
         CAST(sum(quantity * unit_price) AS DOUBLE) / count(quantity * unit_price) AS avg_transaction_amount,
         min(transaction_date) AS first_purchase, max(transaction_date) AS last_purchase
  FROM tx GROUP BY customer_id)"""

PM = """pm AS (
  SELECT category, subcategory, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
         CAST(sum(quantity * unit_price) AS DOUBLE) AS total_revenue,
         CAST(sum(unit_price) AS DOUBLE) / count(unit_price) AS avg_price,
         count(DISTINCT customer_id) AS unique_customers
  FROM tx JOIN products USING (product_id) GROUP BY category, subcategory)"""

PM_FRACTIONAL = PM.replace("AS BIGINT) AS total_units_sold", "AS DOUBLE) AS total_units_sold")


def initcap_sql(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({column}, ' '), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), ' ')"
    )
