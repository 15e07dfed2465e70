"""Queries for sources, sinks, DDL and jobs: each writes views of the given tables and reads them back.

Files go to a fresh folder in the session's scratch folder, tables to a database of their own there; both are removed
when Python ends.
"""

import atexit
import uuid
from contextlib import suppress
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.jobs import AUDIT, QUARANTINE, Config, run_gold, run_reports, run_silver
from tillroll.plans.reports import customer_segment_value
from tillroll.plans.silver import process_products
from tillroll.registry import reports as r
from tillroll.registry import views as v
from tillroll.session import scratch_dir
from tillroll.sinks.ddl import REPORT_TABLES, create_report_tables, ensure_database
from tillroll.sinks.tables import write_catalog, write_overwrite, write_snapshot
from tillroll.sources.drift import (
    apply_drift,
    catalog_schemas,
    discover_datasets,
    infer_schemas,
    schema_drift,
)
from tillroll.sources.infer import scan_csv_once
from tillroll.sources.scan import scan_catalog, scan_csv, scan_format, scan_parquet, scan_versioned
from tillroll.sources.schemas import RAW
from tillroll.sqltext import table_name

NEXT_DAY = v.AS_OF + timedelta(days=1)


def _database(spark: SparkSession, name: str) -> tuple[str, str]:
    database = f"{name}_{uuid.uuid4().hex[:8]}"
    location = scratch_dir(spark, database)
    ensure_database(spark, database, location)
    atexit.register(_drop, spark, database)
    return database, location


def _drop(spark: SparkSession, database: str) -> None:
    """At the end, the query's own database; the files go with the session's scratch folder."""
    with suppress(Exception):  # the session may be stopped by then, and its catalog gone
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _write_raw(spark: SparkSession, sf_dir: str, base: str) -> None:
    for name, df in v.raw_files(spark, sf_dir).items():
        write_overwrite(df, f"{base}/{name}.csv", "csv")


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'scan_csv')}/customers.csv"
    write_overwrite(v.raw_files(spark, sf_dir)["customers"], path, "csv")
    return scan_csv(spark, path, RAW["customers"])


def _scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'scan_csv')}/customers.csv"
    write_overwrite(v.raw_files(spark, sf_dir)["customers"], path, "csv")
    inferred = scan_csv(spark, path)
    return inferred.withColumn("customer_id", F.col("customer_id").cast("bigint"))  # int or bigint, by the values


def _scan_csv_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'scan_csv')}/customers.csv"
    write_overwrite(v.raw_files(spark, sf_dir)["customers"], path, "csv")
    return scan_csv_once(spark, path).withColumn("customer_id", F.col("customer_id").cast("bigint"))


def _scan_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'scan_format')}/transactions"
    write_overwrite(v.tx_raw(spark, sf_dir), path, "orc")
    return scan_format(spark, path, "orc")


def _scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, _ = _database(spark, "scan_catalog")
    spark.sql(f"CREATE TABLE {table_name(database, 'part')} USING parquet LOCATION '{sf_dir}/part.parquet'")
    return scan_catalog(spark, database, "part")


def _schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog that is behind its files in each way, compared and brought up to date."""
    database, base = _database(spark, "schema_drift")
    _write_raw(spark, sf_dir, f"{base}/raw")
    known = {
        "customers": "customer_id INT, first_name STRING, last_name STRING, email STRING, country STRING, "
        "registration_date DATE, fax STRING",
        "products": "product_id INT, product_name STRING, category STRING, subcategory STRING, price INT, "
        "supplier_id INT",
    }
    for name, columns in known.items():
        spark.sql(
            f"CREATE TABLE {table_name(database, name)} ({columns}) USING csv OPTIONS (header 'true') "
            f"LOCATION '{base}/raw/{name}.csv'"
        )
    datasets = discover_datasets(spark, f"{base}/raw")
    found = infer_schemas(spark, datasets)
    drift = schema_drift(spark, found, catalog_schemas(spark, database))
    apply_drift(spark, drift, database, datasets, found)
    after = [
        (name, field.name, field.dataType.simpleString())
        for name, schema in catalog_schemas(spark, database).items()
        for field in schema.fields
    ]
    catalog = spark.createDataFrame(after, "dataset string, column string, catalog_type string")
    return drift.join(catalog, ["dataset", "column"], "left")


def _sink_catalog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, base = _database(spark, "catalog_append")
    customers = v.customers_raw(spark, sf_dir)
    write_catalog(customers.drop("city"), database, "customers", f"{base}/customers")
    write_catalog(customers, database, "customers", f"{base}/customers")
    return scan_catalog(spark, database, "customers")


def _sink_catalog_type_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole prices first, then prices with cents, then suppliers as text."""
    database, base = _database(spark, "type_change")
    products = v.products_raw(spark, sf_dir).select("product_id", "price", "supplier_id").where("NOT isnan(price)")
    whole = products.withColumn("price", F.floor("price").cast("int"))
    texts = products.withColumn("supplier_id", F.concat(F.lit("s"), F.col("supplier_id").cast("string")))
    for rows in (whole, products, texts):
        write_catalog(rows, database, "products", f"{base}/products")
    return scan_catalog(spark, database, "products")


def _sink_type_change_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As before, but the catalog is lost after each change, and at the end the rows are found by the path alone."""
    database, base = _database(spark, "type_change_lost")
    products = v.products_raw(spark, sf_dir).select("product_id", "price", "supplier_id").where("NOT isnan(price)")
    whole = products.withColumn("price", F.floor("price").cast("int"))
    texts = products.withColumn("supplier_id", F.concat(F.lit("s"), F.col("supplier_id").cast("string")))
    for rows in (whole, products, texts):
        write_catalog(rows, database, "products", f"{base}/products")
        spark.sql(f"DROP TABLE {table_name(database, 'products')}")
    return scan_versioned(spark, f"{base}/products")


def _sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'overwrite')}/products"
    write_overwrite(v.products_raw(spark, sf_dir), path)
    write_overwrite(process_products(v.products_raw(spark, sf_dir), v.AS_OF), path)
    return scan_parquet(spark, path)


def _sink_report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, base = _database(spark, "snapshots")
    create_report_tables(spark, database, base)
    report = customer_segment_value(r.cm(spark, sf_dir))
    for day in (v.AS_OF, v.AS_OF, NEXT_DAY):
        write_snapshot(report, database, "customer_segment_value", day)
    return scan_catalog(spark, database, "customer_segment_value")


def _ddl_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report inserted by column list, so that the table's default fills the date."""
    database, base = _database(spark, "ddl_reports")
    create_report_tables(spark, database, base)
    table = "customer_purchase_frequency"
    spark.sql(
        f"INSERT INTO {table_name(database, table)} ({', '.join(REPORT_TABLES[table])}) SELECT * FROM {{report}}",
        report=r.purchase_frequency(r.cm(spark, sf_dir)),
    )
    rows = scan_catalog(spark, database, table)
    dated = F.col("spst_date").between(F.date_sub(F.current_date(), 1), F.current_date())
    return rows.withColumn("dated_today", dated).drop("spst_date")


def _silver_config(spark: SparkSession, sf_dir: str) -> Config:
    database, base = _database(spark, "retail")
    _write_raw(spark, sf_dir, f"{base}/raw")
    cfg = Config(base, "raw", "silver", database, as_of=v.AS_OF)
    run_silver(spark, cfg)
    return cfg


def _gold_config(spark: SparkSession, sf_dir: str) -> Config:
    silver = _silver_config(spark, sf_dir)
    cfg = replace(silver, in_path="silver", out_path="gold")
    run_gold(spark, cfg)
    return cfg


MOVED = {
    "customers": ["city", "email", "customer_id", "first_name", "last_name", "country", "registration_date"],
    "products": ["price", "subcategory", "product_id", "product_name", "category", "supplier_id"],
    "transactions": [
        "product_id",
        "customer_id",
        "unit_price",
        "quantity",
        "transaction_id",
        "transaction_date",
        "payment_method",
    ],
}


def _gold_csv_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over silver in CSV whose raw files hold the columns in another order."""
    database, base = _database(spark, "retail_csv")
    for name, df in v.raw_files(spark, sf_dir).items():
        write_overwrite(df.select(MOVED[name]), f"{base}/raw/{name}.csv", "csv")
    cfg = Config(base, "raw", "silver", database, as_of=v.AS_OF, silver_format="csv")
    run_silver(spark, cfg)
    run_gold(spark, replace(cfg, in_path="silver", out_path="gold"))
    return _gold_rows(spark, database)


def _gold_two_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over two days of transactions and customers. The second day's products lack every third, which was sold, too."""
    database, base = _database(spark, "retail_loads")
    for part, day in enumerate((v.AS_OF, NEXT_DAY)):
        raw = v.raw_files(spark, sf_dir)
        raw["transactions"] = raw["transactions"].where(F.col("transaction_id") % 2 == part)
        if part:
            raw["products"] = raw["products"].where(F.col("product_id") % 3 != 0)
        for name, df in raw.items():
            write_overwrite(df, f"{base}/raw_{part}/{name}.csv", "csv")
        cfg = Config(base, f"raw_{part}", "silver", database, as_of=day)
        run_silver(spark, cfg)
    run_gold(spark, replace(cfg, in_path="silver", out_path="gold"))
    return _gold_rows(spark, database)


def _gold_types_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over two days of silver with inferred types, whose catalog was lost after each day.

    The second day has quarters of units, and suppliers as text, so that older files have to be rewritten.
    """
    database, base = _database(spark, "retail_types")
    for part, day in enumerate((v.AS_OF, NEXT_DAY)):
        raw = v.raw_files(spark, sf_dir)
        raw["transactions"] = raw["transactions"].where(F.col("transaction_id") % 2 == part)
        if part:
            raw["transactions"] = raw["transactions"].withColumn("quantity", F.col("quantity") / 4)
            raw["products"] = raw["products"].withColumn("supplier_id", F.concat(F.lit("s"), F.col("supplier_id").cast("string")))
        for name, df in raw.items():
            write_overwrite(df, f"{base}/raw_{part}/{name}.csv", "csv")
        cfg = Config(base, f"raw_{part}", "silver", database, as_of=day, infer_schema=True)
        run_silver(spark, cfg)
        for table in spark.catalog.listTables(database):
            spark.sql(f"DROP TABLE {table_name(database, table.name)}")
    run_gold(spark, replace(cfg, in_path="silver", out_path="gold"))
    return _gold_rows(spark, database).withColumn("n", F.col("n").cast("double"))


def _gold_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold over two days of transactions; between them every fourth product got another subcategory."""
    database, base = _database(spark, "retail_as_of")
    for part, day in enumerate((v.AS_OF, NEXT_DAY)):
        raw = v.raw_files(spark, sf_dir)
        raw["transactions"] = raw["transactions"].where(F.col("transaction_id") % 2 == part)
        if part:
            renamed = F.when(F.col("product_id") % 4 == 0, "renamed").otherwise(F.col("subcategory"))
            raw["products"] = raw["products"].withColumn("subcategory", renamed)
        for name, df in raw.items():
            write_overwrite(df, f"{base}/raw_{part}/{name}.csv", "csv")
        cfg = Config(base, f"raw_{part}", "silver", database, as_of=day, product_rows="as_of")
        run_silver(spark, cfg)
    run_gold(spark, replace(cfg, in_path="silver", out_path="gold"))
    return _gold_rows(spark, database)


def _gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from daily states. The first day's transactions come twice, the first time without a third of them."""
    database, base = _database(spark, "retail_states")
    first = F.col("transaction_id") % 2 == 0
    loads = [(v.AS_OF, first & (F.col("transaction_id") % 3 != 0)), (NEXT_DAY, ~first), (v.AS_OF, first)]
    for n, (day, which) in enumerate(loads):
        raw = v.raw_files(spark, sf_dir)
        raw["transactions"] = raw["transactions"].where(which)
        for name, df in raw.items():
            write_overwrite(df, f"{base}/raw_{n}/{name}.csv", "csv")
        cfg = Config(base, f"raw_{n}", "silver", database, as_of=day)
        run_silver(spark, cfg)
        run_gold(spark, replace(cfg, in_path="silver", out_path="gold", incremental=True, load_date=day))
    return _gold_rows(spark, database)


def _run_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the three silver tables in one common shape."""
    database = _silver_config(spark, sf_dir).database
    shapes = {
        "customers": ["customer_id", "email", "country", "CAST(NULL AS DOUBLE)"],
        "products": ["product_id", "category", "subcategory", "price"],
        "transactions": ["transaction_id", "CAST(customer_id AS STRING)", "CAST(product_id AS STRING)", "unit_price"],
    }
    parts = [
        scan_catalog(spark, database, name).selectExpr(
            f"'{name}' AS dataset",
            f"{key} AS key",
            f"{one} AS text_1",
            f"{two} AS text_2",
            f"{num} AS num",
            "load_date",
        )
        for name, (key, one, two, num) in shapes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _silver_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the raw rows of two runs of a day, counted in the tables; the second run's files hold bad values."""
    database, base = _database(spark, "retail_quarantine")
    _write_raw(spark, sf_dir, f"{base}/raw")
    cfg = Config(base, "raw", "silver", database, as_of=v.AS_OF)
    run_silver(spark, cfg)
    raw = v.raw_files(spark, sf_dir)
    day = F.col("registration_date").cast("string")
    raw["customers"] = raw["customers"].withColumn("registration_date", F.when(F.col("customer_id") % 9 != 4, day).otherwise("soon"))
    price = F.col("price").cast("string")
    raw["products"] = raw["products"].withColumn("price", F.when(F.col("product_id") % 11 != 2, price).otherwise("dear"))
    number = F.col("quantity").cast("string")
    raw["transactions"] = raw["transactions"].withColumn("quantity", F.when(F.col("transaction_id") % 13 != 6, number).otherwise("two"))
    for name, df in raw.items():
        write_overwrite(df, f"{base}/raw/{name}.csv", "csv")
    run_silver(spark, cfg)
    audit = scan_catalog(spark, database, AUDIT).select("dataset", "load_date", F.col("rows").alias("raw"), "dropped")
    parts = [
        scan_catalog(spark, database, name).select(F.lit(name).alias("dataset"), F.lit("cleaned").alias("fate")) for name in raw
    ]
    for name in raw:
        held = scan_catalog(spark, database, QUARANTINE.format(name))
        parts.append(held.select(F.lit(name), F.when(F.col("in_silver"), "malformed_kept").otherwise("quarantined")))
    fates = reduce(DataFrame.union, parts).groupBy("dataset").pivot("fate", ["cleaned", "malformed_kept", "quarantined"]).count()
    fates = fates.fillna(0, ["cleaned", "malformed_kept", "quarantined"])
    out = audit.join(fates, "dataset")
    return out.withColumn("adds_up", F.col("cleaned") + F.col("dropped") + F.col("quarantined") == F.col("raw"))


def _run_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gold_rows(spark, _gold_config(spark, sf_dir).database)


def _gold_rows(spark: SparkSession, database: str) -> DataFrame:
    """The rows of the two gold tables in one common shape."""
    cm = scan_catalog(spark, database, "customer_metrics").selectExpr(
        "CAST(customer_id AS STRING) AS key_1",
        "CAST(NULL AS STRING) AS key_2",
        "total_transactions AS n",
        "total_spent AS total",
        "avg_transaction_amount AS mean",
        "CAST(first_purchase AS TIMESTAMP_NTZ) AS first_purchase",
        "CAST(last_purchase AS TIMESTAMP_NTZ) AS last_purchase",
        "CAST(NULL AS BIGINT) AS customers",
    )
    pm = scan_catalog(spark, database, "product_metrics").selectExpr(
        "category AS key_1",
        "subcategory AS key_2",
        "total_units_sold AS n",
        "total_revenue AS total",
        "avg_price AS mean",
        "CAST(NULL AS TIMESTAMP_NTZ) AS first_purchase",
        "CAST(NULL AS TIMESTAMP_NTZ) AS last_purchase",
        "unique_customers AS customers",
    )
    return cm.unionByName(pm)


# Column of each report that goes to each place of the common shape.
REPORT_SHAPES = {
    "customer_segment_value": ("customer_segment", "NULL", "customer_count", "avg_spent", "avg_transactions", "NULL"),
    "customer_activity_analysis": (
        "'all'",
        "NULL",
        "total_customers",
        "active_90_days",
        "inactive_90_days",
        "avg_customer_lifespan",
    ),
    "category_performance_analysis": (
        "category",
        "CAST(total_customers AS {text})",
        "category_units",
        "category_revenue",
        "category_avg_price",
        "revenue_per_customer",
    ),
    "top_performing_subcategories": (
        "category",
        "subcategory",
        "total_units_sold",
        "total_revenue",
        "category_revenue_share",
        "NULL",
    ),
    "customer_purchase_frequency": (
        "frequency_segment",
        "NULL",
        "customer_count",
        "avg_total_spent",
        "avg_transaction_value",
        "NULL",
    ),
}


def _report_select(name: str, text: str, source: str) -> str:
    one, two, n, *measures = (part.format(text=text) for part in REPORT_SHAPES[name])
    x, y, z = (f"round(CAST({measure} AS DOUBLE), 4)" for measure in measures)
    return (
        f"SELECT '{name}' AS report, {one} AS key_1, CAST({two} AS {text}) AS key_2, CAST({n} AS BIGINT) AS n, "
        f"{x} AS x, {y} AS y, {z} AS z, spst_date FROM {source}"
    )


def _run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the five reports in one common shape."""
    gold = _gold_config(spark, sf_dir)
    cfg = replace(gold, in_path="gold", out_path="reports", reporting_database=f"{gold.database}_reporting")
    run_reports(spark, cfg)
    parts = [
        spark.sql(_report_select(name, "STRING", table_name(cfg.reporting_database, name))) for name in REPORT_SHAPES
    ]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "scan_csv": _scan_csv,
    "scan_csv_inferred": _scan_csv_inferred,
    "scan_csv_one_pass": _scan_csv_one_pass,
    "scan_format": _scan_format,
    "scan_parquet": lambda s, d: scan_parquet(s, f"{d}/orders.parquet"),
    "scan_catalog": _scan_catalog,
    "schema_drift": _schema_drift,
    "sink_catalog_append": _sink_catalog_append,
    "sink_catalog_type_change": _sink_catalog_type_change,
    "sink_catalog_type_change_lost": _sink_type_change_lost,
    "sink_overwrite": _sink_overwrite,
    "sink_report_snapshot": _sink_report_snapshot,
    "ddl_reports": _ddl_reports,
    "run_silver": _run_silver,
    "run_silver_quarantine": _silver_quarantine,
    "run_gold": _run_gold,
    "run_gold_csv_silver": _gold_csv_silver,
    "run_gold_two_loads": _gold_two_loads,
    "run_gold_types_lost": _gold_types_lost,
    "run_gold_as_of": _gold_as_of,
    "run_gold_incremental": _gold_incremental,
    "run_reports": _run_reports,
}


def _day(day: date) -> str:
    return f"DATE '{day}'"


_SILVER_GOLD = f"""WITH {v.TX_RAW}, tx AS (
  SELECT * REPLACE (CAST(unit_price AS DECIMAL(12,2)) AS unit_price) FROM tx_raw
  WHERE quantity IS NOT NULL AND unit_price IS NOT NULL),
{v.PRODUCTS_RAW}, products AS (
  SELECT product_id, {v.initcap_sql("category")} AS category, {v.initcap_sql("subcategory")} AS subcategory
  FROM products_raw WHERE price IS NOT NULL AND NOT isnan(price) AND supplier_id IS NOT NULL),
{v.CM}, {v.PM}"""

_REPORTS = {
    "customer_segment_value": r.SEGMENT_VALUE_SQL,
    "customer_activity_analysis": r.ACTIVITY_SQL,
    "category_performance_analysis": r.CATEGORY_SQL,
    "top_performing_subcategories": r.SUBCATEGORY_SQL,
    "customer_purchase_frequency": r.FREQUENCY_SQL,
}

_GOLD_SELECT = """
SELECT CAST(customer_id AS VARCHAR) AS key_1, CAST(NULL AS VARCHAR) AS key_2, total_transactions AS n,
       total_spent AS total, avg_transaction_amount AS mean, first_purchase, last_purchase,
       CAST(NULL AS BIGINT) AS customers FROM cm
UNION ALL SELECT category, subcategory, total_units_sold, total_revenue, avg_price, CAST(NULL AS TIMESTAMP),
       CAST(NULL AS TIMESTAMP), unique_customers FROM pm"""

_GOLD_ROWS = _SILVER_GOLD + _GOLD_SELECT

#: Whole units on the first day, quarters on the second.
_GOLD_QUARTERS = _SILVER_GOLD.replace(
    "AS DECIMAL(12,2)) AS unit_price)",
    "AS DECIMAL(12,2)) AS unit_price, "
    "CAST(quantity * CASE WHEN transaction_id % 2 = 1 THEN 0.25 ELSE 1 END AS DECIMAL(12,2)) AS quantity)",
).replace(v.PM, v.PM_FRACTIONAL)

#: Of each raw row: whether it has a value of the wrong type, and whether it has all that it must have, without that value.
_QUARANTINE_SQL = f"""WITH {v.CUSTOMERS_RAW}, {v.PRODUCTS_RAW}, {v.TX_RAW}, fates AS (
  SELECT 'customers' AS dataset, customer_id % 9 = 4 AS bad, email IS NOT NULL AS kept FROM customers_raw
  UNION ALL SELECT 'products', product_id % 11 = 2,
    price IS NOT NULL AND NOT isnan(price) AND supplier_id IS NOT NULL AND product_id % 11 <> 2 FROM products_raw
  UNION ALL SELECT 'transactions', transaction_id % 13 = 6,
    quantity IS NOT NULL AND unit_price IS NOT NULL AND transaction_id % 13 <> 6 FROM tx_raw)
SELECT dataset, {_day(v.AS_OF)} AS load_date, count(*) AS raw, count(*) FILTER (WHERE kept) AS cleaned,
  count(*) FILTER (WHERE NOT kept AND NOT bad) AS dropped, count(*) FILTER (WHERE NOT kept AND bad) AS quarantined,
  count(*) FILTER (WHERE kept AND bad) AS malformed_kept, true AS adds_up
FROM fates GROUP BY dataset"""

#: The transactions of the second day with every fourth product's other name.
_RENAMED = """FROM (SELECT tx.*, category,
    CASE WHEN transaction_id % 2 = 1 AND product_id % 4 = 0 THEN 'Renamed' ELSE subcategory END AS subcategory
  FROM tx JOIN products USING (product_id))"""

_TYPE_CHANGE = f"""WITH {v.PRODUCTS_RAW}, p AS (
  SELECT product_id, price, CAST(supplier_id AS VARCHAR) AS supplier_id FROM products_raw
  WHERE price IS NULL OR NOT isnan(price))
SELECT product_id, floor(price) AS price, supplier_id FROM p
UNION ALL SELECT * FROM p UNION ALL SELECT product_id, price, 's' || supplier_id FROM p"""

ORACLES = {
    "scan_csv": f"WITH {v.RAW_CUSTOMERS_FILE} SELECT * FROM customers_file",
    "scan_csv_inferred": f"WITH {v.RAW_CUSTOMERS_FILE} SELECT * FROM customers_file",
    "scan_csv_one_pass": f"WITH {v.RAW_CUSTOMERS_FILE} SELECT * FROM customers_file",
    "scan_format": f"WITH {v.TX_RAW} SELECT * FROM tx_raw",
    "scan_parquet": "SELECT * FROM orders",
    "scan_catalog": "SELECT * FROM part",
    "schema_drift": """SELECT * FROM (VALUES
  ('customers', 'city', 5, NULL, 'string', 'add', 'string'),
  ('customers', 'fax', 6, 'string', NULL, 'deprecate', NULL),
  ('products', 'price', 4, 'int', 'double', 'change', 'double'),
  ('transactions', 'transaction_id', 0, NULL, 'int', 'add', 'int'),
  ('transactions', 'customer_id', 1, NULL, 'int', 'add', 'int'),
  ('transactions', 'product_id', 2, NULL, 'int', 'add', 'int'),
  ('transactions', 'transaction_date', 3, NULL, 'timestamp', 'add', 'timestamp'),
  ('transactions', 'quantity', 4, NULL, 'int', 'add', 'int'),
  ('transactions', 'unit_price', 5, NULL, 'double', 'add', 'double'),
  ('transactions', 'payment_method', 6, NULL, 'string', 'add', 'string')
) AS t(dataset, "column", position, old_type, new_type, action, catalog_type)""",
    "sink_catalog_append": f"""WITH {v.CUSTOMERS_RAW}
SELECT customer_id, email, country, CAST(NULL AS VARCHAR) AS city FROM customers_raw
UNION ALL SELECT customer_id, email, country, city FROM customers_raw""",
    "sink_catalog_type_change": _TYPE_CHANGE,
    "sink_catalog_type_change_lost": _TYPE_CHANGE,
    "sink_overwrite": r.ORACLES["process_products"],
    "sink_report_snapshot": f"""{r.GOLD_CM}, report AS ({r.SEGMENT_VALUE_SQL})
SELECT report.*, day AS spst_date FROM report, (VALUES ({_day(v.AS_OF)}), ({_day(NEXT_DAY)})) AS days(day)""",
    "ddl_reports": f"{r.GOLD_CM}, report AS ({r.FREQUENCY_SQL}) SELECT *, true AS dated_today FROM report",
    "run_silver": f"""WITH {v.CUSTOMERS_RAW}, {v.PRODUCTS_RAW}, {v.TX_RAW}
SELECT 'customers' AS dataset, customer_id AS key, lower(email) AS text_1, upper(country) AS text_2,
       CAST(NULL AS DOUBLE) AS num, {_day(v.AS_OF)} AS load_date FROM customers_raw WHERE email IS NOT NULL
UNION ALL SELECT 'products', product_id, {v.initcap_sql("category")}, {v.initcap_sql("subcategory")}, price,
       {_day(v.AS_OF)} FROM products_raw WHERE price IS NOT NULL AND NOT isnan(price) AND supplier_id IS NOT NULL
UNION ALL SELECT 'transactions', transaction_id, CAST(customer_id AS VARCHAR), CAST(product_id AS VARCHAR), unit_price,
       {_day(v.AS_OF)} FROM tx_raw WHERE quantity IS NOT NULL AND unit_price IS NOT NULL""",
    "run_silver_quarantine": _QUARANTINE_SQL,
    "run_gold": _GOLD_ROWS,
    "run_gold_csv_silver": _GOLD_ROWS,
    "run_gold_two_loads": _GOLD_ROWS,
    "run_gold_as_of": _SILVER_GOLD.replace("FROM tx JOIN products USING (product_id)", _RENAMED) + _GOLD_SELECT,
    "run_gold_incremental": _GOLD_ROWS,
    "run_gold_types_lost": f"SELECT * REPLACE (CAST(n AS DOUBLE) AS n) FROM ({_GOLD_QUARTERS}{_GOLD_SELECT})",
    "run_reports": _SILVER_GOLD
    + "\n"
    + "\nUNION ALL ".join(
        _report_select(name, "VARCHAR", f"(SELECT *, {_day(v.AS_OF)} AS spst_date FROM ({sql}))")
        for name, sql in _REPORTS.items()
    ),
}
