"""Databases and report tables."""

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tillroll.sqltext import columns_ddl, identifier, options_ddl, plain_location, quoted, schema_columns, table_name

SNAPSHOT_COLUMN = "spst_date"

# Names, types and lengths of the report tables.
REPORT_TABLES = {
    "customer_segment_value": {
        "customer_segment": "VARCHAR(12)",
        "customer_count": "BIGINT",
        "avg_spent": "DOUBLE",
        "avg_transactions": "BIGINT",
    },
    "customer_activity_analysis": {
        "total_customers": "BIGINT",
        "active_90_days": "BIGINT",
        "inactive_90_days": "BIGINT",
        "avg_customer_lifespan": "BIGINT",
    },
    "category_performance_analysis": {
        "category": "VARCHAR(100)",
        "category_revenue": "DOUBLE",
        "category_units": "BIGINT",
        "total_customers": "BIGINT",
        "category_avg_price": "DOUBLE",
        "revenue_per_customer": "DOUBLE",
    },
    "top_performing_subcategories": {
        "category": "VARCHAR(100)",
        "subcategory": "VARCHAR(100)",
        "total_revenue": "DOUBLE",
        "total_units_sold": "BIGINT",
        "category_revenue_share": "DOUBLE",
    },
    "customer_purchase_frequency": {
        "frequency_segment": "VARCHAR(29)",
        "customer_count": "BIGINT",
        "avg_total_spent": "DOUBLE",
        "avg_transaction_value": "DOUBLE",
    },
}


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database if absent. Never drops one."""
    at = f"LOCATION '{quoted(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {identifier(database)} {at}")


def register_table(
    spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> None:
    """Make the files under ``path`` a table of the catalog.

    A table of that name over another folder is registered again over ``path``; one that owns its data is refused that.
    Text formats need the ``schema``; others bring their own.
    """
    ensure_database(spark, database)
    name = table_name(database, table)
    if spark.catalog.tableExists(name):
        described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        if plain_location(described.get("Location", "")) == plain_location(path):
            return
        if described.get("Type") != "EXTERNAL":
            raise ValueError(f"{name} owns its data under {described.get('Location')}, not under {path}")
        spark.sql(f"DROP TABLE {name}")
    columns = f"({columns_ddl(schema_columns(schema))})" if schema else ""
    spark.sql(f"CREATE TABLE {name} {columns} USING {fmt} {options_ddl(fmt)} LOCATION '{quoted(path)}'")


def create_report_tables(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the five report tables: zstd Parquet, checked text lengths, one partition per snapshot date.

    ``spst_date`` defaults to the current date for inserts that name their columns. With ``location`` the tables are
    external, each in its own folder there.
    """
    ensure_database(spark, database, location)
    for table, columns in REPORT_TABLES.items():
        at = f"LOCATION '{quoted(location.rstrip('/'))}/{table}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table_name(database, table)} "
            f"({columns_ddl(columns)}, {SNAPSHOT_COLUMN} DATE DEFAULT current_date()) "
            f"USING parquet {options_ddl('parquet')} PARTITIONED BY ({SNAPSHOT_COLUMN}) {at}"
        )
