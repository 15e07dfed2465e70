"""Scans. All are lazy; with a declared schema none of them runs a job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll import versions
from tillroll.sqltext import FORMAT_OPTIONS, columns_ddl, table_name

CORRUPT_COLUMN = "_corrupt_record"


def scan_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    *,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV with a header row.

    With ``schema`` the files are read once, the header must match it, and a token that doesn't fit its type reads as
    NULL; ``corrupt_column`` then adds a column holding the raw line of each such row (or short or long row), else NULL.
    Without ``schema`` the types are inferred, which reads the files twice.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def header_schema(spark: SparkSession, path: str, declared: T.StructType) -> T.StructType:
    """Schema of CSV files in the order of their header: declared types by name, text for columns not declared.

    Reads one line, so files whose columns moved or grew keep their single pass without inference.
    """
    fields = {f.name.lower(): f for f in declared.fields}
    names = spark.read.option("header", True).csv(path).columns
    return T.StructType([fields.get(name.lower(), T.StructField(name, T.StringType())) for name in names])


def scan_format(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | None = None, **options: object
) -> DataFrame:
    """Files of any format Spark can read. CSV gets a header, which must match ``schema``; without one, inferred types."""
    if fmt == "csv":
        options = {"header": True, **({"enforceSchema": False} if schema else {"inferSchema": True}), **options}
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def scan_parquet(spark: SparkSession, root: str) -> DataFrame:
    """A Parquet table by its root folder. (``root/*`` would lose the partition columns.)"""
    return spark.read.parquet(root)


def scan_versioned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table that :func:`tillroll.sinks.write_catalog` keeps, by its configured path, without a catalog.

    The folder and the types are those of the current version; a path without one is read as it is.
    """
    version = versions.current(spark, path)
    if version is None:
        return scan_format(spark, path, fmt)
    columns = {**version.columns, **{c: "date" for c in version.partition}}
    reader = spark.read.format(fmt).schema(columns_ddl(columns)).options(**FORMAT_OPTIONS.get(fmt, {}))
    return reader.load(version.location)


def scan_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(table_name(database, table))
