"""Schema discovery over a folder of raw datasets, and its comparison with the catalog.

Policy: every dataset is read again on every run; new and changed columns update the catalog; vanished ones stay and
are marked as deprecated.
"""

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.infer import infer_text_schemas
from tillroll.sources.scan import scan_format
from tillroll.sqltext import columns_ddl, quoted, schema_columns, table_name

ADD, CHANGE, MOVE, DEPRECATE = "add", "change", "move", "deprecate"
DEPRECATED_PROPERTY = "deprecated.columns"

_FIELDS = "dataset string, column string, position int, type string"


def discover_datasets(spark: SparkSession, base: str) -> dict[str, str]:
    """Name and path of each dataset: the files and folders directly under ``base``, named without extension.

    Lists that one level only. Names that start with a dot or an underscore are passed over, and two entries of one
    name are refused.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(base)
    listed = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    entries = [e for e in (status.getPath().getName() for status in listed) if not e.startswith((".", "_"))]
    names = [entry.split(".")[0] for entry in entries]
    if len(set(names)) < len(names):
        raise ValueError(f"each dataset under {base} needs a name of its own, found {sorted(entries)}")
    return {name: f"{base.rstrip('/')}/{entry}" for name, entry in sorted(zip(names, entries))}


def infer_schemas(spark: SparkSession, datasets: dict[str, str], fmt: str = "csv") -> dict[str, T.StructType]:
    """Schema of each dataset as Spark infers it from all its rows. CSV datasets are read once each, all in one job."""
    if fmt == "csv":
        return infer_text_schemas({name: spark.read.option("header", True).csv(path) for name, path in datasets.items()})
    return {name: scan_format(spark, path, fmt).schema for name, path in datasets.items()}


def catalog_schemas(spark: SparkSession, database: str) -> dict[str, T.StructType]:
    """Schema of each table of the database, without columns already marked as deprecated."""
    schemas = {}
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        gone = _deprecated(spark, table_name(database, table.name))
        fields = spark.table(table_name(database, table.name)).schema.fields
        schemas[table.name] = T.StructType([f for f in fields if f.name not in gone])
    return schemas


def schema_drift(
    spark: SparkSession, found: dict[str, T.StructType], known: dict[str, T.StructType]
) -> DataFrame:
    """Columns that differ between the found and the known schemas.

    One row per difference: dataset, column, position, old_type, new_type and the action the policy takes. A dataset
    the catalog doesn't know gives an 'add' for each column, a vanished one a 'deprecate' for each. A 'move' is a column
    of unchanged type whose place among the columns of both schemas differs.
    """
    new = _field_list(spark, found).alias("new")
    old = _field_list(spark, known).alias("old")
    both = F.col("old.type").isNotNull() & F.col("new.type").isNotNull()
    columns_of = Window.partitionBy("dataset", both)
    compared = old.join(new, ["dataset", "column"], "full_outer").select(
        "dataset",
        "column",
        F.coalesce("new.position", "old.position").alias("position"),
        F.col("old.type").alias("old_type"),
        F.col("new.type").alias("new_type"),
        F.when(F.col("old.type").isNull(), ADD)
        .when(F.col("new.type").isNull(), DEPRECATE)
        .when(F.col("old.type") != F.col("new.type"), CHANGE)
        .when(
            F.row_number().over(columns_of.orderBy("old.position"))
            != F.row_number().over(columns_of.orderBy("new.position")),
            MOVE,
        )
        .alias("action"),
    )
    return compared.filter(F.col("action").isNotNull())


def _field_list(spark: SparkSession, schemas: dict[str, T.StructType]) -> DataFrame:
    rows = [
        (name, f.name, i, f.dataType.simpleString())
        for name, schema in schemas.items()
        for i, f in enumerate(schema.fields)
    ]
    return spark.createDataFrame(rows, _FIELDS)


def apply_drift(
    spark: SparkSession,
    drift: DataFrame,
    database: str,
    datasets: dict[str, str],
    found: dict[str, T.StructType],
    fmt: str = "csv",
) -> None:
    """Bring the catalog up to date with a drift table.

    An unknown dataset becomes an external table over its files. Columns that vanished stay, after all others, and are
    listed in the table property ``deprecated.columns``, as JSON. Columns new at the end are added in place. A changed type, or
    in CSV (which is read by position) a changed order, re-registers the external table over the same files, since
    Spark can't alter those in place; a table that owns its data is refused that.
    """
    changes = [r["dataset"] for r in drift.select("dataset").distinct().collect()]  # names of datasets only
    for dataset in sorted(changes):
        name = table_name(database, dataset)
        wanted = schema_columns(found[dataset]) if dataset in found else {}
        if not spark.catalog.tableExists(name):
            _register(spark, name, wanted, datasets[dataset], fmt, set())
            continue
        held = schema_columns(spark.table(name).schema)
        marked, deprecated = _deprecated(spark, name), held.keys() - wanted.keys()
        target = wanted | {c: type_ for c, type_ in held.items() if c in deprecated}
        retyped = any(target[c] != type_ for c, type_ in held.items())
        moved = fmt == "csv" and wanted and list(target)[: len(held)] != list(held)
        if retyped or moved:
            _refuse_owned(spark, name)
            spark.sql(f"DROP TABLE {name}")
            _register(spark, name, target, datasets[dataset], fmt, deprecated)
            continue
        fresh = {c: type_ for c, type_ in target.items() if c not in held}
        if fresh:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl(fresh)})")
        if deprecated != marked:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_mark(deprecated)})")


def _register(
    spark: SparkSession, name: str, columns: dict[str, str], path: str, fmt: str, deprecated: set[str]
) -> None:
    options = "OPTIONS (header 'true')" if fmt == "csv" else ""  # as the schema was inferred
    spark.sql(
        f"CREATE TABLE {name} ({columns_ddl(columns)}) USING {fmt} {options} LOCATION '{quoted(path)}' "
        f"TBLPROPERTIES ({_mark(deprecated)})"
    )


def _refuse_owned(spark: SparkSession, name: str) -> None:
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if described.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} owns its data: a column's type or place can't be changed")


def _mark(deprecated: set[str]) -> str:
    return f"'{DEPRECATED_PROPERTY}' = '{quoted(json.dumps(sorted(deprecated)))}'"


def _deprecated(spark: SparkSession, name: str) -> set[str]:
    marks = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == DEPRECATED_PROPERTY).collect()
    return {c for row in marks for c in json.loads(row["value"])}
