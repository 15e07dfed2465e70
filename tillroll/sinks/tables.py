"""Sinks: catalog tables, plain paths and report snapshots."""

import re
import uuid
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import versions
from tillroll.sinks.ddl import SNAPSHOT_COLUMN
from tillroll.sqltext import (
    FORMAT_OPTIONS,
    TEXT_FORMATS,
    columns_ddl,
    identifier,
    options_ddl,
    plain_location,
    quoted,
    schema_columns,
    table_name,
)


def write_catalog(
    df: DataFrame,
    database: str,
    table: str,
    path: str,
    fmt: str = "parquet",
    *,
    partition: Mapping[str, date] | None = None,
    mode: str = "append",
) -> None:
    """Write rows under ``path`` and create or update the catalog table over it.

    Columns new to the table are added to it first (older rows read NULL); columns the rows lack are written as NULL.
    A column whose type differs gets a type that holds both (whole numbers, then double, else text): no value is ever
    stored through a narrowing cast. Where the older files can't be read under the new type, they are rewritten into a
    fresh folder beside ``path``. Folder and columns are published as a version under ``path`` (see
    :mod:`tillroll.versions`) before the catalog follows: until then the old version stays readable, and from then on the
    new one is found by ``path`` alone, whatever the catalog knows.
    ``partition`` names one constant partition, as in ``{"load_date": day}``. ``mode`` is 'append', or 'overwrite' to
    replace the rows: of that partition only if one is given, so that a rerun of the same day changes nothing, else of
    the whole table.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    spark, name = df.sparkSession, table_name(database, table)
    partition = dict(partition or {})
    rows = df.drop(*partition)
    bind_table(spark, database, table, path, fmt)
    if spark.catalog.tableExists(name):
        rows = _fit_table(spark, name, rows, path, fmt, partition)
    else:
        _create(spark, name, schema_columns(rows.schema), path, fmt, partition)
    _insert(rows, name, partition, mode)
    if versions.current(spark, path) is None:  # a new table, or one whose folder was emptied to be replaced
        _publish(spark, name, path, _own_columns(spark, name, partition), partition)


def bind_table(spark: SparkSession, database: str, table: str, path: str, fmt: str = "parquet") -> None:
    """Make the catalog follow the current version under ``path``, if there is one.

    A table that the catalog has lost is registered again; one over another folder or with other columns is replaced. A
    table of that name which is not over this path or a folder beside it is left alone.
    """
    version, name = versions.current(spark, path), table_name(database, table)
    if version is None:
        return
    if spark.catalog.tableExists(name):
        described = _described(spark, name)
        at = described.get("Location", "")
        if described.get("Type") != "EXTERNAL" or not _beside(at, path):
            return
        if _folder(at) == _folder(version.location) and version.same_columns(_own_columns(spark, name, version.partition)):
            return
        spark.sql(f"DROP TABLE {name}")
    _create(spark, name, version.columns, version.location, fmt, version.partition)
    if version.partition:
        spark.catalog.recoverPartitions(name)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def _own_columns(spark: SparkSession, name: str, partition: Iterable[str]) -> dict[str, str]:
    return {c: t for c, t in schema_columns(spark.table(name).schema).items() if c not in partition}


def _beside(location: str, path: str) -> bool:
    """Whether a location is the path's own folder or one that a rewrite has made beside it."""
    same_parent = plain_location(location).rpartition("/")[0] == plain_location(path).rpartition("/")[0]
    return same_parent and re.fullmatch(f"{re.escape(_folder(path))}(_[0-9a-f]{{8}})?", _folder(location)) is not None


def _folder(path: str) -> str:
    return path.rstrip("/").rpartition("/")[2]


def _create(
    spark: SparkSession, name: str, columns: Mapping[str, str], path: str, fmt: str, partition: Iterable[str]
) -> None:
    columns = {**columns, **{c: "date" for c in partition}}
    by = f"PARTITIONED BY ({', '.join(map(identifier, partition))})" if partition else ""
    spark.sql(
        f"CREATE TABLE {name} ({columns_ddl(columns)}) USING {fmt} {options_ddl(fmt)} {by} LOCATION '{quoted(path)}'"
    )


_WHOLE = ["tinyint", "smallint", "int", "bigint"]
_EXACT_IN_DOUBLE = 1 << 53


def common_type(old: str, new: str) -> str:
    """The narrowest type that holds the values of both: of whole numbers the wider, with fractions double, else text."""
    if old == new:
        return old
    if old in _WHOLE and new in _WHOLE:
        return _WHOLE[max(_WHOLE.index(old), _WHOLE.index(new))]
    if {old, new} <= {*_WHOLE, "float", "double"}:
        return "double"
    return "string"


def _reads_as(fmt: str, old: str, new: str) -> bool:
    """Whether files that hold ``old`` can be read as ``new``."""
    if fmt in TEXT_FORMATS:
        return old != "string"
    if fmt != "parquet":
        return False
    return (old in _WHOLE and new in _WHOLE) or (old in _WHOLE[:3] and new == "double") or (old, new) == ("float", "double")


def _fit_table(
    spark: SparkSession, name: str, rows: DataFrame, path: str, fmt: str, partition: Mapping[str, date]
) -> DataFrame:
    """Add the rows' new columns to the table and widen its types where needed; gives the rows under its types."""
    table = spark.table(name)
    held = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in table.schema if f.name not in partition}
    columns = schema_columns(rows.schema)
    fresh = {c: t for c, t in columns.items() if c.lower() not in held}
    shared = {c: (*held[c.lower()], t) for c, t in columns.items() if c.lower() in held}
    target = {c: (old_name, common_type(old, new)) for c, (old_name, old, new) in shared.items() if old != new}
    for c, (old_name, type_) in target.items():
        if type_ == "double":
            _refuse_long(rows, c, name)
    wider = {old_name: type_ for old_name, type_ in target.values() if held[old_name.lower()][1] != type_}
    if wider:
        _widen(spark, name, table, wider, path, fmt, partition)
    if fresh:
        _publish(spark, name, path, {**_own_columns(spark, name, partition), **fresh}, partition)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns_ddl(fresh)})")
    return rows.withColumns({c: F.col(identifier(c)).cast(type_) for c, (_, type_) in target.items()})


def _refuse_long(rows: DataFrame, column: str, name: str) -> None:
    """Whole numbers that a double can't hold are refused by name."""
    if dict(rows.dtypes)[column] == "bigint":
        beyond = F.max(F.col(identifier(column)) > _EXACT_IN_DOUBLE) | F.min(F.col(identifier(column)) < -_EXACT_IN_DOUBLE)
        if rows.agg(F.coalesce(beyond, F.lit(False))).first()[0]:
            raise ValueError(f"{column} of {name} is double, but has whole numbers beyond 2 ** 53")


def _widen(
    spark: SparkSession,
    name: str,
    table: DataFrame,
    wider: Mapping[str, str],
    path: str,
    fmt: str,
    partition: Mapping[str, date],
) -> None:
    """Register the external table again with wider types, over the same files if they can be read so.

    Rewritten files are complete before the version that names them is published, and that is before the catalog changes.
    """
    described = _described(spark, name)
    if described.get("Type") != "EXTERNAL":
        raise ValueError(f"{name} owns its data: the types of {sorted(wider)} can't be changed")
    old = schema_columns(table.schema)
    location = described["Location"]
    for c, type_ in wider.items():
        if type_ == "double":
            _refuse_long(table, c, name)
    if not all(_reads_as(fmt, old[c], type_) for c, type_ in wider.items()):
        location = f"{path.rstrip('/')}_{uuid.uuid4().hex[:8]}"
        cast = table.withColumns({c: F.col(identifier(c)).cast(type_) for c, type_ in wider.items()})
        cast.write.format(fmt).options(**FORMAT_OPTIONS.get(fmt, {})).partitionBy(*partition).save(location)
    columns = {c: wider.get(c, t) for c, t in old.items() if c not in partition}
    _publish(spark, name, path, columns, partition, location)
    spark.sql(f"DROP TABLE {name}")
    _create(spark, name, columns, location, fmt, partition)
    if partition:
        spark.catalog.recoverPartitions(name)


def _publish(
    spark: SparkSession, name: str, path: str, columns: Mapping[str, str], partition: Iterable[str], location: str | None = None
) -> None:
    """A version of a table with these columns, at ``location`` or where it is. Tables over other folders have none."""
    at = location or _described(spark, name).get("Location", "")
    if _beside(at, path):
        beside = f"{path.rstrip('/').rpartition('/')[0]}/{_folder(at)}"  # spelled as the path is
        versions.publish(spark, path, beside, dict(columns), list(partition))


def _insert(rows: DataFrame, name: str, partition: Mapping[str, date], mode: str) -> None:
    spark = rows.sparkSession
    into = "INTO" if mode == "append" else "OVERWRITE TABLE"
    first = bool(partition) and not spark.sql(f"SHOW PARTITIONS {name}").take(1)
    spark.sql(f"INSERT {into} {name} {_partition_spec(partition)} BY NAME SELECT * FROM {{rows}}", rows=rows)
    if first:  # a table registered over a folder that may already hold other days
        spark.catalog.recoverPartitions(name)


def _partition_spec(partition: Mapping[str, date]) -> str:
    spec = ", ".join(f"{identifier(c)} = DATE'{day.isoformat()}'" for c, day in partition.items())
    return f"PARTITION ({spec})" if spec else ""


def write_overwrite(
    df: DataFrame, path: str, fmt: str = "parquet", *, database: str | None = None, table: str | None = None
) -> None:
    """Replace what lies under ``path``; with ``database`` and ``table``, register it in the catalog as well.

    Never give a path the rows are read from: Spark empties it before it reads.
    """
    writer = df.write.format(fmt).mode("overwrite").options(**FORMAT_OPTIONS.get(fmt, {}))
    if table is None:
        writer.save(path)
    else:
        writer.option("path", path).saveAsTable(table_name(database, table))


def write_snapshot(df: DataFrame, database: str, table: str, as_of: date, mode: str = "overwrite") -> None:
    """Put a report's rows into its table as the snapshot of one day.

    'overwrite' replaces that day's snapshot and no other; 'append' adds to it.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be 'append' or 'overwrite', not {mode!r}")
    _insert(df, table_name(database, table), {SNAPSHOT_COLUMN: as_of}, mode)
