"""Several reports published as one.

The reports of a run are first written in full into tables of the same make in a folder of the run. One small file, written
under another name and renamed, then says that the run is complete: that is the switch. Only after it are the public
snapshots replaced by what the run holds. A run that fails before the switch leaves every public report as it was; one that
fails after it is finished by the next call, whichever day that is for, and repeating a part of it changes nothing.
"""

import json
import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from tillroll.sinks.ddl import REPORT_TABLES, SNAPSHOT_COLUMN, create_report_tables, ensure_database
from tillroll.sinks.tables import write_snapshot
from tillroll.sqltext import identifier

_RUNS, _COMPLETE = "_runs", "complete.json"


def publish_snapshots(
    spark: SparkSession,
    reports: Mapping[str, DataFrame],
    database: str,
    location: str,
    as_of: date,
    mode: str = "overwrite",
) -> None:
    """Put the reports into their tables under ``location`` as the snapshots of one day, all of them or none.

    'append' adds rows to the day's snapshots, one report after the other: added rows can't be told from a repetition, so
    there is no switch.
    """
    finish_publications(spark, database, location)
    if mode != "overwrite":
        for name, df in reports.items():
            write_snapshot(df, database, name, as_of, mode)
        return
    run = f"{as_of.isoformat()}_{uuid.uuid4().hex[:12]}"
    folder = f"{location.rstrip('/')}/{_RUNS}/{run}"
    own = f"{database}_run_{run[11:]}"
    ensure_database(spark, own)  # not over the run's folder, which would go with it
    try:
        create_report_tables(spark, own, folder)  # so that lengths and types are checked before the switch
        for name, df in reports.items():
            write_snapshot(df, own, name, as_of)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {identifier(own)} CASCADE")  # external tables: the files stay
    _say_complete(spark, folder, as_of, list(reports))
    finish_publications(spark, database, location)


def finish_publications(spark: SparkSession, database: str, location: str) -> None:
    """Bring the public reports up to every complete run under ``location``, in the order of their completion."""
    fs, runs, new_path = _files(spark, f"{location.rstrip('/')}/{_RUNS}")
    if not fs.exists(runs):
        return
    marks = [new_path(status.getPath(), _COMPLETE) for status in fs.listStatus(runs)]
    marks = [(fs.getFileStatus(mark).getModificationTime(), mark) for mark in marks if fs.exists(mark)]
    for _, mark in sorted(marks, key=lambda m: (m[0], m[1].toString())):
        told = json.loads(_text(spark, fs, mark))
        as_of, folder = date.fromisoformat(told["as_of"]), mark.getParent().toString()
        for name in told["reports"]:
            columns = ", ".join(f"{c} {t.split('(')[0].replace('VARCHAR', 'STRING')}" for c, t in REPORT_TABLES[name].items())
            rows = spark.read.schema(columns).parquet(f"{folder}/{name}/{SNAPSHOT_COLUMN}={as_of.isoformat()}")
            write_snapshot(rows, database, name, as_of)
        fs.delete(mark.getParent(), True)


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, hadoop.Path


def _text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _say_complete(spark: SparkSession, folder: str, as_of: date, reports: list[str]) -> None:
    fs, base, new_path = _files(spark, folder)
    draft, final = new_path(base, f".{_COMPLETE}"), new_path(base, _COMPLETE)
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps({"as_of": as_of.isoformat(), "reports": reports}).encode()))
    finally:
        stream.close()
    if not fs.rename(draft, final):
        raise RuntimeError(f"{final} can't be written")
