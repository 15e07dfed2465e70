"""Versions of a table: where its files lie and which types they have, kept beside the files.

A table is known by its configured path. Each change of its columns or its folder is a version, a small file
``path/_versions/<number>`` that names the folder (the path's own, or one beside it), the columns with their types and the
partition columns. The one with the highest number counts. It is written under another name first and then renamed to a
number that nobody holds yet, so readers see the old version or the new one, and of two writers one is refused. So the
catalog can be lost, or fall behind, and every row is still found, under its right type.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

FOLDER = "_versions"


@dataclass(frozen=True)
class Version:
    """``number`` rises by one; ``columns`` are name and type in order, without the partition columns (all dates)."""

    number: int
    location: str
    columns: dict[str, str]
    partition: list[str]

    def same_columns(self, columns: dict[str, str]) -> bool:
        return list(self.columns.items()) == list(columns.items())


def _open(spark: SparkSession, path: str):
    """The file system of a path, the folder of its versions, and Hadoop's Path class."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path.rstrip('/')}/{FOLDER}")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder, hadoop.Path


def _numbers(fs, folder) -> list[int]:
    if not fs.exists(folder):
        return []
    return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.isdigit())


def _parent(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that counts; None for a path that has none."""
    fs, folder, new_path = _open(spark, path)
    numbers = _numbers(fs, folder)
    if not numbers:
        return None
    stream = fs.open(new_path(folder, f"{numbers[-1]:08d}"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(text)
    return Version(numbers[-1], f"{_parent(path)}/{held['folder']}", dict(held["columns"]), held["partition"])


def publish(spark: SparkSession, path: str, location: str, columns: dict[str, str], partition: list[str]) -> Version:
    """Make a new version the one that counts. ``location`` is the path itself or a folder beside it."""
    if _parent(location) != _parent(path):
        raise ValueError(f"{location} is not beside {path}")
    fs, folder, new_path = _open(spark, path)
    number = max(_numbers(fs, folder), default=0) + 1
    held = {"folder": location.rstrip("/").rpartition("/")[2], "columns": list(columns.items()), "partition": partition}
    draft, final = new_path(folder, f".{uuid.uuid4().hex}"), new_path(folder, f"{number:08d}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(held).encode()))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer published version {number} of {path}")
    return Version(number, location, dict(columns), list(partition))
