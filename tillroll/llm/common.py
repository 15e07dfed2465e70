"""Helpers that several operators share: tables, staging, and trees of groups that no hot key can overload."""

import atexit
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a cut lineage that outlives lost executors."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def site_count(spark: SparkSession) -> int:
    """The leaves of a tree of groups: a power of two near the number of shuffle partitions, 16 at least."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 1 << (n - 1).bit_length())


def site_of(column: Column, sites: int) -> Column:
    """Where a row starts: spread evenly, and the same on every attempt."""
    return F.pmod(F.xxhash64(column, F.lit("site")), F.lit(sites)).cast("int")


def ascend(rows: DataFrame, keys: list[str], best: str, sites: int, fan_in_bits: int = 3) -> DataFrame:
    """One row for each group of ``keys``: its largest ``best`` and its number of rows, ``members``.

    ``rows`` carry ``site``. Each site reduces its own rows to a run with one entry per group. In every round, 2 **
    ``fan_in_bits`` neighbouring sites send their runs to one of them, which merges them, until one run per key range
    is left. So a group of any size reaches a task as a few entries per round.
    """
    runs = rows.groupBy(*keys, "site").agg(F.max(best).alias(best), F.count(F.lit(1)).alias("members"))
    while sites > 1:
        sites = max(1, sites >> fan_in_bits)
        up = F.shiftright("site", fan_in_bits) if sites > 1 else F.lit(0)
        runs = (
            runs.withColumn("site", up)
            .groupBy(*keys, "site")
            .agg(F.max(best).alias(best), F.sum("members").alias("members"))
        )
    return runs.drop("site")


def descend(rows: DataFrame, classes: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of their group in ``classes``, by way of the sites.

    A group's row meets one entry per site first, and each entry then only the rows of its own site.
    """
    leaves = rows.select(*keys, "site").distinct()
    return rows.join(leaves.join(classes, keys), [*keys, "site"])


def only_ids(docs: DataFrame, ids: DataFrame, id_col: str, broadcast_rows: int = 1 << 20) -> DataFrame:
    """The rows of ``docs`` whose ``id_col`` is in ``ids``. The ids are counted: few are broadcast, many are shuffled."""
    ids = ids.select(id_col).distinct()
    small = ids.limit(broadcast_rows + 1).count() <= broadcast_rows
    return docs.join(F.broadcast(ids) if small else ids, id_col, "left_semi")


def row_keys(docs: DataFrame) -> list[Column]:
    """128 bits that tell rows with another id or another text apart, null or not. Rows that repeat both are the same."""
    parts = [x for c in ("doc_id", "text") for x in (docs[c].isNull(), docs[c])]
    return [F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until ``df`` has no such column."""
    held, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in held:
            name = f"_{name}"
        out.append(name)
    return out


def match_rows(docs: DataFrame, keys: DataFrame, how: str, broadcast_rows: int = 1 << 20) -> DataFrame:
    """``docs`` joined on :func:`row_keys` with ``keys``, whose first two columns hold them; ``how`` as in ``join``.

    The keys are counted: few are broadcast, so the texts stay where they are; many are shuffled. Of ``keys``' other
    columns an inner join adds all, under their names, which ``docs`` must not have.
    """
    a, b, *more = keys.columns
    x, y, u, v = unused(docs, "row_key_1", "row_key_2", "key_1", "key_2")
    keys = keys.select(F.col(a).alias(u), F.col(b).alias(v), *more)
    small = keys.limit(broadcast_rows + 1).count() <= broadcast_rows
    one, two = row_keys(docs)
    keyed = docs.withColumns({x: one, y: two})
    keys = F.broadcast(keys) if small else keys
    return keyed.join(keys, (F.col(x) == F.col(u)) & (F.col(y) == F.col(v)), how).drop(x, y, u, v)


_shipped: set[str] = set()

#: Bytes in a batch that goes to a Python task: 8 MB, where the session has Spark's own 64 MB. Rows hold whole texts and
#: sets, and both sides of the pipe hold a batch several times over.
BATCH_BYTES, SPARKS_OWN, OURS = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: Python tasks import it, however it was installed here.

    Where the session has Spark's own bound on the bytes of a batch, it is lowered to ``OURS``, for the session: the
    operators are lazy, so their Python tasks run after the call that makes them.
    """
    if spark.conf.get(BATCH_BYTES) == SPARKS_OWN:
        spark.conf.set(BATCH_BYTES, OURS)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tillroll-py-")  # on the driver, which serves the file to the executors
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def map_rows(df: DataFrame, rows: Callable[[pa.RecordBatch], list[tuple]], schema: str) -> DataFrame:
    """``rows`` makes a list of tuples from a few rows of ``df`` at a time; they become a DataFrame of ``schema``."""
    ship(df.sparkSession)
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 1024):
                made = rows(batch.slice(i, 1024))
                columns = zip(*made, strict=True) if made else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(one, schema)
