"""Session settings and the shared scratch folder."""

import atexit
import tempfile
import uuid
from contextlib import suppress
from functools import cache

from pyspark.sql import SparkSession


def build_session(app_name: str = "tillroll", **conf: object) -> SparkSession:
    """A session in UTC and ANSI mode, with adaptive execution and its skew handling. ``conf`` entries win.

    Sizes that depend on the cluster and the data (shuffle partitions, memory) are left to spark-submit.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path in the session's own part of the shared folder that ``spark.checkpoint.dir`` names.

    Where that is unset, a local session gets a temporary folder; a cluster session is refused, since its executors
    don't share one. The session's part is removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = _local_base()
    own = f"{base.rstrip('/')}/tillroll-{spark.sparkContext.applicationId}"
    _remove_at_exit(spark, own)
    return f"{own}/{name}_{uuid.uuid4().hex[:12]}"


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="tillroll-")


_removed_at_exit: set[str] = set()


def _remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Only what this session wrote: the folder carries its application id."""
    if folder in _removed_at_exit:
        return
    _removed_at_exit.add(folder)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def remove() -> None:
        with suppress(Exception):  # the JVM may be gone by then
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)

    atexit.register(remove)
