"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"

_SCOPE: ContextVar[str | None] = ContextVar("scratch folder of the running scope", default=None)


def open_session(app: str = "barlab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; ``conf`` overrides them.

    Keyword names use ``__`` for dots, as in ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share a disk, may go
    without that setting; it then gets a temporary folder of its own.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="barlab-")
        spark.conf.set(CHECKPOINT_KEY, base)
    return base


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder, or the running scope's."""
    base = _SCOPE.get() or shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str = "scope") -> Iterator[str]:
    """Tables ``written`` inside are deleted at the end, so use up what reads them before."""
    folder = fresh_dir(spark, label)
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str = "table") -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Ends the lineage with a single job (``checkpoint()`` would run the plan
    twice), and a lost executor costs at most a re-read. The table stays until
    the ``scratch`` scope ends in which it was written; outside of one it stays.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
