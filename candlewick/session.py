"""Spark session settings the library relies on.

Every model pins the session time zone to UTC (dates and hours of a candle are
taken in UTC), keeps ANSI mode on (a bad cast or a division by zero raises, as
the relational store behind the original job does) and leaves adaptive query
execution on, so that small aggregated sides are broadcast only after their
real size was measured at runtime.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime settings that a model needs; applied to an existing session too.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def pin_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the models depend on (idempotent)."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir`` (a folder every executor
    can reach).  Only a ``local[...]`` session (tests, benches) without that
    setting gets a fresh scratch folder; on a cluster a missing setting is an
    error, never a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        plain = configured.removeprefix("file://").removeprefix("file:")
        if not spark.sparkContext.master.startswith("local") and plain.startswith(tempfile.gettempdir() + "/"):
            raise RuntimeError("spark.checkpoint.dir is a temporary folder of one machine; name a shared one")
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "candlewick",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` defaults to ``local[$SPARK_CPUS or *]`` for tests and benches;
    on a cluster pass ``None`` through ``spark-submit`` configuration instead.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None:
        master = f"local[{os.environ.get('SPARK_CPUS', '*')}]"
    builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.update(
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
            "spark.driver.memory": os.environ.get("SPARK_DRIVER_MEMORY", "8g"),
        }
    )
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return pin_conf(spark)


# Paths written so far, one list per open scope; the first is the session's own.
_SCOPES: list[list[str]] = [[]]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under the shared checkpoint folder; it belongs to the innermost
    open ``scratch_scope``, or else lives until ``release_scratch``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCOPES[-1].append(path)
    return path


def _delete(spark: SparkSession, paths: list[str]) -> int:
    """Delete folders through the Hadoop FileSystem of each path."""
    jvm, conf, removed = spark._jvm, spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(p.getFileSystem(conf).delete(p, True))
    return removed


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Scratch folders made inside are deleted at the end, also after an error;
    those of frames made outside stay."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES.remove(own)
        _delete(spark, own)


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that no scope owns.  Call it after the results
    that read them have been written or collected."""
    paths, _SCOPES[0][:] = list(_SCOPES[0]), []
    return _delete(spark, paths)
