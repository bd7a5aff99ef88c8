"""Session construction and the few runtime settings every job relies on."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Semantics depend on these: naive timestamps are UTC wall time, and every
# coercion is written with try_* so ANSI mode may stay on.
_RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast by the size it has at run time, not by a guess: the planner takes a column's
    # share of the compressed files, so the keys of a table of millions of rows went through the driver
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # HotSpot never compiles a method of more bytecode: one generated for a wide projection runs interpreted,
    # several times slower than the same expressions without whole-stage code
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # JSON objects with a repeated key: the last value wins, as with json.loads
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the operators assume (idempotent)."""
    for key, value in _RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_end_with_query(spark: SparkSession) -> Iterator[None]:
    """Inside, an execution's shuffle files go when it ends. Otherwise they stay until the driver happens to collect its
    garbage, so a job of many steps holds the shuffles of all of them. Not for code that runs one DataFrame object twice."""
    before = spark.conf.get(_SHUFFLES_END, None)
    spark.conf.set(_SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_END)
        else:
            spark.conf.set(_SHUFFLES_END, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared folder and is used as is. Only when
    it is unset (local tests) do we create a scratch folder of our own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            # a machine-local folder is invisible to other executors and lost with them
            raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (hdfs://, s3a://, ...) "
                               "in the cluster configuration")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    try:
        spark.sparkContext.setCheckpointDir(configured)
    except Exception:  # Spark Connect: the server owns the context
        pass
    return configured


def get_spark(master: str | None = None, app: str = "tidewater",
              shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g"),
        **_RUNTIME_DEFAULTS,
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session_defaults(spark)
