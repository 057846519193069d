"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def get_spark(app: str = "roaskit", cpus: int | str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with AQE on, the UI off and the session zone pinned to UTC.

    On a cluster the master and resources come from spark-submit; ``cpus`` only
    matters for local runs.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if not _submitted("spark.master") and not os.environ.get("SPARK_MASTER"):
        cpus = cpus or os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(f"local[{cpus}]").config(
            "spark.driver.memory", os.environ.get("ROASKIT_DRIVER_MEMORY", "16g"))
        if shuffle_partitions is None and not _submitted("spark.sql.shuffle.partitions"):
            shuffle_partitions = int(cpus) if str(cpus).isdigit() else 8
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _submitted(key: str) -> bool:
    """Whether the launch already sets ``key``: spark-submit (whose JVM is running by now) or the submit arguments."""
    if SparkContext._active_spark_context is not None:
        return SparkContext._active_spark_context.getConf().contains(key)
    if SparkContext._jvm is not None or "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        return SparkConf(loadDefaults=True).contains(key)
    said = os.environ.get("PYSPARK_SUBMIT_ARGS", "")
    return key in said or (key == "spark.master" and "--master" in said)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local tests)
    do we create a private one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="roaskit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def importable_in_workers(spark: SparkSession) -> None:
    """Let local Python workers import this package; on a cluster it is shipped with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


_AT_EXIT: list[tuple[SparkSession, str]] = []


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables when the process ends, as the frames that read it end with it."""
    if not _AT_EXIT:
        atexit.register(_delete_all)
    _AT_EXIT.append((spark, path))


def _delete_all() -> None:
    for spark, path in _AT_EXIT:
        context = spark.sparkContext
        if context._jsc is not None and not context._jsc.sc().isStopped():
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
