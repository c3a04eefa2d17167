"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: set[str] = set()

# Settings the engine relies on; applied only where the session leaves them unset.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tracelens") -> SparkSession:
    """Local session for tests and the bench (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tl-wh-"))
        .config("spark.driver.extraJavaOptions", "-Dderby.system.home=" + tempfile.mkdtemp(prefix="tl-derby-"))
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Only a local master (tests, the
    bench) gets a scratch folder when it is unset; elsewhere the executors
    would each write to a disk of their own, so it is an error.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[[^\]]*\])?$", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tl-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables.

    The folder of this application's scratch tables is deleted when the driver
    process ends, or earlier by :func:`drop_scratch`.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{spark.sparkContext.applicationId}"
    if base not in _SCRATCH:
        _SCRATCH.add(base)
        atexit.register(_delete, spark, base)
    return f"{base}/{name}"


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system that owns it (best effort: the session may be gone)."""
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - at exit the gateway can be closed already
        pass


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table that nothing reads any more."""
    if "/tables-" not in path:
        raise ValueError(f"{path} is no scratch table")
    _delete(spark, path)


def stage_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet scratch table in the shared folder and read it back.

    Like a checkpoint this cuts the lineage and survives lost executors, but
    the files are columnar, so later reads prune columns and partitions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
