"""Names and folders of streaming runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_id(batch: DataFrame) -> str:
    """Id of the streaming query that runs this micro-batch, kept in its checkpoint: a restart has the same, a new checkpoint another."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise RuntimeError("not inside a streaming micro-batch")
    return found


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """The whole path, without its scheme and host."""
    system, target = _file_system(spark, path)
    return system.makeQualified(target).toUri().getPath()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on any Hadoop file system; errors other than its absence are raised."""
    system, target = _file_system(spark, path)
    return system.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    system, target = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(target) if f.isDirectory()) if system.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing needs any more, if it is there."""
    system, target = _file_system(spark, path)
    system.delete(target, True)
