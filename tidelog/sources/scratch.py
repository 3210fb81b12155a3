"""Tables written once between steps, where the session keeps shared files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """The session's own folder in spark.checkpoint.dir, or in the folder that setCheckpointDir() has named.

    A folder of this machine is used only where neither is set and all runs on this machine, as in tests.
    """
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        at = _local.setdefault(sc.applicationId, _local.get(sc.applicationId) or tempfile.mkdtemp(prefix="scratch-"))
    return f"{at.rstrip('/')}/tidelog-{sc.applicationId}"


def folder(spark: SparkSession) -> str:
    """A new folder of the session."""
    return f"{root(spark)}/{uuid.uuid4().hex}"


def delete(spark: SparkSession, at: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Deletes the tables of written() that df reads, once nothing reads them any more."""
    for at in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete(df.sparkSession, at)


def clear(spark: SparkSession) -> None:
    """Deletes all that written() has kept in this session; for the owner of the session, once results are stored."""
    delete(spark, root(spark))


def written(df: DataFrame) -> DataFrame:
    """df as a table: later readers prune its columns and never compute it again."""
    at = f"{folder(df.sparkSession)}/t"
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
