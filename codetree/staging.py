"""Staged tables: the one place where the engine writes intermediate data.

A staged table is written as parquet to the folder the cluster names in
``spark.checkpoint.dir`` and read back. That does three things a cached
DataFrame does not: lineage is cut in storage that outlives an executor, every
reader prunes columns for itself, and the planner knows the true size of the
table. The last point is the size check behind every broadcast in this
package: nothing is hinted; Spark broadcasts a staged side when its files are
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Temporary folders of local sessions without a configured one, by application.
_local_dirs: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared scratch folder of the session; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="codetree-")
    return _local_dirs[context.applicationId]


def _session_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/codetree/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A folder of its own in the session's shared folder."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads the written table."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; results not yet written are lost with it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

