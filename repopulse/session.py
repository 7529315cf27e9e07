"""Where jobs keep data that must outlive an executor."""

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    A scratch folder stands in for it only in local mode, where all tasks are on this machine; elsewhere it is an
    error not to name one.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{_CHECKPOINT_DIR} must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="repopulse-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, so reruns never meet older files."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/repopulse/{spark.sparkContext.applicationId}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark can write; nothing happens if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder; call it when its results are written."""
    delete(spark, _own_folder(spark))


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a frame that feeds several jobs to the shared folder and read it back.

    Lost executors then re-read files instead of recomputing the whole job, later steps read only
    the columns they need, and join choices are made on the real size.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
