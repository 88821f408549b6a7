"""Tables and files in the folder that all executors share.

The cluster names it in ``spark.checkpoint.dir``. A local folder is made only
for a local master; any other session without the setting is refused, since its
executors could not see such a folder. What is written here goes when the
driver's JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from shopscope.session import checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The shared folder; see the module text."""
    if checkpoint := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return checkpoint
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("executors are processes of their own: set spark.checkpoint.dir")
    return checkpoint_dir(spark, tempfile.mkdtemp(prefix="shopscope-"))


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, removed when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def materialised(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """The rows, written once and read from there, and aggregates of them that
    the write itself observed (no job of their own)."""
    path = new_path(df.sparkSession, name)
    seen = Observation()
    (df.observe(seen, *(c.alias(k) for k, c in measures.items())) if measures else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if measures else {}


def text_files(lines: DataFrame, name: str) -> str:
    """Writes a one-column table of lines as text files; the folder's path."""
    path = new_path(lines.sparkSession, name)
    lines.write.text(path)
    return path
