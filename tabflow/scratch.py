"""Where intermediate tables are written: the folder the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

#: Set to true where a ``file:`` scratch folder is a mount that all executors share.
SHARED_MOUNT = "spark.tabflow.scratch.sharedMount"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below ``spark.checkpoint.dir``.

    Without that setting a local session falls back to a temporary folder; a
    cluster session is refused, because its executors share no local disk. For the
    same reason a cluster of several machines may not use a ``file:`` folder,
    unless ``spark.tabflow.scratch.sharedMount`` says that it is a shared mount.
    """
    master = spark.sparkContext.master
    one_machine = master.startswith("local")
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not one_machine or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tabflow-")
    elif base.startswith("file:") and not one_machine:
        if spark.conf.get(SHARED_MOUNT, "false").lower() != "true":
            raise RuntimeError(f"{base} is local to each machine; see {SHARED_MOUNT}")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the scratch folder and read from there.

    For a result that several jobs use: it is computed once, and a lost
    executor costs a read instead of the whole lineage.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Staged tables of one job; leaving the block deletes their folders.

    For jobs whose result is complete by then, not for plans that are still lazy.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(scratch_path(self.spark, name))
        return _written(df, self.paths[-1])

    def __exit__(
        self, kind: type | None, error: BaseException | None, trace: TracebackType | None
    ) -> None:
        for path in self.paths:
            remove(self.spark, path)
