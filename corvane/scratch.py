"""Shared scratch space: cut lineage by writing a table in the folder the cluster names.

The folder is ``spark.checkpoint.dir`` of the session. Where it is unset, a local session (tests) gets
a temporary folder; a cluster session is refused, because a machine-local folder is not shared.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by driver and executors."""
    folder = spark.conf.get(KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise ValueError(f"{KEY} must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="corvane-")
    spark.conf.set(KEY, folder)
    return folder


class Scratch:
    """Tables written during one operator; ``drop`` frees those that are superseded, the rest go when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{scratch_dir(spark)}/corvane-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and return the written table, which has no lineage."""
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing will read again."""
        path = self.paths.pop(id(df), None)
        if path:
            jvm = self.spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
