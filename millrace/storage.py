"""Tables and paths in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that removes a plan's shuffle files when its execution ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``; where that is unset, in a temporary one, on a local master only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's path of ``path`` and the file system it is on."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = file_system(spark, path)
    fs.delete(p, True)


class Tables:
    """Intermediate tables of one computation: written once, read from there, deleted together when no plan reads them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        path, before = shared_path(self.spark, tag), self.spark.conf.get(SHUFFLE_CLEANUP, "false")
        self.spark.conf.set(SHUFFLE_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(SHUFFLE_CLEANUP, before)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        while self.paths:
            delete(self.spark, self.paths.pop())
