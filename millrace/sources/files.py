"""Local and remote file sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """path, length, modificationTime. ``content`` is pruned, and length predicates reach the scan."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", "length", "modificationTime")


def contents(spark: SparkSession, path: str, most_bytes: int | None = None) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return (files.filter(F.col("length") <= most_bytes) if most_bytes is not None else files).select("path", "length", "content")


def with_sizes(requests: DataFrame, files: DataFrame, source: str = "source") -> DataFrame:
    """Requests with the length of their file; null where it is missing. Paths are compared without a scheme."""
    plain = F.regexp_replace("path", r"^file:/+", "/")
    return requests.join(files.select(plain.alias("_p"), F.col("length").alias("size")), F.col(source) == F.col("_p"), "left").drop("_p")
