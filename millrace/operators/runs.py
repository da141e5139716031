"""Runs that land whole or not at all: staged rows, and a manifest whose rename is the commit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.storage import delete, file_system


class RunStore:
    """Outputs of many runs under ``root``.

    An attempt first stages all its rows in one folder, by one job; a crash
    leaves a folder that nothing names. The commit writes the manifest, one row for
    each whole run, aside and renames it; readers see the rows of runs that a
    manifest names, and nothing else. Runs are rows, not folders, so their number
    does not make small files.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def stage(self, outputs: DataFrame) -> str:
        """Write the rows (run, name, error and others) of an attempt; its name."""
        attempt = uuid.uuid4().hex
        names = [f.name for f in self.spark.createDataFrame([], self.schema).schema]
        outputs.select(*names).write.parquet(f"{self.root}/staged/attempt={attempt}")
        return attempt

    def staged(self, attempt: str | None = None) -> DataFrame:
        path = f"{self.root}/staged"
        if not self._any(path):
            return self.spark.createDataFrame([], self.schema + ", attempt string")
        rows = self.spark.read.schema(self.schema + ", attempt string").parquet(path)
        return rows.filter(F.col("attempt") == attempt) if attempt else rows

    def _any(self, path: str) -> bool:
        p, fs = file_system(self.spark, path)
        return bool(fs.exists(p) and len(fs.listStatus(p)))

    def commit(self, attempt: str) -> None:
        """Name the attempt's runs of which no output failed and that no manifest names yet; a second call changes nothing."""
        p, fs = file_system(self.spark, f"{self.root}/manifests/attempt={attempt}")
        if fs.exists(p):
            return
        whole = self.staged(attempt).groupBy("run").agg(F.count(F.lit(1)).alias("n_outputs"), F.count("error").alias("n_failed")).filter("n_failed = 0")
        new = whole.join(self.manifest().select("run"), "run", "left_anti").select("run", "n_outputs")
        aside = f"{self.root}/_manifest-{attempt}"
        new.write.mode("overwrite").parquet(aside)
        source, _ = file_system(self.spark, aside)
        fs.mkdirs(p.getParent())
        if not fs.rename(source, p):
            raise OSError(f"could not commit {attempt}")

    def manifest(self) -> DataFrame:
        """run, n_outputs, attempt of all committed runs."""
        kind = self.spark.createDataFrame([], self.schema).schema["run"].dataType.simpleString()
        schema = f"run {kind}, n_outputs long, attempt string"
        if not self._any(f"{self.root}/manifests"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/manifests")

    def outputs(self) -> DataFrame:
        """Rows of committed runs."""
        return self.staged().join(self.manifest().select("run", "attempt"), ["run", "attempt"]).drop("attempt")

    def vacuum(self) -> list[str]:
        """Delete what attempts that never committed left; their names. Not beside an attempt that is under way."""
        p, fs = file_system(self.spark, f"{self.root}/staged")
        gone = []
        for status in fs.listStatus(p) if fs.exists(p) else []:
            name = status.getPath().getName()
            manifest, _ = file_system(self.spark, f"{self.root}/manifests/{name}")
            if not fs.exists(manifest):
                delete(self.spark, status.getPath().toString())
                gone.append(name.removeprefix("attempt="))
        return gone
