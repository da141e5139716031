"""An idempotent sink: what was taken once is never taken again, whoever restarts the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.scans import fresh
from millrace.storage import file_system


class Ledger:
    """Rows by id in a folder that driver and executors share, one part for each batch of each query.

    A batch's part is its rows whose ids no other part has, one for each id
    (the least by ``order``). A batch that comes again after a crash replaces its
    own part, so it may be written any number of times; a query that lost its
    checkpoint finds all ids taken. Two streams that run at once may both take an
    id: one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, order: str):
        self.spark, self.path, self.schema, self.key, self.order = spark, path.rstrip("/"), schema, key, order

    def rows(self) -> DataFrame:
        """All rows; none before the first batch."""
        p, fs = file_system(self.spark, self.path)
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.schema + ", query string, batch long")
        return self.spark.read.schema(self.schema + ", query string, batch long").parquet(self.path)

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """For ``foreachBatch``."""
        # The batch's own session knows the query.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        others = self.rows().filter(~((F.col("query") == query) & (F.col("batch") == batch_id))).select(self.key)
        (place,) = fresh(batch, "place")
        first = Window.partitionBy(self.key).orderBy(self.order)
        new = batch.filter(F.col(self.key).isNotNull()).join(others, self.key, "left_anti")
        new = new.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1).drop(place)
        # Written aside and moved: a task that fails half-way leaves the part as it was.
        aside, part = f"{self.path}/_aside-{query}-{batch_id}", f"{self.path}/query={query}/batch={batch_id}"
        new.select(*[f.name for f in self.spark.createDataFrame([], self.schema).schema]).write.mode("overwrite").parquet(aside)
        source, fs = file_system(self.spark, aside)
        target, _ = file_system(self.spark, part)
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        if not fs.rename(source, target):
            raise OSError(f"could not move {aside} to {part}")
