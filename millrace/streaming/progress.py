"""How far a stream has come, as a table: a row of counts for each micro-batch, from metrics that the batch computes on its way."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from millrace.streaming import run

SCHEMA = "query string, run string, batch_id long, at string, n_input long, metrics map<string,long>"
#: Micro-batches that the listener holds before it appends them to the table.
HELD = 64
#: Seconds to wait for the last events of a stream that has ended.
PATIENCE_S = 120


class Progress(StreamingQueryListener):
    """Appends the metrics observed under ``name`` to the table at ``path``, for the stream of that name.

    A driver that is lost loses ``HELD`` rows at most: they are reports, no results.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name
        self.run, self.held, self.ended = None, [], threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId
            self.ended.clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.runId == self.run and self.name in p.observedMetrics:
            metrics = {k: v for k, v in p.observedMetrics[self.name].asDict().items() if v is not None}
            self.held.append((str(p.id), str(p.runId), p.batchId, p.timestamp, p.numInputRows, metrics))
            if len(self.held) >= HELD:
                self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.flush()
            self.ended.set()

    def flush(self) -> None:
        if self.held:
            self.spark.createDataFrame(self.held, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.held = []


def drain_observed(stream: DataFrame, metrics: dict[str, Column], path: str, checkpoint: str, to: str) -> DataFrame:
    """Run ``stream`` to the end of its input into ``to``; the progress so far, of earlier runs on the same ``path`` as well.

    ``metrics`` are aggregates over a micro-batch. A batch that a crash made
    run again counts once, as its latest run saw it.
    """
    spark, name = stream.sparkSession, f"progress_{uuid.uuid4().hex}"
    listener = Progress(spark, path, name)
    spark.streams.addListener(listener)
    try:
        run.drain(stream.observe(name, *[c.cast("long").alias(k) for k, c in metrics.items()]), checkpoint, to, name=name)
        if not listener.ended.wait(PATIENCE_S):
            raise TimeoutError(f"the end of a stream was not told of within {PATIENCE_S} s")
    finally:
        spark.streams.removeListener(listener)
    return progress(spark, path)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows, one for each micro-batch of a query; none before the first one."""
    from millrace.storage import file_system

    p, fs = file_system(spark, path)
    if not fs.exists(p):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).parquet(path)
    latest = F.max_by(F.struct("run", "at", "n_input", "metrics"), "at").alias("r")
    return rows.groupBy("query", "batch_id").agg(latest).select("query", "r.run", "batch_id", "r.at", "r.n_input", "r.metrics")
